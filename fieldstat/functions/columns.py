"""Scalar column expressions (survey §2.2, §2.10): all JVM-side built-ins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def coord(col, i: int) -> Column:
    """B2: array element by position; NULL when the array is short or NULL."""
    return F.get(_c(col), F.lit(i))


def clock(minute, second) -> Column:
    """minute + second/60 as DOUBLE (the reference's literal made it a decimal)."""
    return _c(minute).cast("double") + _c(second).cast("double") / F.lit(60.0)


def clock_seconds(minute, second) -> Column:
    """The same clock in whole seconds (BIGINT): sums stay exact, divide once at the end."""
    return _c(minute).cast("bigint") * F.lit(60) + _c(second).cast("bigint")


def ratio(num, den, digits: int) -> Column:
    """num / den in decimals, rounded half up once; NULL (not an error) when den is 0.

    Decimal division keeps 12 places here, so no double lies a hair below the
    rounding edge of its true value."""
    r = F.try_divide(_c(num).cast("decimal(38,12)"), _c(den).cast("decimal(12,0)"))
    return F.round(r, digits)


def per_exposure(count, exposure, unit: float = 90, digits: int = 3) -> Column:
    """Rate per ``unit`` of a whole-numbered exposure, rounded."""
    return ratio(_c(count).cast("decimal(27,12)") * F.lit(int(unit)), exposure, digits).cast("double")


def safe_ratio(num, den, digits: int = 3) -> Column:
    """Num / greatest(den, 1)."""
    return ratio(num, F.greatest(_c(den), F.lit(1)), digits).cast("double")


def recode(col, groups: Mapping[str, Sequence[str]]) -> Column:
    """Searched CASE of many values to few classes; unmapped values give NULL."""
    expr = None
    for label, values in groups.items():
        cond = _c(col).isin(list(values))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def ordinal(col, levels: Sequence[str]) -> Column:
    """1-based position of the value in the ordered levels; NULL when absent."""
    pos = F.array_position(F.array(*[F.lit(v) for v in levels]), _c(col))
    return F.when(pos > 0, pos.cast("int"))


def cluster_name(col) -> Column:
    """Cluster index 0..K-1 to label C1..CK."""
    return F.concat(F.lit("C"), (_c(col) + F.lit(1)).cast("string"))


# Normal quantile by Acklam's rational approximation (relative error < 1.2e-9),
# written as SQL text so the same definition serves Spark and the DuckDB oracle.
# FIXED VALUES: published coefficients of the approximation.
_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
      1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
      6.680131188771802e+01, -1.328068155288572e+01]
_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
      -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
      3.754408661907416e+00]


def _horner(coefs, x: str) -> str:
    out = repr(coefs[0])
    for c in coefs[1:]:
        out = f"({out}) * {x} + ({c!r})"
    return out


def normal_quantile_sql(p: str) -> str:
    """SQL expression text of the standard normal quantile of ``p`` in (0, 1)."""
    lo = 0.02425
    q_tail_lo = f"sqrt(-2 * ln({p}))"
    q_tail_hi = f"sqrt(-2 * ln(1 - {p}))"
    q_mid = f"({p} - 0.5)"
    r_mid = f"({q_mid} * {q_mid})"
    tail = lambda q: f"(({_horner(_C, q)}) / ((({_horner(_D, q)}) * {q}) + 1))"
    mid = f"((({_horner(_A, r_mid)}) * {q_mid}) / ((({_horner(_B, r_mid)}) * {r_mid}) + 1))"
    return (f"CASE WHEN {p} < {lo} THEN {tail(q_tail_lo)} "
            f"WHEN {p} > {1 - lo} THEN -{tail(q_tail_hi)} "
            f"ELSE {mid} END")
