"""Operator 4: mix sources to target weights by entropy balancing (DataFrame functions only).

Among all non-negative document rates that bring each source's words to its
target, the method takes those of least relative entropy to "every document
once", none above ``cap``. Their form is ``min(cap, exp(lambda_s * size / mean_s))``;
the lambdas solve the convex dual, by Newton iterations that keep a bracket.
Every iteration is one distributed aggregate over the histogram (source, size);
the state, one row per source, is written between iterations and only its
largest relative error reaches the driver. The rates are rounded to whole
copies with the row's hash; what rounding adds or lacks in a source is then
moved by single copies of hash-chosen documents, over a few aggregates.

Targets: sources by code point, null last, weigh ``weights`` in turn and share
all words; none gets more than ``cap`` times its own words, the excess is
shared again by weight. That is the level ``mu`` with target = min(cap * size,
weight * mu), found by one running sum over the sources.

Defined results: a null or empty text has size 0 and takes 0 words at a rate
of 1; null is a source of its own; rows of equal id and text get equal copies;
an empty table gives no rows. Columns that the input has under the names of
the result's columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldstat.llm.tables import SPACE_CLASS, SPACES, row_key, stored

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
NEWTON_STEPS = 60
NEWTON_ERROR = 1e-6
ROUNDS = 8
ROUND_ERROR = 1e-3
BROADCAST_SOURCES = 100_000


def size_of(text: Column) -> Column:
    """Number of runs of characters other than space and U+0009 to U+000D."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, f"[{SPACE_CLASS}]+"))).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``sources`` (source, source_size) with weight and target. One row per source."""
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(everything) - 1, F.lit(len(weights))) + 1
    w = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn))
    w = w.withColumn("limit", F.lit(cap) * F.col("source_size")).withColumn("ratio", F.col("limit") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    w = w.withColumn("mu", left / F.sum("weight").over(rest))
    # The first source, by ratio, that the level does not fill sets the level.
    w = w.withColumn("mu", F.first(F.when(F.col("mu") <= F.col("ratio"), F.col("mu")), ignorenulls=True).over(every))
    return w.withColumn("target", F.least(F.col("limit"), F.coalesce(F.col("weight") * F.col("mu"), F.col("limit")))
                        ).drop("ratio", "mu")


def _beside(df: DataFrame, state: DataFrame, few: bool) -> DataFrame:
    """``df`` with its source's row of ``state``; broadcast only below the checked bound."""
    right = state.withColumnRenamed("source", "_source")
    cond = df["source"].eqNullSafe(right["_source"])
    return df.join(F.broadcast(right) if few else right, cond).drop("_source")


def _rate(cap: float) -> Column:
    return F.when(F.col("target") >= F.col("limit"), F.lit(cap)).otherwise(
        F.least(F.lit(cap), F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0)))))


def _newton(bins: DataFrame, state: DataFrame, few: bool, cap: float) -> DataFrame:
    """Solve the dual: ``state`` with lam. Sources at their limit or without words need none."""
    state = (state.withColumn("lam", F.lit(0.0))
             .withColumn("lo", -F.col("mean") * F.log(F.greatest(F.col("source_size") / F.greatest(F.col("target"), F.lit(1e-9)), F.lit(1.0))) - 1e-9)
             .withColumn("hi", F.col("mean") * F.log(F.lit(cap)) + 1e-9))
    kept = [c for c in state.columns if c not in ("source", "lam", "lo", "hi")]
    r, free = _rate(cap), _rate(cap) < cap
    for step in range(NEWTON_STEPS):
        sums = (_beside(bins, state, few).withColumn("r", r)
                .groupBy("source", *kept, "lam", "lo", "hi")
                .agg((F.sum(F.col("n") * F.col("size") * F.col("r"))).alias("got"),
                     F.sum(F.when(free, F.col("n") * F.col("size") * F.col("size") / F.col("mean") * F.col("r"))).alias("slope")))
        gap = F.col("got") - F.col("target")
        sums = (sums.withColumn("lo", F.when(gap < 0, F.col("lam")).otherwise(F.col("lo")))
                .withColumn("hi", F.when(gap > 0, F.col("lam")).otherwise(F.col("hi")))
                .withColumn("new", F.col("lam") - F.try_divide(gap, F.col("slope")))
                .withColumn("new", F.when(gap == 0, F.col("lam")).when(
                    (F.col("new") > F.col("lo")) & (F.col("new") < F.col("hi")), F.col("new")).otherwise(
                    (F.col("lo") + F.col("hi")) / 2))
                .withColumn("err", F.when((F.col("target") >= F.col("limit")) | (F.col("target") <= 0), F.lit(0.0))
                            .otherwise(F.abs(gap) / F.col("target"))))
        done = stored(sums, "mix-newton")
        worst = done.agg(F.max("err")).head()[0]
        state = done.select("source", *kept, F.when(F.col("err") <= NEWTON_ERROR, F.col("lam")).otherwise(
            F.col("new")).alias("lam"), "lo", "hi")
        if worst is None or worst <= NEWTON_ERROR:
            break
    return state.drop("lo", "hi")


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the row alone."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / F.lit(float(1 << 40))


def _copies(rounds: int, cap: float) -> Column:
    """Whole copies of a row: rounded rate, then the moves of the first ``rounds`` rounds.

    Every move is written as a nested call on a struct, so that no round repeats the former ones.
    """
    first = F.floor(F.col("rate") + _uniform(F.lit(0), F.col("k1"), F.col("k2"))).cast("int")

    def moved(now: Column, t: Column) -> Column:
        m = F.get(F.col("moves"), t)
        ok = ((F.col("size") > 0) & (F.col("size") < m["below"])
              & (_uniform(t + 1, F.col("k2"), F.col("k1")) < m["p"])
              & (((m["way"] > 0) & (now < int(cap))) | ((m["way"] < 0) & (now > 0))))
        return F.when(ok, now + m["way"]).otherwise(now)

    if rounds == 0:
        return first
    return F.when(F.size("moves") == 0, first).otherwise(
        F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), first, lambda now, t: moved(now, t)))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, *keep: Column) -> DataFrame:
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    return docs.select(*keep, F.col(source_col).alias("source"), size_of(F.col(text_col)).alias("size"),
                       k1.alias("k1"), k2.alias("k2"))


def plan_mix(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> tuple[DataFrame, bool]:
    """One row per source: source_size, target, lam and the rounding moves; and whether these are few."""
    bins = stored(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-bins")
    sources = (bins.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("_n"))
               .withColumn("mean", F.greatest(F.col("source_size") / F.col("_n"), F.lit(1e-9))).drop("_n"))
    state = stored(targets(sources, weights, cap), "mix-targets")
    few = state.count() <= BROADCAST_SOURCES
    state = _newton(bins, state, few, cap)
    moves = "array<struct<way:int,below:double,p:double>>"
    state = state.withColumn("moves", F.array().cast(moves))
    for done in range(ROUNDS):
        state = stored(_next_move(sized, state, few, done, cap), "mix-state")
        worst = state.agg(F.max(F.when(F.col("target") > 0, F.abs(F.col("gap")) / F.col("target")))).head()[0]
        if worst is None or worst <= ROUND_ERROR:
            break
    return state, few


def _next_move(sized: DataFrame, state: DataFrame, few: bool, done: int, cap: float) -> DataFrame:
    """``state`` with one more move: what rounding and the former moves leave in a source goes to
    documents well below it in size, each with the probability that closes the gap on average.

    One pass: sums for each source and power of two of the size.
    """
    rows = _beside(sized, state, few).withColumn("rate", _rate(cap)).withColumn("copies", _copies(done, cap))
    rows = rows.withColumn("class", F.when(F.col("size") > 0, F.floor(F.log2("size"))).otherwise(0).cast("int"))
    sums = rows.groupBy("source", "class").agg(
        F.sum(F.col("copies") * F.col("size")).alias("got"),
        F.sum(F.when(F.col("copies") < int(cap), F.col("size")).otherwise(0)).alias("up"),
        F.sum(F.when(F.col("copies") > 0, F.col("size")).otherwise(0)).alias("down"))
    whole = Window.partitionBy("source")
    sums = _beside(sums, state.select("source", "target", "limit"), few)
    sums = (sums.withColumn("gap", F.when(F.col("target") >= F.col("limit"), F.lit(0.0)).otherwise(
                F.col("target") - F.sum("got").over(whole)))
            .withColumn("top", F.floor(F.log2(F.greatest(F.abs("gap") / (1.0 if done % 2 else 2.0), F.lit(1.0)))))
            .groupBy("source", "gap", "top")
            .agg(F.sum(F.when(F.col("class") < F.col("top"), F.when(F.col("gap") > 0, F.col("up")).otherwise(
                F.col("down")))).alias("room")))
    step = F.struct(F.signum("gap").cast("int").alias("way"), F.pow(F.lit(2.0), F.col("top")).alias("below"),
                    F.coalesce(F.least(F.lit(1.0), F.try_divide(F.abs("gap"), F.col("room"))), F.lit(0.0)).alias("p"))
    sums = sums.select(F.col("source").alias("_s"), "gap", step.alias("step"))
    state = state.drop("gap")
    return (state.join(sums, state["source"].eqNullSafe(F.col("_s"))).drop("_s")
            .withColumn("moves", F.concat("moves", F.array("step"))).drop("step"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``docs`` with size, source_size, target, rate, copies and taken (copies times size)."""
    sized = stored(_sized(docs, id_col, text_col, source_col), "mix-sizes")
    state, few = plan_mix(sized, weights, cap)
    return _mixed(docs, state, few, id_col, text_col, source_col, cap)


def _mixed(docs: DataFrame, state: DataFrame, few: bool, id_col: str, text_col: str, source_col: str,
           cap: float) -> DataFrame:
    added = ("size", "source_size", "target", "rate", "copies", "taken")
    rows = _sized(docs, id_col, text_col, source_col, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    used = state.agg(F.max(F.size("moves"))).head()[0] or 0
    out = _beside(rows, state, few).withColumn("rate", _rate(cap)).withColumn("copies", _copies(used, cap))
    out = out.withColumn("taken", F.col("copies").cast("long") * F.col("size"))
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in added], *added)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """The mixed corpus: every document as often as its copies, numbered by copy from 1."""
    out = mix(docs, id_col, text_col, source_col, weights, cap).where(F.col("copies") > 0)
    return (out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*[c for c in docs.columns if c != "copy"], "copy"))
