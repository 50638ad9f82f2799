"""Queries of profiles, statistics, distributions, sampling, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldstat.functions import vocab
from fieldstat.functions.columns import normal_quantile_sql, recode
from fieldstat.operators import basic, distribution as D, profile as P, ranking as R, stats as S
from fieldstat.plans import oracle_sql as O
from fieldstat.plans.adapters import table
from fieldstat.plans.features import layer
from fieldstat.plans.registry import query
from fieldstat.session import shared_dir
from fieldstat.sources.io import bounded, dataset_size, manifest, register, union_available, write_parquet

LAYER_COLS = ["match_id", "minute", "second", "event_type", "player_id", "player_name", "team_name",
              "position_name", "pass_outcome", "pass_length", "pass_goal_assist", "pass_shot_assist",
              "shot_xg", "shot_outcome", "dribble_outcome", "duel_type", "loc_x", "loc_y"]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
RR_BUDGET = 500_000_000.0
RR_ORDER = PRIORITIES[::-1]


def _r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- profiles

@query("null_profile", O.with_(O.EV) + ", w AS (SELECT COUNT(*) AS _n, " + ", ".join(
    f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}" for c in LAYER_COLS)
    + " FROM ev)\nSELECT column_name, n_na, ROUND(100.0 * n_na / _n, 1) AS pct_na FROM (UNPIVOT w ON "
    + ", ".join(LAYER_COLS) + " INTO NAME column_name VALUE n_na) u")
def q_null_profile(spark, sf_dir):
    """NULL count and share of every column of the event layer, one aggregate."""
    return P.null_profile(layer(spark, sf_dir).select(*LAYER_COLS)).withColumnRenamed("column", "column_name")


_NPB_COLS = ["shot_xg", "loc_x", "player_id", "pass_outcome"]


@query("null_profile_by", O.with_(O.EV) + "SELECT event_type AS grp, COUNT(*) AS n, " + ", ".join(
    f"ROUND(100.0 * AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 1) AS pct_na_{c}" for c in _NPB_COLS)
    + " FROM ev GROUP BY event_type")
def q_null_profile_by(spark, sf_dir):
    """NULL shares of several columns within each event type."""
    return P.null_profile_by(layer(spark, sf_dir), F.col("event_type"), _NPB_COLS)


@query("value_counts", """
SELECT event_type, COUNT(*) AS n, ROUND(COUNT(*) / (SELECT COUNT(*) FROM events), 4) AS share
FROM events GROUP BY event_type""")
def q_value_counts(spark, sf_dir):
    """Counts per value, most frequent first, with the share of all rows."""
    return P.value_counts(table(spark, sf_dir, "events"), "event_type")


@query("count_where", """
SELECT CAST(SUM(CASE WHEN l_discount = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_discount,
       CAST(SUM(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_tax,
       CAST(SUM(CASE WHEN l_quantity < 5 THEN 1 ELSE 0 END) AS BIGINT) AS small_quantity
FROM lineitem""")
def q_count_where(spark, sf_dir):
    """Counts of zeros / values below a bound, one pass."""
    li = table(spark, sf_dir, "lineitem")
    return P.count_where(li, {"zero_discount": F.col("l_discount") == 0, "zero_tax": F.col("l_tax") == 0,
                              "small_quantity": F.col("l_quantity") < 5})


@query("duplicate_count", """
SELECT COUNT(*) - COUNT(DISTINCT o_custkey) AS duplicates FROM orders""")
def q_duplicate_count(spark, sf_dir):
    """Rows minus distinct keys."""
    return P.duplicate_count(table(spark, sf_dir, "orders"), ["o_custkey"])


@query("n_distinct", """
SELECT COUNT(*) AS n, COUNT(DISTINCT l_orderkey) AS n_orders, COUNT(DISTINCT l_partkey) AS n_parts
FROM lineitem""")
def q_n_distinct(spark, sf_dir):
    """Row count and exact distinct counts."""
    li = table(spark, sf_dir, "lineitem")
    return li.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("n_orders"),
                  F.count_distinct("l_partkey").alias("n_parts"))


@query("numeric_columns", """
WITH w AS (SELECT COUNT(*) AS n, COUNT(DISTINCT c_nationkey) AS c_nationkey, COUNT(DISTINCT c_acctbal) AS c_acctbal FROM customer)
SELECT n, c_nationkey, c_acctbal FROM w""")
def q_numeric_columns(spark, sf_dir):
    """The numeric columns but the key, a generated expression for each, selected by a list
    that also names a column the table does not have."""
    c = table(spark, sf_dir, "customer")
    names = basic.numeric_features(c, exclude=["c_custkey"])
    found = c.agg(F.count(F.lit(1)).alias("n"), *basic.per_column(names, lambda x: F.count_distinct(F.col(x))))
    return basic.select_available(found, ["n", *names, "c_height"])


@query("suffixes", """
SELECT n.n_nationkey, r.r_regionkey, n.comment AS comment_x, r.comment AS comment_y
FROM (SELECT n_nationkey, n_regionkey, n_name AS comment FROM nation) n
JOIN (SELECT r_regionkey, r_name AS comment FROM region) r ON r.r_regionkey = n.n_regionkey""")
def q_suffixes(spark, sf_dir):
    """Colliding column names of both sides of a join get suffixes."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").alias("key"), F.col("n_name").alias("comment"))
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("comment"))
    a, b = basic.suffix_collisions(n, r, ["key"])
    return a.join(b, "key").select("n_nationkey", F.col("key").alias("r_regionkey"), "comment_x", "comment_y")


@query("string_functions", """
SELECT c_custkey, regexp_replace(c_name, '[^0-9]+', '', 'g') AS digits, regexp_matches(c_mktsegment, '^(AUTO|MACH)') AS engines,
       printf('%s / %d', c_mktsegment, c_nationkey) AS tag FROM customer""")
def q_string_functions(spark, sf_dir):
    """regexp_replace, rlike, format_string."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.regexp_replace("c_name", "[^0-9]+", "").alias("digits"), F.col("c_mktsegment").rlike("^(AUTO|MACH)").alias("engines"),
        F.format_string("%s / %d", "c_mktsegment", "c_nationkey").alias("tag"))


@query("view_bounded", """
SELECT c_mktsegment, COUNT(*) AS n FROM customer GROUP BY 1""")
def q_view_bounded(spark, sf_dir):
    """A named relation queried by SQL, its small result collected within a checked bound."""
    register(table(spark, sf_dir, "customer"), "customer_relation")
    small = spark.sql("SELECT c_mktsegment, COUNT(*) AS n FROM customer_relation GROUP BY c_mktsegment")
    return spark.createDataFrame(bounded(small, 1000), "c_mktsegment string, n long")


@query("parquet_files", "SELECT 3 AS files, COUNT(*) AS rows FROM orders")
def q_parquet_files(spark, sf_dir):
    """A5: a stated number of Parquet files."""
    path = write_parquet(table(spark, sf_dir, "orders").select("o_orderkey"), shared_dir(spark, "files"), files=3)
    back = spark.read.parquet(path)
    return back.agg(F.count_distinct(F.col("_metadata.file_path")).cast("int").alias("files"), F.count(F.lit(1)).alias("rows"))


@query("dataset_size")
def q_dataset_size(spark, sf_dir):
    """Files and bytes of the input tables, from file metadata only."""
    return dataset_size(spark, sf_dir, glob="*.parquet")


# ---------------------------------------------------------------- statistics

_SKEW3 = "skewness({c}) * (COUNT({c}) - 2) / sqrt(COUNT({c}) * (COUNT({c}) - 1)) * pow((COUNT({c}) - 1.0) / COUNT({c}), 1.5)"


@query("describe", "WITH u AS (UNPIVOT (SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in LI_NUM)
       + " FROM lineitem) ON " + ", ".join(LI_NUM) + """ INTO NAME feature VALUE value)
SELECT feature, ROUND(AVG(value), 3) AS mean, ROUND(quantile_cont(value, 0.5), 3) AS median,
       ROUND(STDDEV_SAMP(value), 3) AS sd, ROUND(MIN(value), 3) AS min, ROUND(MAX(value), 3) AS max,
       ROUND(""" + _SKEW3.format(c="value") + """, 3) AS skewness
FROM u GROUP BY feature""")
def q_describe(spark, sf_dir):
    """D17 (+H1): descriptive table per feature with type-3 skewness."""
    return S.describe(table(spark, sf_dir, "lineitem"), LI_NUM)


@query("summary6", "WITH u AS (UNPIVOT (SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in LI_NUM)
       + " FROM lineitem) ON " + ", ".join(LI_NUM) + """ INTO NAME feature VALUE value)
SELECT feature, MIN(value) AS min, ROUND(quantile_cont(value, 0.25), 6) AS q1,
       ROUND(quantile_cont(value, 0.5), 6) AS median, ROUND(AVG(value), 6) AS mean,
       ROUND(quantile_cont(value, 0.75), 6) AS q3, MAX(value) AS max
FROM u GROUP BY feature""")
def q_summary6(spark, sf_dir):
    """Six-number summary with exact quartiles."""
    s = S.summary6(table(spark, sf_dir, "lineitem"), LI_NUM)
    return s.select("feature", "min", *[_r6(c).alias(c) for c in ("q1", "median", "mean", "q3")], "max")


@query("group_means", """
SELECT l_returnflag, COUNT(*) AS n, ROUND(AVG(l_quantity), 6) AS l_quantity,
       ROUND(AVG(l_extendedprice), 6) AS l_extendedprice, ROUND(AVG(l_discount), 6) AS l_discount
FROM lineitem GROUP BY l_returnflag""")
def q_group_means(spark, sf_dir):
    """Group size and means."""
    g = S.group_means(table(spark, sf_dir, "lineitem"), "l_returnflag",
                      ["l_quantity", "l_extendedprice", "l_discount"])
    return g.select("l_returnflag", "n", *[_r6(c).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount")])


@query("spread", """
SELECT l_returnflag, MIN(l_extendedprice) AS min, MAX(l_extendedprice) AS max,
       MAX(l_extendedprice) - MIN(l_extendedprice) AS range,
       ROUND(quantile_cont(l_extendedprice, 0.5), 6) AS median
FROM lineitem GROUP BY l_returnflag""")
def q_spread(spark, sf_dir):
    """Min, max, range, exact median per group."""
    s = S.spread(table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return s.withColumn("median", _r6("median"))


@query("argmax", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey, o_custkey LIMIT 1""")
def q_argmax(spark, sf_dir):
    """The row with the extreme value (max_by)."""
    return S.argmax(table(spark, sf_dir, "orders"), "o_totalprice", ["o_orderkey", "o_custkey"])


@query("argmax_per_group", """
SELECT c_nationkey, c_custkey, c_acctbal, c_name FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS rn
  FROM customer) x WHERE rn = 1""")
def q_argmax_per_group(spark, sf_dir):
    """Per group the row with the largest value (NULL loses, ties -> smallest id)."""
    return S.argmax_per_group(table(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal", "c_custkey",
                              ["c_name"])


@query("crosstab", """
SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1, 2""")
def q_crosstab(spark, sf_dir):
    """Two-way contingency table, long."""
    return S.crosstab(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query("crosstab_wide", "SELECT o_orderstatus, " + ", ".join(
    f"CAST(SUM(CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END) AS BIGINT) AS \"{p}\"" for p in PRIORITIES)
    + " FROM orders GROUP BY o_orderstatus")
def q_crosstab_wide(spark, sf_dir):
    """D20 + H2: contingency table, wide (pivot with known levels)."""
    return S.crosstab(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority",
                      PRIORITIES, wide=True)


@query("dominant", """
WITH c AS (SELECT n.n_name, cu.c_mktsegment, COUNT(*) AS cnt
           FROM customer cu JOIN nation n ON n.n_nationkey = cu.c_nationkey GROUP BY 1, 2),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY n_name ORDER BY cnt DESC, c_mktsegment) AS rn,
             SUM(cnt) OVER (PARTITION BY n_name) AS n FROM c)
SELECT n_name, c_mktsegment AS dominant, cnt AS dominant_n, CAST(n AS BIGINT) AS n,
       ROUND(cnt / n, 4) AS dominant_share FROM r WHERE rn = 1""")
def q_dominant(spark, sf_dir):
    """D28 (+C1): dominant class per group with its share."""
    cu, na = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    j = cu.join(na, cu.c_nationkey == na.n_nationkey)
    return S.dominant(j, "n_name", "c_mktsegment")


def _corr_sql(cols, table_name):
    sel = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            sel.append(f"SELECT '{a}' AS row, '{b}' AS col, corr({a}, {b}) AS v FROM {table_name}")
    return " UNION ALL ".join(sel)


@query("corr_matrix", "WITH u AS (" + _corr_sql(LI_NUM, "lineitem") + """)
SELECT row, col, ROUND(v, 6) AS value FROM u
UNION ALL SELECT col AS row, row AS col, ROUND(v, 6) AS value FROM u
UNION ALL SELECT * FROM (VALUES """ + ", ".join(f"('{c}', '{c}', 1.0)" for c in LI_NUM) + ") d(row, col, value)")
def q_corr_matrix(spark, sf_dir):
    """D24 (+H3): Pearson matrix in one aggregate, as (row, col, value) triples."""
    return S.corr_matrix(table(spark, sf_dir, "lineitem"), LI_NUM)


_CP_COLS = LI_NUM + ["l_linenumber", "l_partkey", "l_suppkey"]


@query("corr_pairs", "WITH u AS (" + _corr_sql(sorted(_CP_COLS), "lineitem") + """)
SELECT row, col, ROUND(v, 4) AS r FROM u WHERE abs(v) > 0.1""")
def q_corr_pairs(spark, sf_dir):
    """D25 (+B17): each unordered pair once with |r| above a bound."""
    return S.corr_pairs(table(spark, sf_dir, "lineitem"), _CP_COLS, bound=0.1)


@query("anova_f", "WITH u AS (UNPIVOT (SELECT l_returnflag, " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in LI_NUM) + " FROM lineitem) ON " + ", ".join(LI_NUM)
    + """ INTO NAME feature VALUE value),
o AS (SELECT feature, AVG(value) AS mu, COUNT(value) AS nn, COUNT(DISTINCT l_returnflag) AS k FROM u GROUP BY 1),
g AS (SELECT feature, l_returnflag, AVG(value) AS m FROM u GROUP BY 1, 2),
f AS (SELECT u.feature, SUM((m - mu) * (m - mu)) AS between_, SUM((value - m) * (value - m)) AS within_, MAX(nn) AS nn, MAX(k) AS k
      FROM u JOIN g USING (feature, l_returnflag) JOIN o ON o.feature = u.feature GROUP BY u.feature)
SELECT feature, ROUND((between_ / (k - 1)) / (within_ / (nn - k)), 1) AS f_value FROM f""")
def q_anova_f(spark, sf_dir):
    """One-way ANOVA F per feature against a class."""
    return S.anova_f(table(spark, sf_dir, "lineitem"), LI_NUM, "l_returnflag")


# ---------------------------------------------------------------- distributions

@query("histogram", """
WITH s AS (SELECT MIN(l_extendedprice) AS mn, MAX(l_extendedprice) AS mx, COUNT(*) AS n FROM lineitem
           WHERE l_extendedprice IS NOT NULL),
b AS (SELECT CAST(CASE WHEN (mx - mn) / 40.0 > 0 THEN LEAST(FLOOR((l_extendedprice - mn) / ((mx - mn) / 40.0)), 39)
                       ELSE 0 END AS INTEGER) AS bin
      FROM lineitem, s WHERE l_extendedprice IS NOT NULL)
SELECT bin, ROUND(mn + bin * ((mx - mn) / 40.0), 6) AS lo, ROUND(mn + bin * ((mx - mn) / 40.0) + (mx - mn) / 40.0, 6) AS hi,
       COUNT(*) AS n, ROUND(COUNT(*) / (n * ((mx - mn) / 40.0)), 6) AS density
FROM b, s GROUP BY bin, mn, mx, n""")
def q_histogram(spark, sf_dir):
    """Equal-width histogram with density; min/max as merged scalar subqueries."""
    return D.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 40, digits=6)


@query("raster", """
WITH s AS (SELECT MIN(l_quantity) AS mnx, MAX(l_quantity) AS mxx, MIN(l_extendedprice) AS mny,
                  MAX(l_extendedprice) AS mxy FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL)
SELECT CAST(CASE WHEN (mxx - mnx) / 60.0 > 0 THEN LEAST(FLOOR((l_quantity - mnx) / ((mxx - mnx) / 60.0)), 59) ELSE 0 END AS INTEGER) AS cx,
       CAST(CASE WHEN (mxy - mny) / 60.0 > 0 THEN LEAST(FLOOR((l_extendedprice - mny) / ((mxy - mny) / 60.0)), 59) ELSE 0 END AS INTEGER) AS cy,
       COUNT(*) AS n
FROM lineitem, s WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY 1, 2""")
def q_raster(spark, sf_dir):
    """60 x 60 raster density."""
    return D.raster(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", 60)


@query("grid_counts", O.with_(O.EV) + f"""
SELECT {O.ROLE_CLASS_CASE} AS pos_grp, FLOOR(loc_x / 4) * 4 AS gx, FLOOR(loc_y / 4) * 4 AS gy, COUNT(*) AS n
FROM ev WHERE loc_x IS NOT NULL AND loc_y IS NOT NULL AND position_name IS NOT NULL GROUP BY 1, 2, 3""")
def q_grid_counts(spark, sf_dir):
    """J3 (+B9): fixed-step grid of locations per role class."""
    ev = layer(spark, sf_dir).where(F.col("position_name").isNotNull())
    ev = ev.withColumn("pos_grp", recode("position_name", vocab.ROLE_CLASSES))
    return D.grid_counts(ev, "pos_grp", "loc_x", "loc_y", 4)


@query("box_stats", """
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
                  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1)
SELECT l.l_returnflag, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3,
       MIN(CASE WHEN l_extendedprice >= q1 - 1.5 * (q3 - q1) THEN l_extendedprice END) AS lower_whisker,
       MAX(CASE WHEN l_extendedprice <= q3 + 1.5 * (q3 - q1) THEN l_extendedprice END) AS upper_whisker,
       CAST(SUM(CASE WHEN l_extendedprice < q1 - 1.5 * (q3 - q1) OR l_extendedprice > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT) AS outliers,
       COUNT(*) AS n
FROM lineitem l JOIN q ON q.l_returnflag = l.l_returnflag WHERE l_extendedprice IS NOT NULL
GROUP BY l.l_returnflag, q1, median, q3""")
def q_box_stats(spark, sf_dir):
    """Box-plot statistics per group with exact quartiles."""
    b = D.box_stats(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice")
    return b.select("l_returnflag", *[_r6(c).alias(c) for c in ("q1", "median", "q3")],
                    "lower_whisker", "upper_whisker", F.col("outliers").cast("bigint").alias("outliers"), "n")


@query("kde", """
WITH v AS (SELECT CAST(o_totalprice AS DOUBLE) / 1000 AS x FROM orders WHERE o_totalprice IS NOT NULL),
a AS (SELECT MIN(x) AS mn, MAX(x) AS mx, COUNT(*) AS n, STDDEV_SAMP(x) AS sd,
             quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM v),
b AS (SELECT *, 0.9 * LEAST(sd, iqr / 1.34) * pow(n, -0.2) AS bw FROM a),
p AS (SELECT *, mn - 3 * bw AS lo, (mx - mn + 6 * bw) / 511 AS step FROM b),
w AS (SELECT j, SUM(wt) AS wt FROM (
        SELECT UNNEST([FLOOR((x - lo) / step), FLOOR((x - lo) / step) + 1]) AS j,
               UNNEST([1 - ((x - lo) / step - FLOOR((x - lo) / step)), (x - lo) / step - FLOOR((x - lo) / step)]) AS wt FROM v, p)
      GROUP BY j)
SELECT CAST(g AS INTEGER) AS g, ROUND(lo + g * step, 6) AS x,
       ROUND(SUM(wt * exp(-pow((g - j) * step / bw, 2) / 2)) / (n * bw * sqrt(2 * pi())), 6) AS density
FROM range(512) r(g), w, p GROUP BY g, lo, step, bw, n""")
def q_kde(spark, sf_dir):
    """Gaussian kernel density of order prices (in thousands) on a 512-point grid."""
    o = table(spark, sf_dir, "orders").select((F.col("o_totalprice").cast("double") / 1000).alias("x"))
    return D.kde(o, "x").select("g", _r6("x").alias("x"), _r6("density").alias("density"))


@query("composition", O.with_(O.EV) + f"""
, c AS (SELECT team_name, {O.ROLE_CLASS_CASE} AS pos_grp, COUNT(*) AS n FROM ev GROUP BY 1, 2)
SELECT team_name, pos_grp, n, ROUND(n / SUM(n) OVER (PARTITION BY team_name), 4) AS share FROM c""")
def q_composition(spark, sf_dir):
    """Class composition of each group, stacked to 100 %."""
    ev = layer(spark, sf_dir).withColumn("pos_grp", recode("position_name", vocab.ROLE_CLASSES))
    return D.composition(ev, "team_name", "pos_grp")


@query("qq_pairs", """
WITH r AS (SELECT l_quantity AS sample, ROW_NUMBER() OVER (ORDER BY l_quantity) AS i, COUNT(*) OVER () AS n
           FROM lineitem WHERE l_quantity IS NOT NULL),
p AS (SELECT *, (i - CASE WHEN n <= 10 THEN 0.375 ELSE 0.5 END) / (n + 1 - 2 * CASE WHEN n <= 10 THEN 0.375 ELSE 0.5 END) AS _p FROM r)
SELECT i, n, sample, ROUND(""" + normal_quantile_sql("_p") + """, 6) AS theoretical FROM p""")
def q_qq_pairs(spark, sf_dir):
    """Normal Q-Q pairs with a distributed global ranking."""
    q = R.qq_pairs(table(spark, sf_dir, "lineitem"), "l_quantity")
    return q.withColumn("theoretical", _r6("theoretical"))


@query("error_bars", """
SELECT l_returnflag, ROUND(AVG(l_quantity), 6) AS mean, ROUND(STDDEV_SAMP(l_quantity) / sqrt(COUNT(*)), 6) AS se,
       ROUND(AVG(l_quantity) - STDDEV_SAMP(l_quantity) / sqrt(COUNT(*)), 6) AS lower,
       ROUND(AVG(l_quantity) + STDDEV_SAMP(l_quantity) / sqrt(COUNT(*)), 6) AS upper
FROM lineitem GROUP BY l_returnflag""")
def q_error_bars(spark, sf_dir):
    """Mean ± standard error per group."""
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_returnflag").agg(F.avg("l_quantity").alias("mean"),
                                       (F.stddev_samp("l_quantity") / F.sqrt(F.count(F.lit(1)))).alias("se"))
    e = D.error_bars(g, "mean", "se")
    return e.select("l_returnflag", *[_r6(c).alias(c) for c in ("mean", "se", "lower", "upper")])


# ---------------------------------------------------------------- ordered / windowed

@query("relative_drop", """
WITH d AS (SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS day, COUNT(*) AS n FROM events GROUP BY 1)
SELECT day, n, ROUND(100.0 * (LAG(n) OVER (ORDER BY day) - n) / LAG(n) OVER (ORDER BY day), 1) AS drop_pct FROM d""")
def q_relative_drop(spark, sf_dir):
    """E5: relative drop to the previous row (elbow table) over a daily series."""
    ev = table(spark, sf_dir, "events")
    d = ev.groupBy(F.date_format("ts", "yyyyMMdd").cast("int").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return S.relative_drop(d, "day", "n")


@query("first_reaching", """
WITH c AS (SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1),
r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY n DESC, event_type) AS rank_,
             SUM(n) OVER (ORDER BY n DESC, event_type ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 1.0
             / SUM(n) OVER () AS cum_share FROM c)
SELECT event_type, n, rank_, ROUND(cum_share, 4) AS cum_share,
       rank_ = (SELECT MIN(rank_) FROM r WHERE cum_share >= 0.5) AS first_reaching FROM r""")
def q_first_reaching(spark, sf_dir):
    """Cumulative share of ranked values and the first rank reaching a bound."""
    c = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return S.first_reaching(c, [F.desc("n"), F.asc("event_type")], "n", 0.5)


@query("round_robin_budget", f"""
WITH r AS (SELECT o_orderpriority, o_orderkey, o_totalprice,
                  ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS round
           FROM (SELECT o_orderpriority, o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_totalprice END AS o_totalprice FROM orders)),
c AS (SELECT *, SUM(o_totalprice) OVER (ORDER BY round, list_position({RR_ORDER}, o_orderpriority)
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - o_totalprice AS size_before FROM r)
SELECT o_orderpriority, o_orderkey, o_totalprice, round, ROUND(size_before, 2) AS size_before
FROM c WHERE size_before < {RR_BUDGET} AND o_totalprice > 0""")
def q_round_robin_budget(spark, sf_dir):
    """Round-robin budgeted selection across groups in a listed order (distributed running
    totals); every seventh order weighs nothing, keeps its turn and is not taken."""
    o = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", F.when(
        F.col("o_orderkey") % 7 == 0, 0.0).otherwise(F.col("o_totalprice")).alias("o_totalprice"))
    sel = R.round_robin_budget(o, "o_orderpriority", ["o_orderkey"], "o_totalprice", RR_BUDGET, group_order=RR_ORDER)
    return sel.withColumn("size_before", F.round("size_before", 2))


@query("profile_index", """
SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice,
       ROW_NUMBER() OVER (ORDER BY l_returnflag, l_extendedprice DESC, l_orderkey, l_linenumber) AS i
FROM lineitem""")
def q_profile_index(spark, sf_dir):
    """One global position after sorting by group, then value descending."""
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    return R.running_total(li, [F.col("l_returnflag"), F.col("l_extendedprice").desc(),
                                F.col("l_orderkey"), F.col("l_linenumber")], out="i")


_SPLIT_KEY = "md5(CAST(vec_id AS VARCHAR))"


@query("stratified_split", f"""
SELECT vec_id, label, PERCENT_RANK() OVER (PARTITION BY label ORDER BY {_SPLIT_KEY}) <= 0.8 AS is_train
FROM embeddings""")
def q_stratified_split(spark, sf_dir):
    """Stratified split by percent rank of a hashed key within the class."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return R.stratified_split(e, "label", 0.8, key=F.md5(F.col("vec_id").cast("string")))


@query("stratified_folds", f"""
SELECT vec_id, label, CAST((ROW_NUMBER() OVER (PARTITION BY label ORDER BY {_SPLIT_KEY}) - 1) % 10 AS INTEGER) AS fold
FROM embeddings""")
def q_stratified_folds(spark, sf_dir):
    """Stratified 10-fold assignment."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return R.stratified_folds(e, "label", 10, key=F.md5(F.col("vec_id").cast("string")))


@query("split_balance", f"""
WITH s AS (SELECT label, PERCENT_RANK() OVER (PARTITION BY label ORDER BY {_SPLIT_KEY}) <= 0.8 AS t FROM embeddings)
SELECT label, COUNT(*) AS total, CAST(SUM(CASE WHEN t THEN 1 ELSE 0 END) AS BIGINT) AS train,
       CAST(SUM(CASE WHEN t THEN 0 ELSE 1 END) AS BIGINT) AS test,
       ROUND(SUM(CASE WHEN t THEN 1 ELSE 0 END) / COUNT(*), 3) AS train_share
FROM s GROUP BY label""")
def q_split_balance(spark, sf_dir):
    """Class balance of the split: total, train, test, share."""
    s = q_stratified_split(spark, sf_dir)
    return S.split_balance(s.where("is_train"), s.where("NOT is_train"), "label")


# The same with NULL groups: every value of one class or flag becomes NULL, which is a group of its own.

@query("stratified_split_nulls", f"""
SELECT vec_id, NULLIF(label, 3) AS label,
       PERCENT_RANK() OVER (PARTITION BY NULLIF(label, 3) ORDER BY {_SPLIT_KEY}) <= 0.8 AS is_train FROM embeddings""")
def q_stratified_split_nulls(spark, sf_dir):
    """E4 with a NULL class."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.nullif(F.col("label"), F.lit(3)).alias("label"))
    return R.stratified_split(e, "label", 0.8, key=F.md5(F.col("vec_id").cast("string")))


@query("stratified_folds_nulls", f"""
SELECT vec_id, NULLIF(label, 3) AS label,
       CAST((ROW_NUMBER() OVER (PARTITION BY NULLIF(label, 3) ORDER BY {_SPLIT_KEY}) - 1) % 10 AS INTEGER) AS fold FROM embeddings""")
def q_stratified_folds_nulls(spark, sf_dir):
    """E9 with a NULL class."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.nullif(F.col("label"), F.lit(3)).alias("label"))
    return R.stratified_folds(e, "label", 10, key=F.md5(F.col("vec_id").cast("string")))


@query("spread_nulls", """
SELECT NULLIF(l_returnflag, 'N') AS flag, MIN(l_discount) AS min, MAX(l_discount) AS max, MAX(l_discount) - MIN(l_discount) AS range,
       ROUND(quantile_cont(l_discount, 0.5), 6) AS median FROM lineitem GROUP BY 1""")
def q_spread_nulls(spark, sf_dir):
    """D23 with a NULL group and a column of few, hot values."""
    li = table(spark, sf_dir, "lineitem").select(F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"), "l_discount")
    return S.spread(li, "l_discount", ["flag"]).withColumn("median", _r6("median"))


@query("box_stats_nulls", """
WITH f AS (SELECT COALESCE(NULLIF(l_returnflag, 'N'), '') AS flag, l_extendedprice AS x FROM lineitem WHERE l_extendedprice IS NOT NULL),
q AS (SELECT flag, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM f GROUP BY 1)
SELECT NULLIF(flag, '') AS flag, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3,
       MIN(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1)) AS lower_whisker, MAX(x) FILTER (WHERE x <= q3 + 1.5 * (q3 - q1)) AS upper_whisker,
       COUNT(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS outliers, COUNT(*) AS n
FROM f JOIN q USING (flag) GROUP BY flag, q1, median, q3""")
def q_box_stats_nulls(spark, sf_dir):
    """J4 with a NULL group."""
    li = table(spark, sf_dir, "lineitem").select(F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"), "l_extendedprice")
    b = D.box_stats(li, "flag", "l_extendedprice")
    return b.select("flag", *[_r6(c).alias(c) for c in ("q1", "median", "q3")], "lower_whisker", "upper_whisker",
                    F.col("outliers").cast("bigint").alias("outliers"), "n")


@query("split_shares", """
SELECT label, COUNT(*) AS total, CAST(FLOOR(0.8 * (COUNT(*) - 1)) + 1 AS BIGINT) AS train FROM embeddings GROUP BY 1""")
def q_split_shares(spark, sf_dir):
    """E4, S6 with the default rand(seed) key: class sizes and train sizes (which rows, is random)."""
    s = R.stratified_split(table(spark, sf_dir, "embeddings").select("vec_id", "label"), "label", 0.8)
    return s.groupBy("label").agg(F.count(F.lit(1)).alias("total"), F.sum(F.col("is_train").cast("bigint")).alias("train"))


@query("top_n", """
SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 15""")
def q_top_n(spark, sf_dir):
    """top 15 by a descending key (a top-k report)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return basic.top(c, [F.desc("c_acctbal"), F.asc("c_custkey")], 15)


# ---------------------------------------------------------------- joins, sets

@query("joins", """
SELECT o.o_orderkey, c.c_name, n.n_name, o.o_totalprice
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def q_joins(spark, sf_dir):
    """Inner join on one key, then left join with differently named keys."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    j = basic.join_on(j, n, {"c_nationkey": "n_nationkey"}, "left")
    return j.select("o_orderkey", "c_name", "n_name", "o_totalprice")


@query("composite_join", """
WITH s AS (SELECT o_custkey, o_orderstatus, COUNT(*) AS n_status FROM orders GROUP BY 1, 2)
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, s.n_status
FROM orders o JOIN s ON s.o_custkey = o.o_custkey AND s.o_orderstatus = o.o_orderstatus""")
def q_composite_join(spark, sf_dir):
    """Inner equi-join on a composite key."""
    o = table(spark, sf_dir, "orders")
    s = o.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n_status"))
    return o.join(s, ["o_custkey", "o_orderstatus"]).select("o_orderkey", "o_custkey", "o_orderstatus", "n_status")


@query("manifest", """
SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def q_manifest(spark, sf_dir):
    """Metadata restricted to ids present elsewhere (left semi join)."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    c = table(spark, sf_dir, "customer")
    return manifest(c, o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("union_bind", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def q_union_bind(spark, sf_dir):
    """Bind tables by name, keeping the wanted columns each one has."""
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"))
    return union_available([c, s], ["key", "name", "nationkey", "acctbal", "segment"])


@query("unordered_pairs", """
SELECT DISTINCT LEAST(l_partkey, l_suppkey) AS a, GREATEST(l_partkey, l_suppkey) AS b FROM lineitem WHERE l_partkey <> l_suppkey""")
def q_unordered_pairs(spark, sf_dir):
    """Distinct unordered pairs."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"))
    return basic.unordered_pairs(li, "a", "b")


@query("retype", """
SELECT c_custkey, TRY_CAST(c_mktsegment AS INTEGER) AS c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey
FROM customer""")
def q_retype(spark, sf_dir):
    """Casts; text that does not convert becomes NULL."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return basic.retype(c, {"c_mktsegment": "int", "c_nationkey": "bigint"})


# ---------------------------------------------------------------- sinks and sources round trips

@query("csv_roundtrip", """
SELECT l_returnflag, l_linestatus, COUNT(*) AS n, ROUND(SUM(l_quantity), 2) AS sum_qty
FROM lineitem GROUP BY 1, 2""")
def q_csv_roundtrip(spark, sf_dir):
    """A7 then A6: an aggregate written as CSV with a header, read back with a schema."""
    from fieldstat.sources.io import read_csv, write_csv
    li = table(spark, sf_dir, "lineitem")
    agg = li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"))
    path = write_csv(agg, shared_dir(spark, "csv"), files=1)
    return read_csv(spark, path, "l_returnflag string, l_linestatus string, n bigint, sum_qty double")


@query("parquet_roundtrip", """
SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1""")
def q_parquet_roundtrip(spark, sf_dir):
    """Orders written as Parquet partitioned by priority, the feature list
    saved and reloaded, NULL check, then re-read (A3)."""
    from fieldstat.operators.profile import expect_no_nulls
    from fieldstat.sources.io import load_features, read_parquet, save_features
    o = table(spark, sf_dir, "orders")
    feat_path = shared_dir(spark, "features")
    save_features(spark, ["o_orderkey", "o_totalprice"], feat_path)
    names = load_features(spark, feat_path)
    path = write_parquet(expect_no_nulls(o, ["o_orderpriority"]).select("o_orderpriority", *names),
                         shared_dir(spark, "parquet"), partition_by=["o_orderpriority"])
    back = read_parquet(spark, path)
    return back.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
