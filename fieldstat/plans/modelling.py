"""Queries of k-NN, metrics, clustering and Spark ML over ``embeddings``.

The modelling set is ``embeddings``: id = vec_id, class = 'L' || label, features =
the 64-dim vector. Train / test is the stratified split E4 (80 % by percent rank
of md5(vec_id) within the class), so every row is used.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldstat.functions.columns import cluster_name, normal_quantile_sql
from fieldstat.operators import clusters as C, knn as K, metrics as M, models as ML, stats as S
from fieldstat.operators.basic import merge_rankings, param_grid
from fieldstat.operators.ranking import stratified_folds, stratified_split
from fieldstat.operators.tree_search import NESTED
from fieldstat.plans.adapters import table
from fieldstat.plans.registry import query
from fieldstat.session import materialise, shared_dir
from fieldstat.sources.io import input_state

LEVELS = [f"L{i}" for i in range(10)]
DIMS = 64
K_BEST, P_BEST = 21, 1
FEATS = [f"f{i}" for i in range(DIMS)]

SPLIT_CTE = """
base AS (SELECT vec_id, 'L' || CAST(label AS VARCHAR) AS label, embedding,
                PERCENT_RANK() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR))) <= 0.8 AS is_train
         FROM embeddings),
long AS (SELECT vec_id, label, is_train, CAST(UNNEST(embedding) AS DOUBLE) AS x,
                generate_subscripts(embedding, 1) - 1 AS dim FROM base),
st AS (SELECT dim, AVG(x) AS m, COALESCE(NULLIF(STDDEV_SAMP(x), 0), 1) AS s FROM long WHERE is_train GROUP BY dim),
z AS (SELECT l.vec_id, l.label, l.is_train, l.dim, (l.x - st.m) / st.s AS z FROM long l JOIN st USING (dim))"""

KNN_CTE = SPLIT_CTE + f""",
d AS (SELECT q.vec_id AS qid, r.vec_id AS rid, r.label AS rlabel, SUM(ABS(q.z - r.z)) AS dist
      FROM z q JOIN z r ON q.dim = r.dim AND NOT q.is_train AND r.is_train GROUP BY q.vec_id, r.vec_id, r.label),
nb AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY qid ORDER BY dist, rid) AS rn FROM d) x
       WHERE rn <= {K_BEST}),
votes AS (SELECT qid, rlabel, COUNT(*) AS score FROM nb GROUP BY qid, rlabel),
pred AS (SELECT qid, rlabel AS prediction FROM (
           SELECT *, ROW_NUMBER() OVER (PARTITION BY qid ORDER BY score DESC, rlabel) AS o FROM votes) v WHERE o = 1),
res AS (SELECT b.vec_id AS qid, b.label, p.prediction FROM base b JOIN pred p ON p.qid = b.vec_id WHERE NOT b.is_train)"""


def modelling(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    df = e.select(F.col("vec_id").alias("id"), F.concat(F.lit("L"), F.col("label").cast("string")).alias("label"),
                  F.transform("embedding", lambda x: x.cast("double")).alias("vec"))
    return stratified_split(df, "label", 0.8, key=F.md5(F.col("id").cast("string")))


def split(spark, sf_dir):
    s = modelling(spark, sf_dir)
    return s.where("is_train").drop("is_train"), s.where("NOT is_train").drop("is_train")


def rows_state(spark, sf_dir):
    return input_state(spark, f"{sf_dir.rstrip('/')}/embeddings.parquet")


_RESULTS: dict[tuple[str, str], str] = {}


def knn_result(spark, sf_dir):
    """k-NN predictions of the test rows. The metric queries of a session share one written
    result for each state of the input files (paths, sizes, times)."""
    key = (spark.sparkContext.applicationId, rows_state(spark, sf_dir))
    if key not in _RESULTS:
        tr, te = split(spark, sf_dir)
        path = shared_dir(spark, "knn-result")
        K.knn_predict(tr, te, K_BEST, P_BEST, "rectangular", levels=LEVELS).write.parquet(path)
        _RESULTS[key] = path
    return spark.read.parquet(_RESULTS[key])


@query("standardise", "WITH " + SPLIT_CTE.strip() + "\nSELECT vec_id, dim, ROUND(z, 6) AS z FROM z WHERE NOT is_train")
def q_standardise(spark, sf_dir):
    """K3: test rows standardised with the training statistics (long format)."""
    tr, te = split(spark, sf_dir)
    z = K.scale_with(tr, te)
    return z.select(F.col("id").alias("vec_id"), F.posexplode("vec").alias("dim", "z")) \
            .select("vec_id", F.col("dim").cast("bigint").alias("dim"), F.round("z", 6).alias("z"))


@query("knn_predict", "WITH " + KNN_CTE.strip() + "\nSELECT qid, label, prediction FROM res")
def q_knn_predict(spark, sf_dir):
    """Exact Manhattan k-NN (k = 21) of the test rows against the training rows."""
    return knn_result(spark, sf_dir).select("qid", "label", "prediction")


@query("knn_proba", "WITH " + KNN_CTE.strip() + f"""
SELECT qid, rlabel AS class, ROUND(score / {K_BEST}, 6) AS share FROM votes""")
def q_knn_proba(spark, sf_dir):
    """Neighbour vote shares as class probabilities (classes with a vote)."""
    r = knn_result(spark, sf_dir)
    return r.select("qid", F.explode("proba").alias("class", "share")) \
            .select("qid", "class", F.round("share", 6).alias("share"))


@query("confusion", "WITH " + KNN_CTE.strip() + ", lv AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{l}')" for l in LEVELS) + ") t(c))\nSELECT p.c AS predicted, " + ", ".join(
    f"CAST(SUM(CASE WHEN r.label = '{l}' THEN 1 ELSE 0 END) AS BIGINT) AS {l}" for l in LEVELS)
    + " FROM lv p LEFT JOIN res r ON r.prediction = p.c GROUP BY p.c")
def q_confusion(spark, sf_dir):
    """M1: confusion matrix of the k-NN predictions, rows = predicted, all levels."""
    return M.confusion(knn_result(spark, sf_dir), LEVELS)


_MARG = ", lv AS (SELECT * FROM (VALUES " + ", ".join(f"('{l}')" for l in LEVELS) + """) t(c)),
mg AS (SELECT lv.c AS cls,
              (SELECT COUNT(*) FROM res WHERE label = lv.c AND prediction = lv.c) AS tp,
              (SELECT COUNT(*) FROM res WHERE prediction = lv.c) AS n_pred,
              (SELECT COUNT(*) FROM res WHERE label = lv.c) AS n_true,
              (SELECT COUNT(*) FROM res) AS n FROM lv)"""


@query("overall", "WITH " + KNN_CTE.strip() + _MARG + """
SELECT ROUND(SUM(tp) / MAX(n), 4) AS accuracy,
       ROUND((SUM(tp) / MAX(n) - SUM(n_pred * n_true) / (MAX(n) * MAX(n))) / (1 - SUM(n_pred * n_true) / (MAX(n) * MAX(n))), 4) AS kappa,
       ROUND(MAX(n_true) / MAX(n), 4) AS no_information_rate,
       CAST(MAX(n) - SUM(tp) AS BIGINT) AS errors, CAST(MAX(n) AS BIGINT) AS n FROM mg""")
def q_overall(spark, sf_dir):
    """M2: accuracy, kappa, no-information rate."""
    return M.overall(knn_result(spark, sf_dir), LEVELS)


_BYCLASS = """
bc AS (SELECT cls AS class,
       CASE WHEN n_pred > 0 THEN tp / n_pred END AS precision,
       CASE WHEN n_true > 0 THEN tp / n_true END AS recall,
       CASE WHEN n - n_pred - n_true + tp + n_pred - tp > 0 THEN (n - n_pred - n_true + tp) / (n - n_true) END AS spec
       FROM mg)"""


@query("by_class", "WITH " + KNN_CTE.strip() + _MARG + "," + _BYCLASS + """
SELECT class, ROUND(precision, 4) AS precision, ROUND(recall, 4) AS recall,
       ROUND(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) END, 4) AS f1,
       ROUND((recall + spec) / 2, 4) AS balanced_accuracy FROM bc""")
def q_by_class(spark, sf_dir):
    """M3: per-class precision, recall, F1, balanced accuracy."""
    return M.by_class(knn_result(spark, sf_dir), LEVELS)


@query("macro", "WITH " + KNN_CTE.strip() + _MARG + "," + _BYCLASS + """,
b2 AS (SELECT precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) END AS f1,
              (recall + spec) / 2 AS bal FROM bc)
SELECT ROUND(AVG(precision), 4) AS macro_precision, ROUND(AVG(recall), 4) AS macro_recall,
       ROUND(AVG(f1), 4) AS macro_f1, ROUND(AVG(bal), 4) AS macro_balanced_accuracy FROM b2""")
def q_macro(spark, sf_dir):
    """M4: macro means ignoring undefined classes."""
    return M.macro(M.by_class(knn_result(spark, sf_dir), LEVELS, digits=None))


@query("weighted_f1", "WITH " + KNN_CTE.strip() + _MARG + """
SELECT ROUND(SUM(n_true * COALESCE(CASE WHEN n_pred + n_true > 0 THEN 2.0 * tp / (n_pred + n_true) END, 0)) / SUM(n_true), 4)
       AS weighted_f1 FROM mg""")
def q_weighted_f1(spark, sf_dir):
    """M5: weighted F1 (undefined F1 counts 0)."""
    return M.weighted_f1(knn_result(spark, sf_dir), LEVELS)


@query("multiclass_auc", "WITH " + KNN_CTE.strip() + """,
sc AS (SELECT b.qid, b.label, l.c AS cls, COALESCE(v.score, 0) / """ + str(K_BEST) + """.0 AS p
       FROM res b CROSS JOIN (SELECT DISTINCT label AS c FROM res) l
       LEFT JOIN votes v ON v.qid = b.qid AND v.rlabel = l.c),
pairs AS (SELECT a.c AS ci, b.c AS cj FROM (SELECT DISTINCT label AS c FROM res) a, (SELECT DISTINCT label AS c FROM res) b WHERE a.c <> b.c),
aij AS (SELECT pr.ci, pr.cj,
          (SELECT SUM(CASE WHEN x.p > y.p THEN 1.0 WHEN x.p = y.p THEN 0.5 ELSE 0 END)
           FROM sc x JOIN sc y ON x.cls = pr.ci AND y.cls = pr.ci AND x.label = pr.ci AND y.label = pr.cj)
          / ((SELECT COUNT(*) FROM res WHERE label = pr.ci) * (SELECT COUNT(*) FROM res WHERE label = pr.cj)) AS a
        FROM pairs pr)
SELECT ROUND(AVG(a), 4) AS auc, CAST(COUNT(*) / 2 AS BIGINT) AS pairs FROM aij""")
def q_multiclass_auc(spark, sf_dir):
    """M6: Hand-Till multiclass AUC of the k-NN vote shares (classes present in the test set)."""
    r = knn_result(spark, sf_dir)
    present = sorted(x.label for x in r.select("label").distinct().collect())   # <= #classes rows
    sc = r.select("qid", "label", *[F.coalesce(F.col("proba")[c], F.lit(0.0)).alias(f"p_{c}") for c in present])
    return M.multiclass_auc(sc, "label", {c: f"p_{c}" for c in present})


@query("error_pairs", "WITH " + KNN_CTE.strip() + """,
o AS (SELECT list_position(""" + str(LEVELS) + """, label) AS a, list_position(""" + str(LEVELS) + """, prediction) AS b
      FROM res WHERE label <> prediction)
SELECT """ + str(LEVELS) + """[LEAST(a, b)] AS class_a, """ + str(LEVELS) + """[GREATEST(a, b)] AS class_b,
       COUNT(*) AS n, GREATEST(a, b) - LEAST(a, b) = 1 AS adjacent FROM o GROUP BY LEAST(a, b), GREATEST(a, b)""")
def q_error_pairs(spark, sf_dir):
    """Misclassifications per unordered class pair, adjacency flagged."""
    return S.error_pairs(knn_result(spark, sf_dir), "label", "prediction", LEVELS)


# FIXED VALUES: the searched settings (k, distance, kernel) of the three scenarios.
KNN_SCENARIOS = {
    "S1": [(k, 2, "rectangular") for k in (1, 3, 5, 7, 9, 11, 15, 21, 31, 51)],
    "S2": [(k, 2, kernel) for k in (5, 9, 15, 21, 31) for kernel in K.KERNELS],
    "S3": [(k, p, "rectangular") for k in (5, 9, 15, 21, 31) for p in (1, 2, 3)],
}
GRID = sorted({setting for settings in KNN_SCENARIOS.values() for setting in settings})
_U = "LEAST(GREATEST(COALESCE(dist / NULLIF(nxt, 0), 0), 1e-6), 1 - 1e-6)"


def _f1_sql(keys: str, pred: str) -> str:
    """Weighted F1 of the predictions ``pred`` (keys, label, prediction) per keys; undefined F1 counts 0."""
    return f"""
SELECT {keys}, SUM(n_true * COALESCE(2.0 * n_hit / NULLIF(n_true + n_pred, 0), 0)) / SUM(n_true) AS f1 FROM (
  SELECT {keys}, c, SUM(is_true) AS n_true, SUM(is_pred) AS n_pred, SUM(is_hit) AS n_hit FROM (
    SELECT {keys}, label AS c, 1 AS is_true, 0 AS is_pred, CAST(label = prediction AS INTEGER) AS is_hit FROM {pred}
    UNION ALL SELECT {keys}, prediction, 0, 1, 0 FROM {pred}) GROUP BY {keys}, c) GROUP BY {keys}"""


KNN_GRID_CTE = "WITH " + SPLIT_CTE.strip() + f""",
t AS (SELECT vec_id, label, (ROW_NUMBER() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR))) - 1) % 10 AS fold
      FROM base WHERE is_train),
lf AS (SELECT l.vec_id, t.label, t.fold, l.dim, l.x FROM long l JOIN t ON t.vec_id = l.vec_id),
fs AS (SELECT g, dim, AVG(x) AS m, COALESCE(NULLIF(STDDEV_SAMP(x), 0), 1) AS s FROM lf, range(10) f(g) WHERE fold <> g GROUP BY g, dim),
zq AS (SELECT fs.g, vec_id, lf.dim, (x - m) / s AS z FROM lf JOIN fs ON fs.g = lf.fold AND fs.dim = lf.dim),
zr AS (SELECT fs.g, vec_id, label, lf.dim, (x - m) / s AS z FROM lf JOIN fs ON fs.g <> lf.fold AND fs.dim = lf.dim),
pr AS (SELECT q.g, q.vec_id AS qid, r.vec_id AS rid, r.label, SUM(ABS(q.z - r.z)) AS d1, SQRT(SUM((q.z - r.z) * (q.z - r.z))) AS d2,
              POW(SUM(POW(ABS(q.z - r.z), 3)), 1.0 / 3) AS d3
       FROM zq q JOIN zr r ON q.g = r.g AND q.dim = r.dim GROUP BY q.g, q.vec_id, r.vec_id, r.label),
ds AS (SELECT g, qid, rid, label, UNNEST([1, 2, 3]) AS p, UNNEST([d1, d2, d3]) AS dist FROM pr),
nb AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY p, g, qid ORDER BY dist, rid) AS rn FROM ds QUALIFY rn <= 52),
gr AS (SELECT * FROM (VALUES {', '.join(f"({k}, {p}, '{kernel}')" for k, p, kernel in GRID)}) v(k, p, kernel)),
x AS (SELECT gr.k, gr.p, gr.kernel, nb.g, qid, label, dist, rn,
             COALESCE(MAX(CASE WHEN rn = gr.k + 1 THEN dist END) OVER o, MAX(dist) OVER o) AS nxt
      FROM nb JOIN gr ON gr.p = nb.p AND rn <= gr.k + 1 WINDOW o AS (PARTITION BY gr.k, gr.p, gr.kernel, nb.g, qid)),
w AS (SELECT k, p, kernel, g, qid, label,
             CASE kernel WHEN 'rectangular' THEN 1.0 WHEN 'triangular' THEN 1 - {_U} WHEN 'inv' THEN 1 / {_U}
                         ELSE exp(-pow({_U} * abs({normal_quantile_sql('(CAST(1 AS DOUBLE) / (2 * (k + 1)))')}), 2) / 2) END AS wt
      FROM x WHERE rn <= k),
v AS (SELECT k, p, kernel, g, qid, label, SUM(wt) AS score FROM w GROUP BY ALL),
pd AS (SELECT k, p, kernel, g, qid, MIN({{'a': -score, 'b': list_position({LEVELS}, label)}})['b'] AS pos FROM v GROUP BY ALL),
res AS (SELECT k, p, kernel, g, t.label, {LEVELS}[pos] AS prediction FROM pd JOIN t ON t.vec_id = pd.qid),
f AS ({_f1_sql('k, p, kernel, g', 'res')}),
o AS (SELECT k, p, kernel, ROUND(AVG(f1), 4) AS f1, ROUND(STDDEV_SAMP(f1), 4) AS f1_sd, ROUND(STDDEV_SAMP(f1) / sqrt(COUNT(f1)), 4) AS f1_se
      FROM f GROUP BY ALL)"""


def knn_search(spark, sf_dir):
    """The k-NN grid (k, distance, kernel, f1, f1_sd, f1_se) over shared folds, found once in a session for a state of the input."""
    key = (spark.sparkContext.applicationId, f"grid {rows_state(spark, sf_dir)}")
    if key not in _RESULTS:
        tr, _ = split(spark, sf_dir)
        tr = stratified_folds(tr, "label", 10, key=F.md5(F.col("id").cast("string")))
        path = shared_dir(spark, "knn-grid")
        K.knn_grid(tr, spark.createDataFrame(GRID, "k int, distance int, kernel string"), 10, levels=LEVELS).write.parquet(path)
        _RESULTS[key] = path
    return spark.read.parquet(_RESULTS[key])


@query("knn_grid", KNN_GRID_CTE + """
SELECT CAST(k AS INTEGER) AS k, CAST(p AS DOUBLE) AS distance, kernel, f1, f1_sd, f1_se, f1 - f1_se AS lower, f1 + f1_se AS upper FROM o""")
def q_knn_grid(spark, sf_dir):
    """L14 (+C9, E9, J8): stratified 10-fold CV of a k x distance x kernel grid."""
    from fieldstat.operators.distribution import error_bars
    return error_bars(knn_search(spark, sf_dir), "f1", "f1_se")


@query("knn_scenarios", KNN_GRID_CTE + """,
sc AS (SELECT * FROM (VALUES """ + ", ".join(f"('{name}', {k}, {p}, '{kernel}')" for name, sets in KNN_SCENARIOS.items()
                                             for k, p, kernel in sets) + """) v(scenario, k, p, kernel)),
rk AS (SELECT scenario, o.*, ROW_NUMBER() OVER (PARTITION BY scenario ORDER BY f1 DESC, o.k, o.p, o.kernel) AS place,
              MAX(f1) OVER (PARTITION BY scenario) - MIN(f1) OVER (PARTITION BY scenario) AS spread
       FROM sc JOIN o ON o.k = sc.k AND o.p = sc.p AND o.kernel = sc.kernel)
SELECT scenario, CAST(k AS INTEGER) AS k, CAST(p AS DOUBLE) AS distance, kernel, f1, f1_sd, place = 1 AS best, ROUND(spread, 4) AS spread FROM rk""")
def q_knn_scenarios(spark, sf_dir):
    """The three scenario tables (45 settings), each with its best setting and the spread of its F1."""
    rows = [(name, k, float(p), kernel) for name, sets in KNN_SCENARIOS.items() for k, p, kernel in sets]
    listed = spark.createDataFrame(rows, "scenario string, k int, distance double, kernel string")
    return K.scenario_tables(knn_search(spark, sf_dir), listed)


@query("permutation_importance", "WITH " + SPLIT_CTE.strip() + f""",
q AS (SELECT vec_id, label, dim, z FROM z WHERE NOT is_train),
r AS (SELECT vec_id, label, dim, z FROM z WHERE is_train),
d0 AS (SELECT q.vec_id AS qid, r.vec_id AS rid, r.label, SUM(ABS(q.z - r.z)) AS d FROM q JOIN r ON q.dim = r.dim GROUP BY 1, 2, 3),
va AS (SELECT vec_id, label, dim, z, dim * 5 + rep AS variant FROM q, range(5) x(rep)),
a AS (SELECT vec_id, variant, dim, z, ROW_NUMBER() OVER (PARTITION BY variant ORDER BY md5('42:' || variant || ':' || vec_id), vec_id) AS pos FROM va),
b AS (SELECT variant, z AS new, ROW_NUMBER() OVER (PARTITION BY variant ORDER BY md5('43:' || variant || ':' || vec_id), vec_id) AS pos FROM va),
ch AS (SELECT a.vec_id AS qid, a.variant, a.dim, a.z AS old, b.new FROM a JOIN b ON a.variant = b.variant AND a.pos = b.pos),
dv AS (SELECT ch.variant, ch.qid, d0.rid, d0.label, d0.d - ABS(ch.old - r.z) + ABS(ch.new - r.z) AS dist
       FROM ch JOIN d0 ON d0.qid = ch.qid JOIN r ON r.vec_id = d0.rid AND r.dim = ch.dim
       UNION ALL SELECT -1, qid, rid, label, d FROM d0),
nn AS (SELECT * FROM dv QUALIFY ROW_NUMBER() OVER (PARTITION BY variant, qid ORDER BY dist, rid) <= {K_BEST}),
vo AS (SELECT variant, qid, label, COUNT(*) AS score FROM nn GROUP BY ALL),
pd AS (SELECT variant, qid, MIN({{'a': -score, 'b': list_position({LEVELS}, label)}})['b'] AS pos FROM vo GROUP BY ALL),
res AS (SELECT variant, b.label, {LEVELS}[pos] AS prediction FROM pd JOIN base b ON b.vec_id = pd.qid),
f AS ({_f1_sql('variant', 'res')}),
dr AS (SELECT variant // 5 AS dim, AVG((SELECT f1 FROM f WHERE variant = -1) - f1) AS drop_ FROM f WHERE variant >= 0 GROUP BY 1)
SELECT 'f' || CAST(dim AS VARCHAR) AS feature, ROUND(drop_, 4) AS importance,
       ROUND(GREATEST(drop_, 0) / NULLIF(SUM(GREATEST(drop_, 0)) OVER (), 0), 4) AS importance_norm FROM dr""")
def q_permutation_importance(spark, sf_dir):
    """Permutation importance of every feature (5 shuffles each) for the chosen k-NN."""
    tr, te = split(spark, sf_dir)
    return K.permutation_importance(tr, te, FEATS, K_BEST, P_BEST, reps=5,
                                    levels=LEVELS)


# ---------------------------------------------------------------- clustering with a rule-based assignment

_CL_RULE = "CASE WHEN embedding[{i}] < -0.055 THEN 'C1' WHEN embedding[{i}] < 0.055 THEN 'C2' ELSE 'C3' END"
CLUSTER_SQL = _CL_RULE.format(i=1)


def clustered(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    first = F.get(F.col("embedding"), 0)
    cl = F.when(first < -0.055, "C1").when(first < 0.055, "C2").otherwise("C3")
    return e.select(F.col("vec_id").alias("id"), F.concat(F.lit("L"), F.col("label").cast("string")).alias("label"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("vec"), cl.alias("cluster"))


CL_CTE = f"""
cl AS (SELECT vec_id, 'L' || CAST(label AS VARCHAR) AS label, {CLUSTER_SQL} AS cluster, embedding FROM embeddings),
cx AS (SELECT vec_id, label, cluster, CAST(UNNEST(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS dim FROM cl)"""


@query("sse", "WITH " + CL_CTE.strip() + """,
v AS (SELECT cluster, dim, (COUNT(x) - 1) * COALESCE(VAR_SAMP(x), 0) AS ss FROM cx GROUP BY 1, 2)
SELECT ROUND(SUM(ss), 4) AS SSE, ROUND(2 * SUM(ss), 4) AS W FROM v""")
def q_sse(spark, sf_dir):
    """SSE and W = 2 SSE of an assignment."""
    return C.sse(clustered(spark, sf_dir))


@query("w_pairs", "WITH " + CL_CTE.strip() + """,
p AS (SELECT a.cluster, SUM((a.x - b.x) * (a.x - b.x)) AS d2 FROM cx a JOIN cx b
      ON a.cluster = b.cluster AND a.dim = b.dim AND a.vec_id < b.vec_id GROUP BY a.cluster),
n AS (SELECT cluster, COUNT(*) AS n FROM cl GROUP BY 1)
SELECT ROUND(SUM(2 * d2 / n), 4) AS W_pairs FROM p JOIN n USING (cluster)""")
def q_w_pairs(spark, sf_dir):
    """W from within-cluster pairs (identity check against 2 SSE)."""
    return C.w_pairs(clustered(spark, sf_dir))


_PAIR_D = """,
pd AS (SELECT a.vec_id AS i, a.cluster AS ci, b.cluster AS cj, SUM((a.x - b.x) * (a.x - b.x)) AS d2
       FROM cx a JOIN cx b ON a.dim = b.dim AND a.vec_id <> b.vec_id GROUP BY a.vec_id, a.cluster, b.cluster, b.vec_id),
agg AS (SELECT i, ci, cj, AVG({d}) AS md, COUNT(*) AS n FROM pd GROUP BY i, ci, cj),
ab AS (SELECT i, ci, MAX(CASE WHEN ci = cj THEN md END) AS a, MIN(CASE WHEN ci <> cj THEN md END) AS b FROM agg GROUP BY i, ci),
sil AS (SELECT cl.vec_id AS id, cl.cluster, COALESCE((b - a) / GREATEST(a, b), 0.0) AS s FROM cl LEFT JOIN ab ON ab.i = cl.vec_id)"""


@query("silhouette_sq", "WITH " + CL_CTE.strip() + _PAIR_D.format(d="d2") + """
SELECT id, cluster, ROUND(s, 6) AS silhouette FROM sil""")
def q_silhouette_sq(spark, sf_dir):
    """Per-row squared-Euclidean silhouette in closed form (no pairs)."""
    s = C.silhouette_sq_rows(clustered(spark, sf_dir))
    return s.select("id", "cluster", F.round("silhouette", 6).alias("silhouette"))


@query("silhouette_rows", "WITH " + CL_CTE.strip() + _PAIR_D.format(d="sqrt(d2)") + """
SELECT id, cluster, ROUND(s, 6) AS silhouette FROM sil""")
def q_silhouette_rows(spark, sf_dir):
    """Per-row plain-Euclidean silhouette from block tiles."""
    s = C.silhouette_rows(clustered(spark, sf_dir))
    return s.select("id", "cluster", F.round("silhouette", 6).alias("silhouette"))


@query("purity", "WITH " + CL_CTE.strip() + """,
c AS (SELECT cluster, label, COUNT(*) AS n FROM cl GROUP BY 1, 2)
SELECT ROUND(SUM(m) / SUM(t), 4) AS purity FROM (SELECT cluster, MAX(n) AS m, SUM(n) AS t FROM c GROUP BY 1) x""")
def q_purity(spark, sf_dir):
    """Purity of the assignment against the class."""
    return C.purity(clustered(spark, sf_dir), "cluster", "label")


@query("ari", "WITH " + CL_CTE.strip() + """,
c AS (SELECT cluster, label, COUNT(*) AS n FROM cl GROUP BY 1, 2),
s AS (SELECT (SELECT SUM(n * (n - 1) / 2.0) FROM c) AS sij,
             (SELECT SUM(r * (r - 1) / 2.0) FROM (SELECT SUM(n) AS r FROM c GROUP BY cluster) a) AS si,
             (SELECT SUM(r * (r - 1) / 2.0) FROM (SELECT SUM(n) AS r FROM c GROUP BY label) b) AS sj,
             (SELECT SUM(n) FROM c) AS n)
SELECT ROUND((sij - si * sj / (n * (n - 1) / 2.0)) / (0.5 * (si + sj) - si * sj / (n * (n - 1) / 2.0)), 4) AS ari FROM s""")
def q_ari(spark, sf_dir):
    """Adjusted Rand index between assignment and class."""
    return C.ari(clustered(spark, sf_dir), "cluster", "label")


@query("cluster_sizes", "WITH " + CL_CTE.strip() + """
SELECT MIN(n) AS smallest, MAX(n) AS largest, COUNT(*) AS k FROM (SELECT cluster, COUNT(*) AS n FROM cl GROUP BY 1) x""")
def q_cluster_sizes(spark, sf_dir):
    """Smallest / largest cluster."""
    return C.cluster_sizes(clustered(spark, sf_dir), "cluster")


@query("explained_share", "WITH " + CL_CTE.strip() + """,
w AS (SELECT SUM(ss) AS sse FROM (SELECT (COUNT(x) - 1) * COALESCE(VAR_SAMP(x), 0) AS ss FROM cx GROUP BY cluster, dim) a),
t AS (SELECT SUM(ss) AS sse FROM (SELECT (COUNT(x) - 1) * COALESCE(VAR_SAMP(x), 0) AS ss FROM cx GROUP BY dim) b)
SELECT ROUND(1 - w.sse / t.sse, 4) AS explained_share, ROUND(t.sse, 4) AS SSE_1 FROM w, t""")
def q_explained_share(spark, sf_dir):
    """1 - SSE(k) / SSE(1)."""
    return C.explained_share(clustered(spark, sf_dir))


@query("centroids", "WITH " + CL_CTE.strip() + """
SELECT cluster, dim - 1 AS dim, ROUND(AVG(x), 6) AS centroid, COUNT(*) AS n FROM cx GROUP BY cluster, dim""")
def q_centroids(spark, sf_dir):
    """Cluster centroids (long format) with sizes."""
    c = C.centroid_arrays(clustered(spark, sf_dir))
    return c.select("cluster", F.posexplode("centroid").alias("dim", "centroid"), "n") \
            .select("cluster", F.col("dim").cast("bigint").alias("dim"), F.round("centroid", 6).alias("centroid"), "n")


@query("cluster_dominant", "WITH " + CL_CTE.strip() + """,
c AS (SELECT cluster, label, COUNT(*) AS cnt FROM cl GROUP BY 1, 2),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY cnt DESC, label) AS rn, SUM(cnt) OVER (PARTITION BY cluster) AS n FROM c)
SELECT cluster, label AS dominant, cnt AS dominant_n, CAST(n AS BIGINT) AS n, ROUND(cnt / n, 4) AS dominant_share FROM r WHERE rn = 1""")
def q_cluster_dominant(spark, sf_dir):
    """Dominant class per cluster."""
    return S.dominant(clustered(spark, sf_dir), "cluster", "label")


@query("supergroup_agreement", "WITH " + CL_CTE.strip() + """
SELECT ROUND(AVG(CASE WHEN cluster = CASE WHEN label IN ('L0', 'L1', 'L2') THEN 'C1' WHEN label IN ('L3', 'L4', 'L5', 'L6') THEN 'C2'
                                          ELSE 'C3' END THEN 1.0 ELSE 0.0 END), 4) AS agreement, COUNT(*) AS n FROM cl""")
def q_supergroup_agreement(spark, sf_dir):
    """Share of rows in the cluster expected for their class group."""
    exp = {**{l: "C1" for l in LEVELS[:3]}, **{l: "C2" for l in LEVELS[3:7]}, **{l: "C3" for l in LEVELS[7:]}}
    return S.supergroup_agreement(clustered(spark, sf_dir), "cluster", "label", exp)


@query("cluster_anova", "WITH " + CL_CTE.strip() + """,
o AS (SELECT dim, AVG(x) AS mu, COUNT(x) AS nn, COUNT(DISTINCT cluster) AS k FROM cx GROUP BY 1),
g AS (SELECT dim, cluster, AVG(x) AS m FROM cx GROUP BY 1, 2),
f AS (SELECT cx.dim, SUM((m - mu) * (m - mu)) AS between_, SUM((x - m) * (x - m)) AS within_, MAX(nn) AS nn, MAX(k) AS k
      FROM cx JOIN g ON g.dim = cx.dim AND g.cluster = cx.cluster JOIN o ON o.dim = cx.dim GROUP BY cx.dim)
SELECT 'f' || CAST(dim - 1 AS VARCHAR) AS feature, ROUND((between_ / (k - 1)) / (within_ / (nn - k)), 1) AS f_value FROM f""")
def q_cluster_anova(spark, sf_dir):
    """Features that separate clusters (ANOVA F of all dimensions)."""
    c = clustered(spark, sf_dir)
    wide = c.select("cluster", *[F.get("vec", i).alias(f"f{i}") for i in range(DIMS)])
    return S.anova_f(wide, FEATS, "cluster")


@query("cluster_class", "WITH " + CL_CTE.strip() + """,
c AS (SELECT cluster, label, COUNT(*) AS n FROM cl GROUP BY 1, 2)
SELECT cluster, label, n, ROUND(n / SUM(n) OVER (PARTITION BY cluster), 4) AS cluster_share,
       ROUND(n / SUM(n) OVER (PARTITION BY label), 4) AS class_coverage FROM c""")
def q_cluster_class(spark, sf_dir):
    """Cluster x class counts with each cell's share of its cluster and of its class."""
    return C.class_table(clustered(spark, sf_dir), "cluster", "label")


@query("centroids_standardised", "WITH " + CL_CTE.strip() + """,
st AS (SELECT dim, AVG(x) AS m, STDDEV_SAMP(x) AS s FROM cx GROUP BY dim)
SELECT cluster, cx.dim - 1 AS dim, ROUND(AVG((x - m) / s), 6) AS centroid, COUNT(*) AS n FROM cx JOIN st ON st.dim = cx.dim
GROUP BY cluster, cx.dim""")
def q_centroids_standardised(spark, sf_dir):
    """Centroids in standardised units."""
    c = clustered(spark, sf_dir)
    z = C.centroid_arrays(K.scale_with(c, c))
    return z.select("cluster", F.posexplode("centroid").alias("dim", "centroid"), "n") \
            .select("cluster", F.col("dim").cast("bigint").alias("dim"), F.round("centroid", 6).alias("centroid"), "n")


@query("silhouette_summary", "WITH " + CL_CTE.strip() + _PAIR_D.format(d="sqrt(d2)") + """
SELECT cluster, COUNT(*) AS n, ROUND(AVG(s), 4) AS mean_silhouette, ROUND(AVG(CASE WHEN s < 0 THEN 1.0 ELSE 0 END), 4) AS negative_share
FROM sil GROUP BY GROUPING SETS ((cluster), ())""")
def q_silhouette_summary(spark, sf_dir):
    """Mean silhouette and negative share per cluster and overall (NULL cluster)."""
    return C.silhouette_summary(C.silhouette_rows(clustered(spark, sf_dir)))


@query("assignments", "WITH " + CL_CTE.strip() + _PAIR_D.format(d="sqrt(d2)") + """
SELECT sil.id, sil.cluster, cl.label, ROUND(s, 6) AS silhouette FROM sil JOIN cl ON cl.vec_id = sil.id""")
def q_assignments(spark, sf_dir):
    """Assignment export (id, cluster, class, silhouette), written and read back."""
    c = clustered(spark, sf_dir)
    s = C.silhouette_rows(c).select("id", "cluster", F.round("silhouette", 6).alias("silhouette"))
    path = shared_dir(spark, "assignments")
    s.join(c.select("id", "label"), "id").select("id", "cluster", "label", "silhouette").write.parquet(path)
    return spark.read.parquet(path)


@query("adjacent_error_share", "WITH " + KNN_CTE.strip() + """,
o AS (SELECT list_position(""" + str(LEVELS) + """, label) AS a, list_position(""" + str(LEVELS) + """, prediction) AS b
      FROM res WHERE label <> prediction)
SELECT COUNT(*) AS errors, ROUND(AVG(CASE WHEN abs(a - b) = 1 THEN 1.0 ELSE 0 END), 4) AS adjacent_share FROM o""")
def q_adjacent_error_share(spark, sf_dir):
    """Share of all errors that fall between adjacent classes."""
    return S.adjacent_error_share(S.error_pairs(knn_result(spark, sf_dir), "label", "prediction", LEVELS))


_KERNEL_U = "LEAST(GREATEST(COALESCE(dist / NULLIF(nxt, 0), 0), 1e-6), 1 - 1e-6)"


@query("knn_kernels", "WITH " + SPLIT_CTE.strip() + f""",
d AS (SELECT q.vec_id AS qid, r.vec_id AS rid, r.label AS rlabel, sqrt(SUM((q.z - r.z) * (q.z - r.z))) AS dist
      FROM z q JOIN z r ON q.dim = r.dim AND NOT q.is_train AND r.is_train GROUP BY q.vec_id, r.vec_id, r.label),
nb AS (SELECT *, MAX(dist) FILTER (WHERE rn = 10) OVER (PARTITION BY qid) AS nxt FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY qid ORDER BY dist, rid) AS rn FROM d) x WHERE rn <= 10),
w AS (SELECT qid, rlabel, UNNEST([{{'kernel': 'triangular', 'w': 1 - {_KERNEL_U}}}, {{'kernel': 'inv', 'w': 1 / {_KERNEL_U}}},
             {{'kernel': 'gaussian', 'w': exp(-pow({_KERNEL_U} * abs({normal_quantile_sql('CAST(0.05 AS DOUBLE)')}), 2) / 2)}}], recursive := true)
      FROM nb WHERE rn <= 9),
v AS (SELECT qid, kernel, rlabel, SUM(w) AS score FROM w GROUP BY 1, 2, 3)
SELECT qid, kernel, MIN({{'neg': -score, 'c': rlabel}})['c'] AS prediction, ROUND(MAX(score) / SUM(score), 6) AS share
FROM v GROUP BY 1, 2""")
def q_knn_kernels(spark, sf_dir):
    """Weighted votes of the 9 nearest (Euclidean) under the other three kernels."""
    tr, te = split(spark, sf_dir)
    nb = K.neighbours(K.scale_with(tr, te), K.scale_with(tr, tr), 10, 2)
    out = None
    for kernel in ("triangular", "inv", "gaussian"):
        v = K.vote(nb, 9, kernel, LEVELS).select("qid", F.lit(kernel).alias("kernel"), "prediction",
                                                 F.round(F.array_max(F.map_values("proba")), 6).alias("share"))
        out = v if out is None else out.unionByName(v)
    return out


@query("knn_pivots", "WITH " + SPLIT_CTE.strip() + """,
d AS (SELECT q.vec_id AS qid, r.vec_id AS rid, sqrt(SUM((q.z - r.z) * (q.z - r.z))) AS dist
      FROM z q JOIN z r ON q.dim = r.dim AND NOT q.is_train AND r.is_train GROUP BY q.vec_id, r.vec_id),
nb AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY qid ORDER BY dist, rid) AS INTEGER) AS rn FROM d)
SELECT qid, rn, rid, ROUND(dist, 6) AS dist FROM nb WHERE rn <= 5""")
def q_knn_pivots(spark, sf_dir):
    """The five nearest (Euclidean) of every test row, by pivot cells."""
    tr, te = split(spark, sf_dir)
    nb = K.pivot_neighbours(K.scale_with(tr, te), K.scale_with(tr, tr), 5, 2)
    return nb.select("qid", "rn", "rid", F.round("dist", 6).alias("dist"))


# ---------------------------------------------------------------- Spark ML (rows only)

def wide(spark, sf_dir):
    tr, te = split(spark, sf_dir)
    w = lambda d: d.select("id", "label", *[F.get("vec", i).alias(f"f{i}") for i in range(DIMS)])
    return w(tr), w(te)


@query("tree")
def q_tree(spark, sf_dir):
    """Decision tree (entropy, depth 5) predictions with class probabilities."""
    tr, te = wide(spark, sf_dir)
    m = ML.fit(tr, FEATS, ML.tree(impurity="entropy", maxDepth=5))
    return ML.predict(m, te)


@query("tree_importance")
def q_tree_importance(spark, sf_dir):
    """Impurity importances of the tree."""
    tr, _ = wide(spark, sf_dir)
    m = ML.fit(tr, FEATS, ML.tree(impurity="entropy", maxDepth=5))
    return ML.importance(spark, m, FEATS)


CHOSEN_TREE = {"impurity": "entropy", "maxDepth": 5}
CHOSEN_FOREST = {"numTrees": 500, "maxDepth": 5}


def folded(spark, sf_dir):
    """Training rows, wide, with the ten stratified folds that all methods share."""
    tr, _ = wide(spark, sf_dir)
    return stratified_folds(tr, "label", 10, key=F.md5(F.col("id").cast("string")))


@query("forest")
def q_forest(spark, sf_dir):
    """Random forest (500 trees, depth 5) predictions with class probabilities."""
    tr, te = wide(spark, sf_dir)
    return ML.predict(ML.fit(tr, FEATS, ML.forest(**CHOSEN_FOREST)), te)


@query("forest_summary")
def q_forest_summary(spark, sf_dir):
    """Model size of the forest (depth, node counts, rules)."""
    tr, _ = wide(spark, sf_dir)
    return ML.model_summary(spark, ML.fit(tr, FEATS, ML.forest(**CHOSEN_FOREST)))


def tree_search(spark, sf_dir):
    """The search over all tree scenarios (table, best set); its scores are found once in a session."""
    return ML.search(folded(spark, sf_dir), FEATS, ML.tree, ML.TREE_SCENARIOS, nested=NESTED, memo=f"tree {rows_state(spark, sf_dir)}")


def forest_search(spark, sf_dir):
    """The search over all forest scenarios, as ``tree_search``."""
    return ML.search(folded(spark, sf_dir), FEATS, ML.forest, ML.FOREST_SCENARIOS, memo=f"forest {rows_state(spark, sf_dir)}")


@query("tree_cv")
def q_tree_cv(spark, sf_dir):
    """10-fold CV of all tree scenarios on shared stratified folds, ranked."""
    return tree_search(spark, sf_dir)[0]


@query("tree_refit")
def q_tree_refit(spark, sf_dir):
    """The best tree of the best scenario, refitted on the whole training set; test predictions."""
    tr, te = wide(spark, sf_dir)
    return ML.predict(ML.fit(tr, FEATS, ML.tree(**tree_search(spark, sf_dir)[1])), te)


@query("forest_cv")
def q_forest_cv(spark, sf_dir):
    """10-fold CV of all forest scenarios on the same folds, ranked."""
    return forest_search(spark, sf_dir)[0]


@query("forest_refit")
def q_forest_refit(spark, sf_dir):
    """The best forest of the best scenario, refitted on the whole training set; test predictions."""
    tr, te = wide(spark, sf_dir)
    return ML.predict(ML.fit(tr, FEATS, ML.forest(**forest_search(spark, sf_dir)[1])), te)


@query("pca")
def q_pca(spark, sf_dir):
    """K4: explained variance of every component."""
    tr, te = wide(spark, sf_dir)
    return ML.explained(tr.unionByName(te), FEATS)


@query("pca_count")
def q_pca_count(spark, sf_dir):
    """The number of components that explain 90 %."""
    tr, te = wide(spark, sf_dir)
    return ML.n_components(ML.explained(tr.unionByName(te), FEATS), 0.9)


@query("pca_scores")
def q_pca_scores(spark, sf_dir):
    """K5, H4: the first two component scores of every row with class and cluster (k = 3)."""
    tr, te = wide(spark, sf_dir)
    scores, _ = ML.pca(tr.unionByName(te), FEATS, 2)
    _, assigned = ML.kmeans(ML.sized(scores.select("id", "label", "features", "pcs")), 3)
    pcs = ML.vector_to_array("pcs")
    return assigned.select("id", "label", cluster_name("prediction").alias("cluster"), F.get(pcs, 0).alias("pc1"), F.get(pcs, 1).alias("pc2"))


def scaled(df, with_mean=True):
    """Id, class and standardised features: what the k-means queries keep and read again."""
    return ML.Pipeline(stages=ML.prepare_stages(FEATS, None, with_mean=with_mean)).fit(df).transform(df).select("id", "label", "features")


KS = range(2, 11)
_SWEEP = ("space string, k int, W double, SSE double, silhouette double, smallest long, largest long, purity double, ari double")


def prepared(spark, sf_dir):
    """All rows with standardised features and with their components up to 90 % (N3's two spaces)."""
    tr, te = wide(spark, sf_dir)
    df = tr.unionByName(te)
    scores, explained = ML.pca(df, FEATS, DIMS)
    n = ML.n_components(explained, 0.9).head()[0] or DIMS
    some = F.slice(ML.vector_to_array("pcs"), 1, n)
    return ML.sized(scores.select("id", "label", "features", ML.array_to_vector(some).alias("components")))


def sweeps(spark, prep):
    rows = [(space, *[r[c] for c in ("k", "W", "SSE", "silhouette", "smallest", "largest", "purity", "ari")])
            for space, col in (("features", "features"), ("components", "components"))
            for r in ML.sweep(prep, KS, features=col)]
    return spark.createDataFrame(rows, _SWEEP)


@query("kmeans_sweep")
def q_kmeans_sweep(spark, sf_dir):
    """k = 2..10 over the features with W, silhouette, purity, ARI, elbow drop."""
    tr, te = wide(spark, sf_dir)
    df = tr.unionByName(te)
    prep = ML.sized(scaled(df)).persist()
    rows = [("features", *[r[c] for c in ("k", "W", "SSE", "silhouette", "smallest", "largest", "purity", "ari")])
            for r in ML.sweep(prep, KS)]
    prep.unpersist()
    return S.relative_drop(spark.createDataFrame(rows, _SWEEP), "k", "W", "drop_W")


@query("kmeans_spaces")
def q_kmeans_spaces(spark, sf_dir):
    """The sweep in both spaces; the best row (largest silhouette) flagged."""
    prep = prepared(spark, sf_dir).persist()
    res = sweeps(spark, prep)
    prep.unpersist()
    top = S.argmax(res, "silhouette", ["space", "k"]).head()
    return res.withColumn("best", (F.col("space") == top["space"]) & (F.col("k") == top["k"]))


@query("cluster_report")
def q_cluster_report(spark, sf_dir):
    """One row of the chosen solution (best k over the features): all facts, explained share,
    plain silhouette and negative share."""
    tr, te = wide(spark, sf_dir)
    df = tr.unionByName(te)
    prep = ML.sized(scaled(df)).persist()
    best = max(ML.sweep(prep, KS), key=lambda r: (r["silhouette"], -r["k"]))
    _, a, facts = ML.clustered(prep, best["k"])
    rows = a.select("id", cluster_name("prediction").alias("cluster"), ML.vector_to_array("features").alias("vec"))
    total = C.silhouette_summary(C.silhouette_rows(rows)).where("cluster IS NULL").head()
    one = C.sse(rows.withColumn("cluster", F.lit("all")), digits=None).head()["SSE"]
    prep.unpersist()
    row = (facts["k"], facts["W"], facts["SSE"], round(1 - facts["SSE"] / one, 4), facts["silhouette"], total["mean_silhouette"],
           total["negative_share"], facts["smallest"], facts["largest"], facts["purity"], facts["ari"])
    return spark.createDataFrame([row], "k int, W double, SSE double, explained_share double, silhouette_sq double, silhouette double, "
                                        "negative_share double, smallest long, largest long, purity double, ari double")


@query("kmeans_stability")
def q_kmeans_stability(spark, sf_dir):
    """2 init modes x 5 seeds at k = 3 with W, silhouette and ARI, each next to its range over all runs."""
    tr, te = wide(spark, sf_dir)
    df = tr.unionByName(te)
    prep = ML.sized(scaled(df)).persist()
    runs = [(init, seed) for init in ("k-means||", "random") for seed in (1, 7, 42, 2024, 31337)]
    rows = []
    for init, seed in runs:
        r = ML.clustered(prep, 3, init=init, seed=seed)[2]
        rows.append((init, seed, r["W"], r["silhouette"], r["ari"]))
    prep.unpersist()
    out = spark.createDataFrame(rows, "init string, seed int, W double, silhouette double, ari double")
    for c in ("W", "silhouette", "ari"):
        out = out.withColumn(f"range_{c}", S.spread(out, c).select("range").scalar())
    return out


@query("bisecting")
def q_bisecting(spark, sf_dir):
    """Bisecting k-means at k = 3 on scaled, uncentred features next to k-means: W, silhouette,
    purity, ARI with the class, sizes, and the agreement of both."""
    tr, te = wide(spark, sf_dir)
    df = tr.unionByName(te)
    prep = ML.sized(scaled(df, with_mean=False)).persist()
    bm, b = ML.bisecting(prep, 3)
    _, k, facts = ML.clustered(prep, 3)
    cells = [(r[0], r[1], r[2]) for r in b.groupBy("prediction", "label").count().collect()]
    sse = float(bm.summary.trainingCost)
    mine = {"W": round(2 * sse, 1), "silhouette": round(ML.silhouette_sq(b), 4), **ML.table_scores(cells)}
    j = b.select("id", F.col("prediction").alias("bis")).join(k.select("id", F.col("prediction").alias("km")), "id")
    both = ML.table_scores([(r[0], r[1], r[2]) for r in j.groupBy("bis", "km").count().collect()])["ari"]
    prep.unpersist()
    rows = [(name, r["W"], r["silhouette"], r["purity"], r["ari"], r["smallest"], r["largest"], both)
            for name, r in (("bisecting", mine), ("k-means", facts))]
    return spark.createDataFrame(rows, "method string, W double, silhouette double, purity double, ari double, smallest long, "
                                       "largest long, agreement double")


def knn_best(spark, sf_dir):
    """The best setting of all k-NN scenarios: largest F1, then smallest k, distance, kernel."""
    return knn_search(spark, sf_dir).orderBy(F.desc("f1"), "k", "distance", "kernel").head()


@query("compare_methods")
def q_compare_methods(spark, sf_dir):
    """The best tree, forest and k-NN that their searches found, by CV F1 on the same folds, with the test metrics beside it."""
    tr, te = wide(spark, sf_dir)
    vtr, vte = split(spark, sf_dir)
    k = knn_best(spark, sf_dir)
    found = {"knn": (k["f1"], f"k={k['k']}, distance={k['distance']:g}, kernel={k['kernel']}",
                     K.knn_predict(vtr, vte, k["k"], k["distance"], k["kernel"], levels=LEVELS).select(
                         F.col("qid").alias("id"), "label", "prediction",
                         *[F.coalesce(F.col("proba")[c], F.lit(0.0)).alias(f"p_{c}") for c in LEVELS]))}
    for name, make, (table, best) in (("tree", ML.tree, tree_search(spark, sf_dir)), ("forest", ML.forest, forest_search(spark, sf_dir))):
        top = table.where("best").head()
        found[name] = (top["f1"], top["params"], ML.predict(ML.fit(tr, FEATS, make(**best)), te))
    rows = []
    for name, (f1, chosen, p) in found.items():
        present = [c for c in LEVELS if f"p_{c}" in p.columns]
        p = materialise(p)
        o, m = M.overall(p, LEVELS).head(), M.macro(M.by_class(p, LEVELS, digits=None)).head()
        auc = M.multiclass_auc(p, "label", {c: f"p_{c}" for c in present}).head()["auc"]
        rows.append((name, chosen, float(f1), o["accuracy"], o["kappa"], m["macro_f1"], m["macro_balanced_accuracy"],
                     M.weighted_f1(p, LEVELS).head()[0], auc))
    table = spark.createDataFrame(rows, "method string, params string, cv_f1 double, accuracy double, kappa double, macro_f1 double, "
                                        "balanced_accuracy double, weighted_f1 double, auc double")
    return ML.compare_methods(table)


@query("merge_rankings")
def q_merge_rankings(spark, sf_dir):
    """Importances of tree, forest and k-NN (permutation) merged by feature."""
    tr, te = split(spark, sf_dir)
    w, _ = wide(spark, sf_dir)
    ti = ML.importance(spark, ML.fit(w, FEATS, ML.tree(**CHOSEN_TREE)), FEATS).select("feature", "importance")
    fi = ML.importance(spark, ML.fit(w, FEATS, ML.forest(**CHOSEN_FOREST)), FEATS).select("feature", "importance")
    ki = K.permutation_importance(tr, te, FEATS, K_BEST, P_BEST, reps=5, levels=LEVELS).select("feature", "importance_norm")
    return merge_rankings([(ti, "importance_tree"), (fi, "importance_forest"), (ki, "importance_knn")], "feature") \
        .orderBy(F.desc("importance_forest"), "feature")


_Z = 1.959963984540054


@query("accuracy_interval", "WITH " + KNN_CTE.strip() + f""",
a AS (SELECT AVG(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS acc, COUNT(*) AS n FROM res)
SELECT ROUND(acc, 4) AS accuracy,
       ROUND((acc + {_Z} * {_Z} / (2 * n) - {_Z} * sqrt(acc * (1 - acc) / n + {_Z} * {_Z} / (4 * n * n)))
             / (1 + {_Z} * {_Z} / n), 4) AS acc_lower,
       ROUND((acc + {_Z} * {_Z} / (2 * n) + {_Z} * sqrt(acc * (1 - acc) / n + {_Z} * {_Z} / (4 * n * n)))
             / (1 + {_Z} * {_Z} / n), 4) AS acc_upper,
       n FROM a""")
def q_accuracy_interval(spark, sf_dir):
    """M7: accuracy of the k-NN predictions with its Wilson 95 % interval."""
    r = knn_result(spark, sf_dir)
    a = r.agg(F.avg(F.when(F.col("label") == F.col("prediction"), 1.0).otherwise(0.0)).alias("acc"),
              F.count(F.lit(1)).alias("n"))
    lo, hi = M.accuracy_interval_cols(F.col("acc"), F.col("n"), _Z)
    return a.select(F.round("acc", 4).alias("accuracy"), F.round(lo, 4).alias("acc_lower"),
                    F.round(hi, 4).alias("acc_upper"), "n")


def _tail_sql(first: str, last: str, share: str) -> str:
    """Probability of ``first`` to ``last`` hits among n under a share."""
    return (f"list_sum(list_transform(range({first}, {last} + 1), lambda k: exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) "
            f"+ k * ln({share}) + (n - k) * ln(1 - {share}))))")


@query("accuracy_exact", "WITH RECURSIVE " + KNN_CTE.strip() + f""",
a AS (SELECT CAST(SUM(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS BIGINT) AS x, COUNT(*) AS n FROM res),
it AS (SELECT 0 AS i, x, n, CAST(0 AS DOUBLE) AS l1, CAST(1 AS DOUBLE) AS h1, CAST(0 AS DOUBLE) AS l2, CAST(1 AS DOUBLE) AS h2 FROM a
       UNION ALL
       SELECT i + 1, x, n, CASE WHEN t1 < 0.025 THEN m1 ELSE l1 END, CASE WHEN t1 < 0.025 THEN h1 ELSE m1 END,
              CASE WHEN t2 > 0.025 THEN m2 ELSE l2 END, CASE WHEN t2 > 0.025 THEN h2 ELSE m2 END
       FROM (SELECT *, {_tail_sql('x', 'n', 'm1')} AS t1, {_tail_sql('0', 'x', 'm2')} AS t2
             FROM (SELECT *, (l1 + h1) / 2 AS m1, (l2 + h2) / 2 AS m2 FROM it WHERE i < 52)))
SELECT ROUND(x / n, 4) AS accuracy, CASE WHEN x = 0 THEN 0 ELSE ROUND(l1, 4) END AS acc_lower,
       CASE WHEN x = n THEN 1 ELSE ROUND(h2, 4) END AS acc_upper, n FROM it WHERE i = 52""")
def q_accuracy_exact(spark, sf_dir):
    """M7: accuracy of the k-NN predictions with its exact binomial 95 % interval."""
    a = knn_result(spark, sf_dir).agg(F.sum(F.when(F.col("label") == F.col("prediction"), 1).otherwise(0)).alias("x"), F.count("*").alias("n"))
    lo, hi = M.binomial_interval_cols(F.col("x"), F.col("n"))
    return a.select(F.round(F.col("x") / F.col("n"), 4).alias("accuracy"), F.round(lo, 4).alias("acc_lower"), F.round(hi, 4).alias("acc_upper"), "n")
