"""Spark ML pipelines: scaling, PCA, trees, forests, cross-validation, k-means (K1-K6,
L1-L10, L16-L17, N1-N3, N13, N14). Model fitting is Spark ML's; this module wires
pipelines and turns fitted-model facts into DataFrames."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstat.operators import comoments, tree_search
from fieldstat.session import shared_dir


def prepare_stages(cols: Sequence[str], label: str | None = "label", with_mean: bool = True):
    """K1/K2/H5: label indexer (by frequency), assembler, standard scaler. Refitted per
    fold when used inside a CrossValidator, so scaling never sees the held-out fold."""
    stages = []
    if label:
        stages.append(StringIndexer(inputCol=label, outputCol="label_idx", stringOrderType="frequencyDesc"))
    stages += [VectorAssembler(inputCols=list(cols), outputCol="features_raw"),
               StandardScaler(inputCol="features_raw", outputCol="features", withMean=with_mean, withStd=True)]
    return stages


def tree(**params) -> DecisionTreeClassifier:
    """L1: decision tree (depth, min instances, min gain, impurity)."""
    return DecisionTreeClassifier(featuresCol="features", labelCol="label_idx", seed=42, **params)


def forest(**params) -> RandomForestClassifier:
    """L2: random forest, seed 42."""
    params.setdefault("seed", 42)
    return RandomForestClassifier(featuresCol="features", labelCol="label_idx", **params)


# FIXED VALUES: the parameter grids of the searched scenarios.
TREE_SCENARIOS = {
    "S1": {"maxDepth": [2, 3, 5, 8, 12, 20]},
    "S2": {"minInstancesPerNode": [1, 5, 10, 20, 50], "minInfoGain": [0.0, 0.001, 0.01]},
    "S3": {"impurity": ["gini", "entropy"], "maxDepth": [5, 10, 15]},
}
FOREST_SCENARIOS = {
    "S1": {"numTrees": [20, 50, 100, 250, 500]},
    "S2": {"maxDepth": [3, 5, 10, 15], "featureSubsetStrategy": ["sqrt", "log2", "onethird"]},
    "S3": {"subsamplingRate": [0.6, 0.8, 1.0], "minInstancesPerNode": [1, 5, 20]},
}


def parameter_sets(grid: Mapping[str, Sequence]) -> list[dict]:
    """L4: every combination of the named parameter values."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


_SCORES: dict[str, str] = {}


def cross_validate(train: DataFrame, cols: Sequence[str], make: Callable[..., object], sets: Sequence[dict], *,
                   label: str = "label", fold_col: str = "fold", parallelism: int | None = None, nested: Sequence[str] = (),
                   memo: str | None = None) -> list[list[float]]:
    """L3: weighted F1 of every parameter set on every fold (stratified folds, E9, shared by all methods).

    Indexer and scaler are fitted once per fold, on the other folds. Sets that differ in ``nested``
    bounds only share a fit (see ``tree_search``). Under a name ``memo`` for the state of the rows, the
    scores are written once in a session and read again by whoever searches the same."""
    spark = train.sparkSession
    key = f"{spark.sparkContext.applicationId}:{memo}:{sets}"
    if memo is None or key not in _SCORES:
        found = tree_search.cross_validate(train, lambda: prepare_stages(cols, label), make, sets, fold_col=fold_col,
                                           nested=nested, parallelism=parallelism, sized=sized)
        if memo is None:
            return found
        path = shared_dir(spark, "search")
        rows = [(i, j, f1) for i, scores in enumerate(found) for j, f1 in enumerate(scores)]
        spark.createDataFrame(rows, "setting int, fold int, f1 double").coalesce(1).write.parquet(path)
        _SCORES[key] = path
    rows = spark.read.parquet(_SCORES[key]).orderBy("setting", "fold").collect()
    return [[r.f1 for r in rows if r.setting == i] for i in range(len(sets))]


def search(train: DataFrame, cols: Sequence[str], make: Callable[..., object], scenarios: Mapping[str, Mapping[str, Sequence]],
           digits: int = 4, **kw) -> tuple[DataFrame, dict]:
    """All scenarios on the same folds. Returns the table (scenario, params, f1, f1_sd, best),
    best first, and the parameters of the best set, for a refit. ``kw`` as for ``cross_validate``."""
    sets = [(name, s) for name, grid in scenarios.items() for s in parameter_sets(grid)]
    scores = cross_validate(train, cols, make, [s for _, s in sets], **kw)
    rows = [(name, str(sorted(s.items())), float(np.mean(f)), float(np.std(f, ddof=1))) for (name, s), f in zip(sets, scores)]
    top = max(range(len(rows)), key=lambda i: rows[i][2])
    df = train.sparkSession.createDataFrame([(*r, i == top) for i, r in enumerate(rows)],
                                            "scenario string, params string, f1 double, f1_sd double, best boolean")
    table = df.select("scenario", "params", F.round("f1", digits).alias("f1"), F.round("f1_sd", digits).alias("f1_sd"), "best")
    return table.orderBy(F.desc("best"), F.desc("f1"), "scenario", "params"), sets[top][1]


def fit(train: DataFrame, cols: Sequence[str], est, label: str = "label") -> PipelineModel:
    """Refit on the whole training set."""
    return Pipeline(stages=prepare_stages(cols, label) + [est]).fit(train)


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("id", "label")) -> DataFrame:
    """Predictions decoded to labels, with one probability column per class
    (in the indexer's label order)."""
    labels = model.stages[0].labels
    out = model.transform(df)
    arr = F.array(*[F.lit(x) for x in labels])
    probs = vector_to_array("probability")
    return out.select(*keep, F.get(arr, F.col("prediction").cast("int")).alias("prediction"),
                      *[F.get(probs, i).alias(f"p_{lab}") for i, lab in enumerate(labels)])


def importance(spark: SparkSession, model: PipelineModel, names: Sequence[str], digits: int = 4) -> DataFrame:
    """Impurity importance per feature (sums to 1), ranked, with the feature index."""
    imp = model.stages[-1].featureImportances.toArray()
    rows = [(i, n, float(v)) for i, (n, v) in enumerate(zip(names, imp))]
    df = spark.createDataFrame(rows, "index int, feature string, importance double")
    return df.select("index", "feature", F.round("importance", digits).alias("importance")) \
             .orderBy(F.desc("importance"), "index")


def model_summary(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Depth, node counts and the rule text of a tree / forest."""
    m = model.stages[-1]
    if hasattr(m, "trees"):
        row = (max(t.depth for t in m.trees), int(sum(t.numNodes for t in m.trees)),
               int(m.totalNumNodes), len(m.trees), m.toDebugString)
    else:
        row = (int(m.depth), int(m.numNodes), int(m.numNodes), 1, m.toDebugString)
    return spark.createDataFrame([row], "depth int, nodes int, total_nodes int, trees int, rules string")


def pca(df: DataFrame, cols: Sequence[str], k: int, digits: int = 4):
    """K4/K5/K6: standardise (mean and sd), PCA(k); returns (scores, explained) where
    explained has the cumulative share per component."""
    spark = df.sparkSession
    pipe = Pipeline(stages=prepare_stages(cols, None) + [PCA(k=k, inputCol="features", outputCol="pcs")])
    m = pipe.fit(df)
    ev = [float(x) for x in m.stages[-1].explainedVariance.toArray()]
    cum, rows = 0.0, []
    for i, v in enumerate(ev):
        cum += v
        rows.append((i + 1, round(v, digits), round(cum, digits)))
    explained = spark.createDataFrame(rows, "component int, explained double, cumulative double")
    scores = m.transform(df)
    return scores, explained


def explained(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """K4/K6 without scores: the share of every principal component of the standardised columns and the
    cumulative share, from the correlations of one co-moment scan."""
    shares = comoments.explained_shares(comoments.co_moments(df, cols))
    rows = [(i + 1, round(float(v), digits), round(float(c), digits)) for i, (v, c) in enumerate(zip(shares, np.cumsum(shares)))]
    return df.sparkSession.createDataFrame(rows, "component int, explained double, cumulative double")


def n_components(explained: DataFrame, bound: float = 0.9) -> DataFrame:
    """K6: the first component count whose cumulative share reaches the bound."""
    return explained.where(F.col("cumulative") >= bound).agg(F.min("component").alias("n_components"))


def sized(df: DataFrame, rows_per_partition: int = 12_500) -> DataFrame:
    """Repartition an iterative algorithm's input by row count (about 6 MB of 64-dim
    doubles per partition): every iteration is a job, so tiny partitions only add task
    overhead, while large inputs get a task, and so a core, per 12,500 rows."""
    n = df.count()
    return df.repartition(max(1, math.ceil(n / rows_per_partition)))


def kmeans(df: DataFrame, k: int, init: str = "k-means||", seed: int = 42, max_iter: int = 50,
           features: str = "features"):
    """K-means; returns (model, assignments with ``prediction``)."""
    m = KMeans(k=k, initMode=init, seed=seed, maxIter=max_iter, featuresCol=features).fit(df)
    return m, m.transform(df)


def table_scores(cells: Sequence[tuple[object, object, int]]) -> dict:
    """N8-N10 from one cluster x class count (clusters x classes cells): purity, ARI, sizes."""
    pairs = lambda xs: sum(x * (x - 1) / 2 for x in xs)
    rows: dict = {}
    cols: dict = {}
    for a, b, n in cells:
        rows.setdefault(a, []).append(n)
        cols.setdefault(b, []).append(n)
    sizes = [sum(v) for v in rows.values()]
    total = sum(sizes)
    si, sj, sij = pairs(sizes), pairs([sum(v) for v in cols.values()]), pairs([n for *_, n in cells])
    expected = si * sj / max(pairs([total]), 1.0)
    top = 0.5 * (si + sj) - expected
    return {"purity": round(sum(max(v) for v in rows.values()) / total, 4), "ari": round((sij - expected) / top, 4) if top else 1.0,
            "smallest": min(sizes), "largest": max(sizes)}


def clustered(df: DataFrame, k: int, label: str = "label", features: str = "features", **kw) -> tuple[object, DataFrame, dict]:
    """One k-means solution with N4, N6 and N8-N10: SSE from the fit's summary, the silhouette, and
    one cluster x class count for the rest."""
    model, assigned = kmeans(df, k, features=features, **kw)
    sse = float(model.summary.trainingCost)
    cells = [(r[0], r[1], r[2]) for r in assigned.groupBy("prediction", label).count().collect()]
    return model, assigned, {"k": k, "W": round(2 * sse, 1), "SSE": round(sse, 1), "silhouette": round(silhouette_sq(assigned, features), 4),
                             **table_scores(cells)}


def sweep(df: DataFrame, ks: Sequence[int], parallelism: int = 4, **kw) -> list[dict]:
    """The facts of one solution for each k, fitted from a small pool."""
    with ThreadPool(parallelism) as pool:
        return pool.map(lambda k: clustered(df, k, **kw)[2], ks)


def silhouette_sq(assigned: DataFrame, features: str = "features") -> float:
    """Mean squared-Euclidean silhouette (Spark's evaluator)."""
    return ClusteringEvaluator(featuresCol=features, predictionCol="prediction").evaluate(assigned)


def bisecting(df: DataFrame, k: int, seed: int = 42, max_iter: int = 50, features: str = "features"):
    """Bisecting k-means. Fit on scaled but uncentred features: after centring the
    first split starts from a zero centre and may not divide the data."""
    m = BisectingKMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=features,
                        minDivisibleClusterSize=1.0).fit(df)
    return m, m.transform(df)


def compare_methods(rows: DataFrame, by: str = "cv_f1") -> DataFrame:
    """Methods sorted by CV score with the winner flagged."""
    top = rows.select(F.max(by)).scalar()
    return rows.withColumn("winner", F.col(by) == top).orderBy(F.desc(by))
