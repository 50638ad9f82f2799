"""Cross-validated model search that fits nested models once.

A greedy tree that looks at every feature of a node is nested in its depth and in
its least gain: the shallower tree is the deeper one cut off at a level, and a
tree with a larger ``minInfoGain`` is the one with a smaller bound whose nodes of less
gain are leaves, from the top down, since a node's best split does not depend on
either bound. So one fit with the largest depth and the smallest gain answers
all of them: the held-out rows walk its node table once, and every bound takes
the prediction of the node where it stops them. ``minInstancesPerNode`` and the impurity
change the splits themselves and need fits of their own. Forests draw features for
each node and are not nested; their settings are fitted one by one.

The fits of all folds come from one pool, the long ones of a fold first. A fold's
prepared rows are kept from its first fit to its last, so only a few folds are kept
at a time. Every running fit keeps the rows in a form of its own, so fewer fits run at once over
many rows, where one of them fills the tasks. Only a count for each (setting, class, predicted class) reaches the driver.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstat.session import shared_dir

DEPTH, GAIN = "maxDepth", "minInfoGain"
NESTED = (DEPTH, GAIN)
ROWS = 4096              # held-out rows that walk a tree at once
KEPT = 100_000           # rows a core that all running fits keep, about


@dataclass
class Nodes:
    """A fitted tree: for each node its feature (-1: a leaf), threshold, children, gain and prediction."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    gain: np.ndarray
    prediction: np.ndarray


@dataclass
class Fit:
    """One model to fit: its parameters, and which settings (number, depth, least gain) it answers."""

    params: dict
    answers: list[tuple[int, int, float]]
    cost: float


def node_table(model) -> Nodes:
    """The nodes of a fitted tree over numeric features, root first, as its saved form has them.

    A fitted tree is on the driver in any case; this is the same table as arrays."""
    from pyspark.sql import SparkSession
    spark = SparkSession.active()
    path = shared_dir(spark, "tree")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select(
        "id", "split.featureIndex", F.get("split.leftCategoriesOrThreshold", 0), "split.numCategories", "leftChild", "rightChild",
        "gain", "prediction").orderBy("id").collect()
    if any(r[3] >= 0 for r in rows):
        raise ValueError("a tree that splits by categories has no numeric thresholds")
    cols = [np.array(c) for c in zip(*rows)]
    leaf = cols[4] < 0
    return Nodes(np.where(leaf, -1, cols[1]).astype(np.int64), np.where(leaf, np.nan, [x if x is not None else np.nan for x in cols[2]]),
                 cols[4].astype(np.int64), cols[5].astype(np.int64), cols[6].astype(float), cols[7].astype(np.int64))


def walk(nodes: Nodes, x: np.ndarray, bounds: Sequence[tuple[int, float]]) -> np.ndarray:
    """Predictions (bounds, rows) of the rows ``x`` by the trees of the given depths and least gains."""
    at = np.zeros(len(x), np.int64)
    out = np.full((len(bounds), len(x)), -1, np.int64)
    rows, level = np.arange(len(x)), 0
    while True:
        leaf = nodes.feature[at] < 0
        for found, (depth, gain) in zip(out, bounds):
            stop = (found < 0) & (leaf | (level >= depth) | (nodes.gain[at] < gain))
            found[stop] = nodes.prediction[at[stop]]
        if (out >= 0).all():
            return out
        with np.errstate(invalid="ignore"):
            left = x[rows, np.maximum(nodes.feature[at], 0)] <= nodes.threshold[at]
        at = np.where(leaf, at, np.where(left, nodes.left[at], nodes.right[at]))
        level += 1


def _counted(nodes: Nodes, answers: Sequence[tuple[int, int, float]]):
    """Counts of each (setting, class, predicted class) of a batch."""
    bounds = [(depth, gain) for _, depth, gain in answers]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                y = part.column("label_idx").to_numpy(zero_copy_only=False).astype(np.int64)
                x = np.stack(part.column("x").to_numpy(zero_copy_only=False))
                p = walk(nodes, x, bounds)
                some = np.repeat([a[0] for a in answers], len(y))
                cells, n = np.unique(np.stack([some, np.tile(y, len(answers)), p.ravel()]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*cells, n)], ["setting", "label", "prediction", "n"])

    return found


def weighted_f1(cells: Sequence[tuple[int, int, int]]) -> float:
    """Weighted F1 from (class, predicted class, rows); an undefined F1 counts 0."""
    true: dict[int, int] = {}
    said: dict[int, int] = {}
    hit: dict[int, int] = {}
    for label, prediction, n in cells:
        true[label] = true.get(label, 0) + n
        said[prediction] = said.get(prediction, 0) + n
        if label == prediction:
            hit[label] = hit.get(label, 0) + n
    return sum(n * 2 * hit.get(c, 0) / (n + said.get(c, 0)) for c, n in true.items()) / sum(true.values())


def nested_scores(model, held: DataFrame, answers: Sequence[tuple[int, int, float]]) -> dict[int, float]:
    """Weighted F1 of every setting that a fitted tree answers, from one pass over the held-out rows."""
    rows = held.select("label_idx", vector_to_array("features").alias("x"))
    cells = (rows.mapInArrow(_counted(node_table(model), answers), "setting long, label long, prediction long, n long")
             .groupBy("setting", "label", "prediction").agg(F.sum("n").alias("n")).collect())
    return {i: weighted_f1([(r.label, r.prediction, r.n) for r in cells if r.setting == i]) for i, *_ in answers}


def fits(make: Callable[..., object], sets: Sequence[Mapping], nested: Sequence[str] = ()) -> list[Fit]:
    """The models to fit for ``sets``: equal ones once, and one for all settings that differ in ``nested`` bounds only."""
    found: dict[tuple, Fit] = {}
    for i, s in enumerate(sets):
        est = make(**s)
        values = {p.name: v for p, v in est.extractParamMap().items()}
        key = tuple(sorted((k, str(v)) for k, v in values.items() if k not in nested))
        depth, gain = values[DEPTH], float(values.get(GAIN, 0.0))
        f = found.setdefault(key, Fit(dict(s), [], 0.0))
        f.answers.append((i, depth, gain))
        if nested:
            f.params |= {DEPTH: max(d for _, d, _ in f.answers), GAIN: min(g for *_, g in f.answers)}
        f.cost = max(f.cost, float(values.get("numTrees", 1)) * depth)
    return sorted(found.values(), key=lambda f: -f.cost)


class _Fold:
    """A fold's prepared rows, made for its first fit and let go after its last."""

    def __init__(self, prepare: Callable[[], tuple[DataFrame, DataFrame]], uses: int) -> None:
        self._prepare, self._left, self._lock, self._rows = prepare, uses, threading.Lock(), None

    def rows(self) -> tuple[DataFrame, DataFrame]:
        with self._lock:
            if self._rows is None:
                self._rows = tuple(d.persist() for d in self._prepare())
            return self._rows

    def done(self) -> None:
        with self._lock:
            self._left -= 1
            if not self._left and self._rows:
                for d in self._rows:
                    d.unpersist()
                self._rows = None


def fits_at_once(rows: int, cores: int) -> int:
    """How many fits run at once over so many rows: at least one, whose rows Spark spills if need be."""
    return max(1, min(16, max(4, cores), KEPT * cores // max(1, rows)))


def cross_validate(train: DataFrame, stages: Callable[[], list], make: Callable[..., object], sets: Sequence[Mapping], *,
                   fold_col: str = "fold", nested: Sequence[str] = (), parallelism: int | None = None,
                   sized: Callable[[DataFrame], DataFrame] = lambda d: d) -> list[list[float]]:
    """L3: weighted F1 of every setting on every fold. ``stages`` makes the preparation that is fitted on a fold's other rows."""
    names = sorted(r[0] for r in train.select(fold_col).distinct().collect())
    models = fits(make, sets, nested)
    if parallelism is None:
        parallelism = fits_at_once(train.count(), train.sparkSession.sparkContext.defaultParallelism)
    score = MulticlassClassificationEvaluator(labelCol="label_idx", predictionCol="prediction", metricName="f1")

    def prepare(name) -> tuple[DataFrame, DataFrame]:
        rest, held = train.where(F.col(fold_col) != name), train.where(F.col(fold_col) == name)
        prep = Pipeline(stages=stages()).fit(rest)
        return tuple(sized(prep.transform(d).select("label_idx", "features")) for d in (rest, held))

    folds = {name: _Fold(lambda name=name: prepare(name), len(models)) for name in names}

    def run(job: tuple[object, Fit]) -> list[tuple[int, object, float]]:
        name, f = job
        try:
            rest, held = folds[name].rows()
            model = make(**f.params).fit(rest)
            if nested:
                return [(i, name, v) for i, v in nested_scores(model, held, f.answers).items()]
            f1 = score.evaluate(model.transform(held))
            return [(i, name, f1) for i, *_ in f.answers]
        finally:
            folds[name].done()

    with ThreadPool(parallelism) as pool:
        done = {(i, name): f1 for part in pool.imap_unordered(run, [(n, f) for n in names for f in models]) for i, name, f1 in part}
    return [[done[i, name] for name in names] for i in range(len(sets))]
