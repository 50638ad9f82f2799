"""Operator 9: language of a text by averaged hashed subword embeddings.

Subwords are the runs of 1 to 4 bytes inside a lower-cased word with its
borders, hashed to ``BUCKETS`` embeddings; a text is the mean of its subwords'
embeddings, a linear softmax tells the language. Embeddings and softmax are
trained together by stochastic gradient descent in numpy. As everything up to
the softmax is linear, the fitted model is folded to one row of language
scores for each bucket, and a whole text is scored by one sum.

The share of the best language is calibrated on held-back sample rows by a
temperature; ``accepted`` tells whether it reaches the rejection threshold,
set there so that accepted rows of the sample err at most ``ERROR`` of the time.

Bound of the fit: at most ``SAMPLE`` rows of each language, the first by a
hash of the id; at most ``LANGUAGES`` languages, the most frequent.

Defined results: a null text and one without a letter are ``und`` with score 0
and not accepted. Without a language to learn every row is ``und``. Rows with
null or empty language are not learnt from. Rows are predicted alone, so
repeated rows get equal results. Columns that the input has under the names of
the result's columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldstat.llm import textkit as tk

BITS = 15
BUCKETS = 1 << BITS
GRAMS = (1, 2, 3, 4)
WIDTH = 16
SAMPLE = 800             # rows of each language
LANGUAGES = 200
EPOCHS = 12
ERROR = 0.01
HASHES = 1 << 40
UNKNOWN = "und"
LETTER = "\\p{L}"


def subwords(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of all subwords of a chunk. Digits, signs and spaces end a word and are not looked at."""
    low = tk.LETTERS[raw].astype(np.int64)
    low[(low >= 0x30) & (low <= 0x39)] = 0
    n = len(low)
    size = np.diff(off)
    # One border byte before every text, so that no subword reaches over two texts.
    place = np.arange(n) + np.repeat(np.arange(1, len(size) + 1), size)
    s = np.zeros(n + len(size) + 1, np.int64)
    s[place] = low
    owner = np.repeat(np.arange(len(size)), size + 1)
    owner = np.append(owner, len(size) - 1 if len(size) else 0)
    letter = s > 0
    doc, bucket = [], []
    code = np.zeros(len(s), np.int64)
    for g in range(1, max(GRAMS) + 1):
        m = len(s) - g + 1
        if m <= 0:
            break
        code = code[:m] * 257 + s[g - 1:g - 1 + m]
        # Borders may be the first or the last byte only, and not alone.
        fit = letter[:m].copy() if g == 1 else np.ones(m, bool)
        for j in range(1, g - 1):
            fit &= letter[j:j + m]
        if g == 2:
            fit = letter[:m] | letter[1:1 + m]
        at = np.flatnonzero(fit)
        if g not in GRAMS:
            continue
        x = code[at].astype(tk.U64) * tk.U64(0x9E3779B97F4A7C15) + tk.ODD[40 + g]
        x ^= x >> tk.U64(32)
        x *= tk.U64(0xD6E8FEB86659FD93)
        bucket.append((x >> tk.U64(64 - BITS)).astype(np.int32))
        doc.append(owner[at])
    return np.concatenate(doc), np.concatenate(bucket)


@dataclass
class Model:
    """Languages, folded scores of each bucket, bias, temperature and rejection threshold."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def shares(self, doc: np.ndarray, bucket: np.ndarray, n_docs: int) -> np.ndarray:
        """Calibrated probability of each language for each text."""
        count = np.maximum(np.bincount(doc, minlength=n_docs), 1)
        z = np.stack([np.bincount(doc, self.table[bucket, j], n_docs) for j in range(len(self.languages))], 1)
        z = (z / count[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def fit(texts: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, languages: list[str], seed: int = 11) -> Model:
    """Train on (buckets, counts) of each text; every fifth text is held back for calibration."""
    rng = np.random.default_rng(seed)
    k = len(languages)
    emb = rng.normal(0, 0.1, (BUCKETS, WIDTH))
    soft = np.zeros((WIDTH, k))
    bias = np.zeros(k)
    held = np.arange(len(texts)) % 5 == 4
    train = np.flatnonzero(~held) if len(texts) >= 10 else np.arange(len(texts))
    steps = EPOCHS * max(1, len(train))
    done = 0
    for _ in range(EPOCHS):
        for i in rng.permutation(train):
            b, c = texts[i]
            if not len(b):
                continue
            # Half of the steps see a few subwords only, as short texts have them.
            if rng.random() < 0.5 and len(b) > 40:
                pick = rng.integers(0, len(b), 40)
                b, c = b[pick], np.ones(40)
            share = c / c.sum()
            x = share @ emb[b]
            p = _softmax((x @ soft + bias)[None])[0]
            p[label[i]] -= 1.0
            rate = 0.5 * (1 - done / steps) + 0.01
            done += 1
            back = soft @ p
            soft -= rate * np.outer(x, p)
            bias -= 0.1 * rate * p
            np.add.at(emb, b, -rate * 20 * share[:, None] * back)
    table = emb @ soft
    model = Model(languages, table.astype(np.float32), bias, 1.0, 0.0)
    test = np.flatnonzero(held) if held.any() and len(texts) >= 10 else train
    doc = np.repeat(np.arange(len(test)), [len(texts[i][0]) for i in test])
    col = np.concatenate([texts[i][0] for i in test]) if len(test) else np.zeros(0, np.int32)
    times = np.concatenate([texts[i][1] for i in test]) if len(test) else np.zeros(0)
    total = np.maximum(np.bincount(doc, times, len(test)), 1)
    z = np.stack([np.bincount(doc, table[col, j] * times, len(test)) for j in range(k)], 1) / total[:, None] + bias
    y = label[test]
    heat = np.exp(np.linspace(-2, 3, 41))
    loss = [-np.log(_softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in heat]
    model.temperature = float(heat[int(np.argmin(loss))])
    p = _softmax(z / model.temperature)
    best, right = p.max(1), p.argmax(1) == y
    order = np.argsort(-best, kind="stable")
    wrong = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
    fine = np.flatnonzero(wrong <= ERROR)
    model.threshold = float(min(best[order][fine[-1]], 0.5)) if len(fine) else 1.0
    return model


def _sample_subwords(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to, raw, off in tk.chunks(batch.column("text")):
            doc, bucket = subwords(raw, off)
            d, b, n = tk.counted(doc, bucket)
            cut = np.searchsorted(d, np.arange(to - at + 1))
            buckets = [b[x:y].astype(np.uint16).tobytes() for x, y in zip(cut[:-1], cut[1:])]
            counts = [n[x:y].astype(np.uint32).tobytes() for x, y in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(at, to - at) for c in ("lang", "h")] + [pa.array(buckets, pa.binary()), pa.array(counts, pa.binary())],
                ["lang", "h", "buckets", "counts"])


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = SAMPLE) -> Model | None:
    """Fit on a bounded sample of ``rows``; None if there is nothing to learn."""
    named = rows.where(F.col(lang_col).isNotNull() & (F.col(lang_col) != "") & F.col(id_col).isNotNull())
    frequent = named.groupBy(F.col(lang_col).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    counts = {r[0]: r[1] for r in frequent.collect()}
    languages = sorted(counts)
    if not languages:
        return None
    # Only hashes low enough to be among the first of their language are ranked, so a
    # frequent language brings its ranking no more rows than a rare one.
    low = F.create_map(*[F.lit(x) for k in languages for x in (k, int(HASHES * min(1.0, 2.0 * per_language / counts[k])))])
    first = Window.partitionBy("lang").orderBy("h", "_id")
    chosen = (named.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("lang"),
                           F.pmod(F.xxhash64(id_col), F.lit(HASHES)).alias("h"))
              .where(F.col("h") < F.element_at(low, F.col("lang"))).withColumn("nth", F.row_number().over(first))
              .where(F.col("nth") <= per_language).select("_id", "lang").distinct())
    # A row is learnt under its own language only; of an id that repeats, no more rows than the bound.
    texts = (named.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
             .join(F.broadcast(chosen), ["_id", "lang"]).select("lang", F.xxhash64("_id").alias("h"), "text"))
    found = texts.mapInArrow(_sample_subwords, "lang string, h long, buckets binary, counts binary")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "buckets", "counts"))
    got = found.withColumn("nth", nth).where(F.col("nth") <= per_language).select("lang", "buckets", "counts").toArrow()
    packed = sorted(zip(*[got.column(c).to_pylist() for c in ("buckets", "counts", "lang")]))
    code = {x: i for i, x in enumerate(languages)}
    return fit([(np.frombuffer(b, np.uint16).astype(np.int32), np.frombuffer(c, np.uint32).astype(float))
                for b, c, _ in packed], np.array([code[x] for *_, x in packed], np.int64), languages)


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (calibrated share of the prediction) and accepted."""
    added = ("lang_pred", "score", "accepted")
    keep = docs.select(*[c for c in docs.columns if c not in added])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    lettered = keep.withColumn("_letters", F.coalesce(F.col(text_col).rlike(LETTER), F.lit(False)))
    schema = keep.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("accepted")).schema

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at, to, raw, off in tk.chunks(batch.column(text_col), tk.CHUNK // 2):
                part = batch.slice(at, to - at)
                able = part.column("_letters").to_numpy(zero_copy_only=False).astype(bool)
                if m is None:
                    able[:] = False
                    best, top = np.zeros(to - at), np.zeros(to - at, int)
                else:
                    p = m.shares(*subwords(raw, off), to - at)
                    best, top = p.max(1), p.argmax(1)
                names = [m.languages[j] if ok else UNKNOWN for j, ok in zip(top, able)]
                best = np.where(able, best, 0.0)
                names_in = [c for c in part.schema.names if c != "_letters"]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in names_in]
                    + [pa.array(names, pa.string()), pa.array(best), pa.array(able & (best >= (m.threshold if m else 2)))],
                    [*names_in, *added])

    return lettered.mapInArrow(predicted, schema)
