"""Operator 7: toxicity by a factorization machine over hashed terms.

Terms of a text are its words and the first 4 to 6 bytes of its words, hashed
to ``2^BITS`` numbers; a term is present or absent. Score = sigmoid of
w0 + sum w_i + sum over pairs <v_i, v_j>: the pairs learn what single weights
miss. The model is fitted with numpy (Adam) on a bounded sample of labelled
rows, over the at most ``TERMS`` terms whose presence differs most surely between
the classes; the fitted model (under 2 MB) goes to the tasks, and scoring is
one pass over whole texts without a shuffle.

Bound of the fit: at most ``SAMPLE`` rows of each label, the first by a hash
of the id.

Defined results: null and empty texts have no terms and score the bias. Labels
that are null or not 0 or 1 are not learnt from; an id that is labelled twice
counts twice. Without both labels in the sample every score is the share of 1
(0 without any). Rows are scored alone, so repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstat.llm import textkit as tk
from fieldstat.llm.tables import stored

BITS = 26
PREFIXES = (4, 5, 6)
SAMPLE = 2_500           # rows of each label
TERMS = 4_096
RANK = 8
THRESHOLD = 0.7
STEPS = 400
LEAST_TEXTS = 4          # a term of fewer texts in the sample is not learnt


def sieve(known: np.ndarray) -> np.ndarray:
    """Which 16-bit endings the known terms have: most other terms fall through."""
    ends = np.zeros(1 << 16, bool)
    ends[known & 0xFFFF] = True
    return ends


def terms(raw: np.ndarray, off: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, term number) of a chunk, sorted by text; of terms with other endings none."""
    w = tk.words(raw, off)
    doc, h = [w.doc], [w.hash]
    for i, size in enumerate(PREFIXES):
        long = np.flatnonzero(w.end - w.start > size)
        doc.append(w.doc[long])
        h.append(w.part_hash(w.start[long], w.start[long] + size, 30 + i))
    term = np.concatenate(h) >> tk.U64(64 - BITS)
    where = np.concatenate(doc).astype(tk.U64)
    if ends is not None:
        kept = ends[(term & tk.U64(0xFFFF)).astype(np.int64)]
        where, term = where[kept], term[kept]
    key = np.unique((where << tk.U64(BITS)) | term)
    return (key >> tk.U64(BITS)).astype(np.int64), (key & tk.U64((1 << BITS) - 1)).astype(np.int64)


@dataclass
class Machine:
    """A fitted factorization machine over the sorted term numbers ``term``."""

    term: np.ndarray
    bias: float
    w: np.ndarray
    v: np.ndarray

    def raw(self, doc: np.ndarray, col: np.ndarray, n_docs: int) -> np.ndarray:
        """Scores before the sigmoid; ``col`` are places in ``term``."""
        s = np.zeros((n_docs, self.v.shape[1]))
        np.add.at(s, doc, self.v[col])
        single = np.bincount(doc, self.w[col] - 0.5 * (self.v[col] ** 2).sum(1), n_docs)
        return self.bias + single + 0.5 * (s ** 2).sum(1)

    def score(self, doc: np.ndarray, term: np.ndarray, n_docs: int) -> np.ndarray:
        """Probability of label 1."""
        if len(self.term):
            at = np.minimum(np.searchsorted(self.term, term), len(self.term) - 1)
            known = self.term[at] == term
            x = self.raw(doc[known], at[known], n_docs)
        else:
            x = np.full(n_docs, self.bias)
        return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def select_terms(doc: np.ndarray, term: np.ndarray, label: np.ndarray, most: int = TERMS) -> np.ndarray:
    """The terms whose presence differs most surely between the labels (likelihood ratio), sorted."""
    known, at = np.unique(term, return_inverse=True)
    n1, n0 = label.sum(), (1 - label).sum()
    a = np.bincount(at, label[doc], len(known))
    b = np.bincount(at, 1.0 - label[doc], len(known))
    share = (a + b) / (n1 + n0)

    def part(x: np.ndarray, e: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-12) / np.maximum(e, 1e-12)), 0.0)

    g = 2 * (part(a, n1 * share) + part(b, n0 * share) + part(n1 - a, n1 * (1 - share)) + part(n0 - b, n0 * (1 - share)))
    # Beyond chance at one in ten after a correction for the number of terms tried.
    tried = a + b >= LEAST_TEXTS
    sure = (g > 2 * np.log(max(int(tried.sum()), 1) * 10.0)) & tried
    best = np.argsort(-g, kind="stable")[:most]
    return np.sort(known[best[sure[best]]])


def fit(doc: np.ndarray, term: np.ndarray, label: np.ndarray, rank: int = RANK, steps: int = STEPS,
        seed: int = 7) -> Machine:
    """Fit by full-batch Adam on the log loss with L2; deterministic."""
    n = len(label)
    if n == 0 or label.min() == label.max():
        share = float(label.mean()) if n else 0.0
        return Machine(np.zeros(0, np.int64), float(np.log((share + 1e-9) / (1 - share + 1e-9))), np.zeros(0), np.zeros((0, rank)))
    chosen = select_terms(doc, term, label)
    at = np.minimum(np.searchsorted(chosen, term), max(len(chosen) - 1, 0))
    known = chosen[at] == term if len(chosen) else np.zeros(len(term), bool)
    doc, col = doc[known], at[known]
    rng = np.random.default_rng(seed)
    m = Machine(chosen, 0.0, np.zeros(len(chosen)), rng.normal(0, 0.02, (len(chosen), rank)))
    cell = np.array([0.0])
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (cell, m.w, m.v)]
    weight = np.where(label > 0, 0.5 / label.mean(), 0.5 / (1 - label.mean())) / n
    for t in range(1, steps + 1):
        m.bias = float(cell[0])
        s = np.zeros((n, rank))
        np.add.at(s, doc, m.v[col])
        x = m.bias + np.bincount(doc, m.w[col] - 0.5 * (m.v[col] ** 2).sum(1), n) + 0.5 * (s ** 2).sum(1)
        g = (1 / (1 + np.exp(-np.clip(x, -40, 40))) - label) * weight
        gv = np.zeros_like(m.v)
        np.add.at(gv, col, g[doc, None] * (s[doc] - m.v[col]))
        grads = (np.array([g.sum()]), np.bincount(col, g[doc], len(chosen)) + 1e-5 * m.w, gv + 1e-4 * m.v)
        for p, gr, (one, two) in zip((cell, m.w, m.v), grads, state):
            one += 0.1 * (gr - one)
            two += 0.01 * (gr * gr - two)
            p -= 0.05 * (one / (1 - 0.9 ** t)) / (np.sqrt(two / (1 - 0.99 ** t)) + 1e-8)
    m.bias = float(cell[0])
    return m


def _sample_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to, raw, off in tk.chunks(batch.column("text")):
            doc, term = terms(raw, off)
            cut = np.searchsorted(doc, np.arange(to - at + 1))
            packed = [term[a:b].astype(np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(c).slice(at, to - at) for c in ("label", "h")] + [pa.array(packed, pa.binary())],
                                             ["label", "h", "terms"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", per_label: int = SAMPLE) -> Machine:
    """Fit on the bounded sample of ``labels`` (id, label), with the texts of ``docs``: of each label the first
    ``per_label`` rows by a hash of their id, however often an id repeats."""
    chosen = None
    for value in (0, 1):
        some = (labels.where((F.col(label_col) == value) & F.col(id_col).isNotNull())
                .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
                .orderBy(F.xxhash64("_id"), "_id").limit(per_label))
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = (docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
             .join(F.broadcast(chosen), "_id").select("label", F.xxhash64("_id").alias("h"), "text"))
    found = stored(texts.mapInArrow(_sample_terms, "label int, h long, terms binary"), "toxicity-sample")
    first = [found.where(F.col("label") == value).orderBy("h", "terms").limit(per_label) for value in (0, 1)]
    rows = first[0].unionByName(first[1]).toArrow()
    # The order of the rows must not matter for the fit.
    packed = sorted(zip(rows.column("label").to_pylist(), rows.column("terms").to_pylist()))
    parts = [np.frombuffer(t, np.int32).astype(np.int64) for _, t in packed]
    doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    term = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return fit(doc, term, np.array([float(y) for y, _ in packed]))


def score(docs: DataFrame, model: Machine, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with the score of each whole text in column ``out``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*[c for c in docs.columns if c != out], F.lit(0.0).alias(out)).schema

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = sieve(shared.value.term)
        for batch in batches:
            for at, to, raw, off in tk.chunks(batch.column(text_col)):
                doc, term = terms(raw, off, ends)
                p = shared.value.score(doc, term, to - at)
                part = batch.slice(at, to - at)
                keep = [(c, part.column(c)) for c in part.schema.names if c != out]
                yield pa.RecordBatch.from_arrays([x for _, x in keep] + [pa.array(p)], [c for c, _ in keep] + [out])

    return docs.mapInArrow(scored, schema)


def held_out(id_col: Column, parts: int, which: int) -> Column:
    """Whether crc32 of the id as text leaves ``which`` modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % parts == which
