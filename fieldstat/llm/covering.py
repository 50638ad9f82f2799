"""Operator 12: SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has a bit for every bit of its shingles' XXH64 hashes, set
if over half of the hashes have it. Fingerprints link if they differ in at most
``RADIUS`` bits. Every bit position i has a non-zero vector of ``RADIUS`` + 1
bits, dealt in turn; a table's mask holds the positions whose vector has an odd
product with the table's own vector. At most ``RADIUS`` positions span fewer
than ``RADIUS`` + 1 dimensions, so some non-zero vector is orthogonal to them all:
its mask ignores every position in which the two fingerprints differ, and they
collide in that table. No pair within the radius is missed.

Texts of equal fingerprint are one node, so copies cost nothing. A bucket of up
to ``BUCKET`` fingerprints is searched whole inside one task, which returns a star
for each of its connected parts, never all pairs. Fingerprints of larger buckets
meet by an exact join instead: each is dealt to all points up to RADIUS // 2 bits
away and looks up all points up to the rest away; those that share a point are
within the radius if one has it in its smaller ball. The rows of this join grow
with the fingerprints, not with their pairs.

Defined results: a null text is empty; one without words has the fingerprint 0,
linked like any other; one of fewer than ``K`` words has one shingle. Rows that
repeat an id or a text each come back, with the component of their own
fingerprint. A null id takes part, but is no component's smallest id (null
where a component has no other). Other columns are not looked at; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstat.llm import textkit as tk
from fieldstat.llm.near_dup import components
from fieldstat.llm.tables import SPACE_CLASS, ascii_lower, salted_join, stored

K = 3
SEED = 42
BITS = 64
RADIUS = 3
BUCKET = 16_384          # most fingerprints of a bucket that one task searches
SLICE = 100_000          # shingles hashed at once
BLOCK = 256              # fingerprints compared with a bucket's rest at once


def masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """One mask for each non-zero vector of radius + 1 bits."""
    n = (1 << (radius + 1)) - 1
    vectors = [1 + i % n for i in range(bits)]
    return [sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() & 1) for v in range(1, n + 1)]


def ball(radius: int, bits: int = BITS) -> list[int]:
    """All numbers with at most ``radius`` of ``bits`` bits set."""
    return [sum(1 << i for i in some) for r in range(radius + 1) for some in combinations(range(bits), r)]


def _long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(_long(v)) for v in values]).cast("array<bigint>")


def word_runs(text: Column) -> Column:
    """The words of a text (runs without white space, A-Z lower-cased), joined by single spaces."""
    return F.btrim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), f"[{SPACE_CLASS}]+", " "))


def simhash(raw: np.ndarray, off: np.ndarray, k: int = K, seed: int = SEED) -> np.ndarray:
    """Fingerprints of the texts raw[off[i]:off[i + 1]], whose words single spaces separate."""
    n = len(off) - 1
    gap = np.flatnonzero(raw == 0x20)
    full = np.flatnonzero(np.diff(off) > 0)
    start = np.sort(np.concatenate([gap + 1, off[:-1][full]]))
    end = np.sort(np.concatenate([gap, off[1:][full]]))
    doc = np.searchsorted(off, start, "right") - 1
    words = np.bincount(doc, minlength=n)
    first = np.searchsorted(doc, np.arange(n))
    # A shingle begins at each word that has k - 1 more behind it in its text; a shorter text has one of them all.
    behind = (first + words)[doc] - np.arange(len(doc))
    opens = np.flatnonzero((behind >= k) | (np.arange(len(doc)) == first[doc]))
    closes = opens + np.minimum(behind[opens], k) - 1
    begin, stop, doc = start[opens], end[closes], doc[opens]
    count = np.zeros((n, BITS), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(opens), SLICE):
        part = slice(at, at + SLICE)
        base = int(begin[part][0])
        data = raw[base:int(stop[part][-1])].tobytes()
        h = np.fromiter((digest(data[s:e], seed) for s, e in zip((begin[part] - base).tolist(), (stop[part] - base).tolist())),
                        np.uint64, len(begin[part]))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cut = np.flatnonzero(np.diff(doc[part], prepend=-1))
        count[doc[part][cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    total = np.bincount(doc, minlength=n)
    return np.packbits(2 * count > total[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to, raw, off in tk.chunks(batch.column("line")):
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, to - at), pa.array(simhash(raw, off).view(np.int64))],
                                             ["id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), word_runs(F.col(text_col)).alias("line"))
    return rows.mapInArrow(_fingerprints, "id long, fp long")


def parts(fp: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint the position of the first one that links connect it with."""
    fp = fp.view(np.uint64)
    label = np.arange(len(fp))
    rest = np.arange(len(fp))
    while len(rest):
        root, front, rest = rest[0], rest[:1], rest[1:]
        while len(front) and len(rest):
            near = np.zeros(len(rest), bool)
            for at in range(0, len(front), BLOCK):
                apart = np.bitwise_count(fp[front[at:at + BLOCK], None] ^ fp[rest][None, :])
                near |= (apart <= radius).any(axis=0)
            front, rest = rest[near], rest[~near]
            label[front] = root
    return label


def _stars(radius: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for fps in batch.column("fps"):
                fp = fps.values.to_numpy(zero_copy_only=False)
                label = parts(fp, radius)
                linked = label != np.arange(len(fp))
                u.append(fp[linked])
                v.append(fp[label[linked]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])

    return found


def joined_balls(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) that connect all fingerprints of ``fps`` (fp) within the radius, without forming their pairs."""
    small = radius // 2
    point = F.col("fp").bitwiseXOR(F.col("e"))
    inner = (fps.select("fp", F.explode(_longs(ball(small))).alias("e"))
             .groupBy(point.alias("p")).agg(F.min("fp").alias("v")))
    outer = fps.select("fp", F.explode(_longs(ball(radius - small))).alias("e")).select(point.alias("p"), F.col("fp").alias("u"))
    return outer.hint("merge").join(inner, "p").where(F.col("u") != F.col("v")).select("u", "v").distinct()


def links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges (u, v) between distinct fingerprints ``fps`` (fp): connected exactly as all pairs within the radius are."""
    tables = [F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(_long(m))).alias("key")) for i, m in enumerate(masks(radius))]
    keys = fps.select("fp", F.explode(F.array(*tables)).alias("t")).select("t.mask", "t.key", "fp")
    full = stored(keys.groupBy("mask", "key").agg(F.min("fp").alias("u"), F.max("fp").alias("v"), F.count("*").alias("n"))
                  .where(F.col("n") > 1), "cover-buckets")
    pairs = full.where((F.col("n") == 2) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)).select("u", "v")
    several = full.where((F.col("n") > 2) & (F.col("n") <= bucket)).select("mask", "key")
    lists = (keys.hint("merge").join(several, ["mask", "key"]).groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")).select("fps"))
    edges = pairs.unionByName(lists.mapInArrow(_stars(radius), "u long, v long"))
    large = full.where(F.col("n") > bucket)
    if not large.isEmpty():
        hot = salted_join(keys, large.select("mask", "key", "n"), ["mask", "key"], "n", ["fp"]).select("fp").distinct()
        edges = edges.unionByName(joined_balls(stored(hot, "cover-hot"), radius))
    return edges


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs``: the id, its fingerprint (16 hex digits), component_id."""
    prints = stored(fingerprints(docs, id_col, text_col), "cover-prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "cover-nodes")
    edges = links(nodes.select("fp"), radius, bucket)
    roots = stored(components(edges).select(F.col("id").alias("fp"), F.col("class_id").alias("root")), "cover-roots")
    placed = nodes.hint("merge").join(roots, "fp", "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("size"))
    named = salted_join(placed, least, ["root"], "size", ["fp"]).select("fp", "n", "component_id")
    out = salted_join(prints, stored(named, "cover-named"), ["fp"], "n", ["id"])
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
