"""Operator 6: near-duplicate documents by ProbMinHash, banding and verification.

Every text becomes a weighted set of ``K``-word shingles (weight: occurrences).
For each shingle a Poisson process of the weight's rate deals arrivals over
``SIZE`` components; a component keeps the shingle that arrives first. Arrivals
later than the latest first arrival cannot matter, so the processes stop there.
Two texts agree in a component with the probability Jaccard similarity. Bands
of ``ROWS`` components make buckets; every member of a bucket is compared with
the bucket's smallest and its largest id; candidates are verified by the exact
similarity of the whole texts; connected verified links are a class. A bucket
whose members are then all in one class is settled. In the others every pair of
members that are not yet in one class is compared, in tiles of ``TILE`` x
``TILE`` texts, so that classes are those of all similar pairs that share a
bucket, and no task holds more than a tile of a hot bucket.

Exact copies are collapsed by a 128-bit hash before anything else, so a group
of copies costs one text. Hot buckets, hot partners and hot copy groups are
salted. Links, components and fingerprints stay distributed.

Defined results: a null text, and one without any word, is like no other and is
a class of its own. A text of fewer than ``K`` words has one shingle. Every
different text is a node with a number of its own, in order of its smallest id: rows
that repeat an id and a text are copies of each other, rows that repeat an id with
another text are classed, linked, kept and dropped by their own text. Rows whose id is null come back with null class. An empty
table gives no rows; other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstat.llm import textkit as tk
from fieldstat.llm.tables import salted_join, stored

K = 5
SIMILARITY = 0.8
ROWS, BANDS = 5, 25
SIZE = ROWS * BANDS
TILE = 200               # texts on either side of a tile of an open bucket
ARRIVALS = 200           # arrivals drawn at once for a text, at least one for each of its shingles
WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"


def signatures(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, n_docs: int, size: int = SIZE) -> np.ndarray:
    """ProbMinHash: for each text and component the shingle with the first arrival; 0 where a text has none."""
    first = np.full(n_docs * size, np.inf)
    who = np.zeros(n_docs * size, tk.U64)
    each = np.bincount(doc, minlength=n_docs)
    live = np.arange(len(h))
    time = np.zeros(len(h))
    drawn = np.zeros(len(h), np.int64)
    while len(live):
        k = np.maximum(1, -(-ARRIVALS // each[doc[live]]))
        el = np.repeat(live, k)
        begin = np.cumsum(k) - k
        nth = np.arange(len(el)) - np.repeat(begin, k) + drawn[el]
        seed = tk.mix64(h[el] + (nth + 1).astype(tk.U64) * tk.ODD[7])
        wait = -np.log(((seed >> tk.U64(11)).astype(np.float64) + 0.5) / float(1 << 53)) / weight[el]
        total = np.cumsum(wait)
        base = np.concatenate([[0.0], total])[begin]
        t = total - np.repeat(base, k) + time[el]
        drawn[live] += k
        time[live] = t[begin + k - 1]
        slot = doc[el] * size + (tk.mix64(seed + tk.ODD[9]) % tk.U64(size)).astype(np.int64)
        np.minimum.at(first, slot, t)
        won = first[slot] == t
        who[slot[won]] = h[el[won]]
        limit = first.reshape(n_docs, size).max(axis=1)
        live = live[time[live] < limit[doc[live]]]
    return who.reshape(n_docs, size)


def band_keys(who: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit bucket key for each band of a signature."""
    n, size = who.shape
    parts = who.reshape(n, size // rows, rows)
    key = np.zeros(parts.shape[:2], tk.U64)
    for j in range(rows):
        key += parts[:, :, j] * tk.ODD[j + 10]
    return tk.mix64(key + tk.ODD[20] * np.arange(1, size // rows + 1, dtype=tk.U64))


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to, raw, off in tk.chunks(batch.column("text")):
            doc, h, n = tk.counted(*tk.shingles(tk.words(raw, off), K))
            keys = band_keys(signatures(doc, h, n.astype(float), to - at)).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(to - at + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
            part = batch.slice(at, to - at)
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("f1"), part.column("f2"), lists],
                                             ["id", "f1", "f2", "keys"])


def similarity(h: np.ndarray, x: np.ndarray, y: np.ndarray) -> float:
    """Exact probability Jaccard of two weightings of the same elements."""
    both = (x > 0) & (y > 0)
    if not both.any():
        return 0.0
    if x.max() <= 1 and y.max() <= 1:
        return float(both.sum()) / len(h)
    ratio = np.where(y > 0, x / np.maximum(y, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    ratio, x, y = ratio[order], x[order].astype(float), y[order].astype(float)
    r = ratio[(x > 0) & (y > 0)]
    at = np.searchsorted(ratio, r, "left")
    less = np.concatenate([[0.0], np.cumsum(y)])[at]
    more = x.sum() - np.concatenate([[0.0], np.cumsum(x)])[at]
    return float((x[(x > 0) & (y > 0)] / (r * less + more)).sum())


def weighted_similarity(ha: np.ndarray, na: np.ndarray, hb: np.ndarray, nb: np.ndarray) -> float:
    """Similarity of two texts by their sorted shingles and counts."""
    every = np.union1d(ha, hb)
    x, y = np.zeros(len(every), np.int64), np.zeros(len(every), np.int64)
    x[np.searchsorted(every, ha)] = na
    y[np.searchsorted(every, hb)] = nb
    return similarity(every, x, y)


def pair_similarities(left: pa.Array, right: pa.Array, k: int = K) -> np.ndarray:
    """Similarity of each pair of texts."""
    sides = []
    for side in (left, right):
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for at, to, raw, off in tk.chunks(side):
            doc, h, n = tk.counted(*tk.shingles(tk.words(raw, off), k))
            cut = np.searchsorted(doc, np.arange(to - at + 1))
            found += [(h[a:b], n[a:b]) for a, b in zip(cut[:-1], cut[1:])]
        sides.append(found)
    out = np.zeros(len(left))
    for i, ((ha, na), (hb, nb)) in enumerate(zip(*sides)):
        if not len(ha) or not len(hb):
            continue
        out[i] = weighted_similarity(ha, na, hb, nb)
    return out


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        step = 256
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            s = pair_similarities(part.column("leader_text"), part.column("member_text"))
            yield pa.RecordBatch.from_arrays([part.column("leader"), part.column("member"), pa.array(s)],
                                             ["leader", "member", "similarity"])


def candidates(reps: DataFrame) -> DataFrame:
    """(leader, member) pairs from ``reps`` (id, keys): each member of a bucket with its ends."""
    buckets = stored(reps.select("id", F.posexplode("keys").alias("band", "key")).select("key", "id"), "near-buckets")
    ends = (buckets.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n"))
            .where(F.col("low") < F.col("high")))
    pairs = salted_join(buckets, stored(ends, "near-ends"), ["key"], "n", ["id"])
    pairs = pairs.select("id", F.explode(F.array("low", "high")).alias("leader")).where(F.col("id") != F.col("leader"))
    return pairs.select("leader", F.col("id").alias("member")).distinct()


def links(pairs: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Verified links (leader, member, similarity) of candidate pairs; ``texts`` has id and text."""
    pairs = stored(pairs, "near-pairs")
    nodes = pairs.select(F.explode(F.array("leader", "member")).alias("id")).distinct()
    # The lists of ids grow with the corpus: texts meet them by a shuffle at every size, never by a broadcast.
    used = stored(texts.join(nodes.hint("merge"), "id", "left_semi"), "near-texts")
    weight = pairs.groupBy("leader").count()
    leaders = used.join(weight.hint("merge"), used["id"] == weight["leader"]).select(
        "leader", F.col("text").alias("leader_text"), "count")
    members = pairs.hint("merge").join(used.select(F.col("id").alias("member"), F.col("text").alias("member_text")), "member")
    both = salted_join(members, leaders, ["leader"], "count", ["member"], rows_per_salt=200)
    checked = both.select("leader", "member", "leader_text", "member_text").mapInArrow(
        _verified, "leader long, member long, similarity double")
    return checked.where(F.col("similarity") >= least)


def _tile_links(least: float):
    """Verified links of one tile: members of two classes, each pair only in the first bucket that both are in."""
    def found(tile: pa.Table) -> pa.Table:
        ids, classes = tile.column("id").to_numpy(), tile.column("class_id").to_numpy()
        half = tile.column("half").to_numpy()
        keys = np.array(tile.column("keys").to_pylist(), np.int64)
        same = tile.column("a")[0].as_py() == tile.column("b")[0].as_py()
        left = np.flatnonzero(half == tile.column("a")[0].as_py())
        right = left if same else np.flatnonzero(half != tile.column("a")[0].as_py())
        texts, out = [], []
        if not len(left) or not len(right):
            left = right = left[:0]
        band = int(np.argmax(keys[0] == tile.column("key")[0].as_py()))
        for _, to, raw, off in tk.chunks(tile.column("text")):
            doc, h, n = tk.counted(*tk.shingles(tk.words(raw, off), K))
            cut = np.searchsorted(doc, np.arange(len(off)))
            texts += [(h[a:b], n[a:b]) for a, b in zip(cut[:-1], cut[1:])]
        for i in left:
            others = right[right > i] if same else right
            others = others[(classes[others] != classes[i]) & (ids[others] != ids[i])]
            others = others[~(keys[others, :band] == keys[i, :band]).any(1)]
            for j in others:
                s = weighted_similarity(*texts[i], *texts[j])
                if s >= least:
                    out.append((min(ids[i], ids[j]), max(ids[i], ids[j]), s))
        x, y, s = zip(*out) if out else ((), (), ())
        return pa.table({"leader": pa.array(x, pa.int64()), "member": pa.array(y, pa.int64()), "similarity": pa.array(s, pa.float64())})

    return found


def links_across(reps: DataFrame, classes: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Verified links between members of a bucket that ``classes`` (id, class_id) leaves in several classes.

    ``reps`` has id and keys, ``texts`` id and text. A bucket's ends have been compared with all its members.
    """
    placed = reps.select("id", "keys").join(classes.hint("merge"), "id", "left").withColumn("class_id", F.coalesce("class_id", "id"))
    placed = stored(placed, "near-placed")
    buckets = placed.select("id", "class_id", F.explode("keys").alias("key"))
    parts = buckets.groupBy("key", "class_id").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n"))
    several = (parts.groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"),
                                        F.max(F.struct("n", "class_id")).alias("most"), F.count("*").alias("classes"))
               .where((F.col("n") > 3) & (F.col("classes") > 1)))
    several = stored(several.select("key", "low", "high", "n", F.col("most.class_id").alias("most"),
                                    F.ceil(F.col("most.n") / TILE).cast("int").alias("own"),
                                    F.ceil((F.col("n") - F.col("most.n")) / TILE).cast("int").alias("rest")), "near-several")
    inside = salted_join(buckets, several, ["key"], "n", ["id"]).where((F.col("id") != F.col("low")) & (F.col("id") != F.col("high")))
    # Halves 0 to rest - 1 hold the other classes, those after them the largest class, which need not meet itself.
    large = F.col("class_id") == F.col("most")
    half = F.when(large, F.col("rest") + F.pmod(F.xxhash64("id"), F.col("own"))).otherwise(F.pmod(F.xxhash64("id"), F.col("rest")))
    inside = inside.select("id", "key", half.cast("int").alias("half"),
                           F.when(large, F.col("rest")).otherwise(F.col("rest") + F.col("own")).alias("halves"))
    inside = stored(inside, "near-inside")
    weight = inside.groupBy("id").agg(F.count("*").alias("n"))
    one = texts.dropDuplicates(["id"]).join(weight.hint("merge"), "id").join(placed.hint("merge"), "id")
    rows = inside.hint("merge").join(one.drop("n"), "id")
    tiles = rows.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("halves") - 1))).select(
        "key", F.least("half", "to").alias("a"), F.greatest("half", "to").alias("b"), "half", "id", "class_id", "keys", "text")
    return tiles.groupBy("key", "a", "b").applyInArrow(_tile_links(least), "leader long, member long, similarity double")


def components(edges: DataFrame) -> DataFrame:
    """(id, class_id): the smallest id connected with each id of ``edges`` (u, v).

    Alternating large-star and small-star steps; hubs are salted. Only a count
    and a checksum of the edges reach the driver.
    """
    now = stored(edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "near-edges")
    state = None
    while True:
        for large in (True, False):
            sides = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else now
            least = stored(sides.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
                           .withColumn("m", F.least("u", "m")), "near-least")
            beside = salted_join(sides, least, ["u"], "n", ["v"])
            if large:
                out = beside.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            else:
                out = beside.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                    least.select("u", F.col("m").alias("v")))
            now = stored(out.where(F.col("u") != F.col("v")).distinct(), "near-edges")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if mark == state:
            break
        state = mark
    return now.select(F.col("u").alias("id"), F.col("v").alias("class_id"))


@dataclass
class Classes:
    """``prints``: id, f1, f2 of every row with an id and words; ``groups``: f1, f2 of every different text with copy_of (its
    smallest id), n (rows), node (its number, in order of copy_of), kept (the least of its class), class_id, n_links."""

    prints: DataFrame
    groups: DataFrame
    rows: DataFrame


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> Classes:
    """Classes of near-duplicate texts. Texts are told apart by their hashes, so equal ids with different texts do not mix."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumns({"f1": F.xxhash64(F.lit(1), "text"), "f2": F.xxhash64(F.lit(2), "text")})
    able = rows.where(F.col("id").isNotNull() & F.col("text").rlike(WORD))
    prints = stored(able.mapInArrow(_bands, "id long, f1 long, f2 long, keys array<long>"), "near-keys")
    groups = stored(prints.groupBy("f1", "f2").agg(F.min("id").alias("copy_of"), F.count("*").alias("n")), "near-copies")
    # Ranges are in order and sorted, so the numbers rise with copy_of; writing fixes them.
    order = ["copy_of", "f1", "f2"]
    groups = groups.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("node", F.monotonically_increasing_id())
    groups = stored(groups, "near-nodes")
    key = ["f1", "f2", "id"]
    nodes = groups.select("f1", "f2", F.col("copy_of").alias("id"), "node")
    reps = (prints.hint("merge").join(nodes, key).select(F.col("node").alias("id"), "f1", "keys").dropDuplicates(["id"]))
    texts = able.join(nodes.hint("merge"), key).select(F.col("node").alias("id"), "text").dropDuplicates(["id"])
    found = stored(links(candidates(reps), texts, least), "near-links")
    classes = components(found.select(F.col("leader").alias("u"), F.col("member").alias("v")))
    across = stored(links_across(reps, classes, texts, least).distinct(), "near-across")
    if not across.isEmpty():
        found = found.unionByName(across)
        classes = components(found.select(F.col("leader").alias("u"), F.col("member").alias("v")))
    degree = found.select(F.explode(F.array("leader", "member")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    # The least node of a class, which ``classes`` leaves out, has its least id: nodes are numbered in order of copy_of.
    linked = stored(classes.select(F.col("id").alias("node"), F.col("class_id").alias("class_node")), "near-linked")
    sizes = linked.groupBy("class_node").agg(F.count("*").alias("size"))
    heads = sizes.hint("merge").join(groups.select(F.col("node").alias("class_node"), F.col("copy_of").alias("class_id")), "class_node")
    named = salted_join(linked, heads, ["class_node"], "size", ["node"])
    groups = (groups.hint("merge").join(named.select("node", "class_node", "class_id"), "node", "left").join(degree.hint("merge"), "node", "left")
              .select("f1", "f2", "copy_of", "n", F.coalesce(F.col("class_node") == F.col("node"), F.lit(True)).alias("kept"),
                      F.coalesce("class_id", "copy_of").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return Classes(prints.select("id", "f1", "f2"), stored(groups, "near-groups"), rows)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    least: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: the id, copy_of (smallest id of the equal texts), class_id, n_links."""
    found = classify(docs, id_col, text_col, least)
    placed = salted_join(found.prints, found.groups, ["f1", "f2"], "n", ["id"])
    placed = placed.select(F.col("id").alias(id_col), "copy_of", "class_id", "n_links")
    alone = found.rows.where(F.col("id").isNull() | ~F.coalesce(F.col("text").rlike(WORD), F.lit(False)))
    return placed.unionByName(alone.select(
        F.col("id").alias(id_col), F.col("id").alias("copy_of"), F.col("id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of every class: the smallest id, of equal ids the smallest text hash.

    Rows are told apart by id and text, so a row that shares its id with another text stays or goes by its
    own text. Rows without words and rows without id stay, one of those that are equal in id and text."""
    found = classify(docs, id_col, text_col, least)
    placed = salted_join(found.prints, found.groups, ["f1", "f2"], "n", ["id"])
    gone = placed.where(~F.col("kept") | (F.col("id") != F.col("copy_of"))).select(
        F.col("id").alias("_id"), F.col("f1").alias("_f1"), F.col("f2").alias("_f2")).distinct()
    gone = stored(gone, "near-gone")
    keyed = docs.withColumns({"_f1": F.xxhash64(F.lit(1), text_col), "_f2": F.xxhash64(F.lit(2), text_col),
                              "_id": F.col(id_col).cast("long")})
    kept = keyed.join(gone, ["_id", "_f1", "_f2"], "left_anti")
    return kept.dropDuplicates(["_id", "_f1", "_f2"]).drop("_id", "_f1", "_f2")
