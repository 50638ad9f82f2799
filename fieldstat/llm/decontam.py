"""Operator 8: benchmark decontamination by spaced seeds (DataFrame functions only).

Masks of ``SPAN`` tokens hash some positions and ignore the others, so a
window whose substituted words fall on ignored positions still hits. The window
is cut into pieces and the masks leave out every choice of as many pieces as
words may differ, so that every window that counts is hit by at least one. The
hash of each mask at each position of each text meets the hashes of the
benchmark in a broadcast join; around each hit the whole window is compared on
its diagonal, and it counts if at least ``IDENTITY`` of its words agree.

The benchmark is a stated query set: it is taken in blocks of at most
``BLOCK_WINDOWS`` windows, each block is broadcast, and the corpus is
passed once per block. Of several blocks one is broadcast at a time and its
verified hits are written, so what a task or the driver holds does not grow with
the benchmark. Nothing of the corpus is shuffled but the hits.

Defined results: null and empty texts match nothing. Items of 5 to ``SPAN``-1
words are one window of their own length; items under ``MIN_WORDS`` words, null or
empty ones match nothing. Rows with equal id and text give equal results.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstat.llm.tables import n_words, row_key, stored, word_line

SPAN = 13
MIN_WORDS = 5
IDENTITY = 0.8
BLOCK_WINDOWS = 100_000


def masks(span: int, identity: float = IDENTITY) -> tuple[str, ...]:
    """Masks of which at least one looks at equal words only, wherever as many words of a window differ as may."""
    differ = math.floor(span * (1 - identity) + 1e-9)
    pieces = min(span, {0: 1, 1: 5}.get(differ, differ + 2))
    piece = [i * pieces // span for i in range(span)]
    return tuple("".join("0" if p in out else "1" for p in piece) for out in itertools.combinations(range(pieces), differ))


# Two of thirteen words may differ: six masks, each of two of four pieces.
MASKS = masks(SPAN)


def _masked(tokens: Column, at: Column, mask: str, tag: int) -> Column:
    return F.xxhash64(F.lit(tag), *[F.get(tokens, at + j) for j, m in enumerate(mask) if m == "1"])


def _token_hashes(df: DataFrame, text: str, *keep: Column) -> DataFrame:
    lined = df.select(*keep, word_line(F.col(text)).alias("line"))
    return lined.select(*[k for k in lined.columns if k != "line"],
                        F.when(F.col("line") == "", F.array().cast("array<bigint>")).otherwise(
                            F.transform(F.split("line", " "), lambda w: F.xxhash64(w))).alias("toks"),
                        n_words(F.col("line")).cast("int").alias("n"))


def _windows(tokens: DataFrame, span: int, masks: tuple[str, ...]) -> DataFrame:
    """A row for each window and mask: at, h. Stays in one generated loop over a text."""
    at = tokens.withColumn("at", F.explode(F.when(F.col("n") >= span, F.sequence(F.lit(0), F.col("n") - span))))
    return at.withColumn("h", F.explode(F.array(*[
        _masked(F.col("toks"), F.col("at"), m, 100 * span + i) for i, m in enumerate(masks)])))


def overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text: str = "text", identity: float = IDENTITY) -> DataFrame:
    """Verified overlaps: k1, k2 (row key), doc_id, item_id, first_word, last_word, n_windows, identity.

    One row for each row key and item; first and last word bound the matched
    windows in the document, identity is that of the best window.
    """
    bench = (_token_hashes(items.where(F.col(item_col).isNotNull()), item_text, F.col(item_col).alias("item"))
             .where(F.col("n") >= MIN_WORDS))
    # Reported sizes of the query set alone: short lengths (at most SPAN - MIN_WORDS) and windows.
    short = sorted(r[0] for r in bench.where(F.col("n") < SPAN).select("n").distinct().collect())
    total = bench.agg(F.sum(F.greatest(F.col("n") - SPAN + 1, F.lit(1)))).head()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_WINDOWS))
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    tokens = _token_hashes(docs, text_col, F.col(id_col).alias("d"), k1.alias("k1"), k2.alias("k2"))
    found = None
    for block in range(blocks):
        mine = bench.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        for span in (SPAN, *short):
            used = masks(span, identity)
            keys = _windows(mine.where(F.col("n") >= SPAN if span == SPAN else F.col("n") == span), span, used)
            keys = keys.select("h", "item", F.slice("toks", F.col("at") + 1, span).alias("want"))
            hits = _windows(tokens, span, used).join(F.broadcast(keys), "h")
            # Only hits are compared, outside the generated loop over all windows, which must stay small to be compiled.
            same = F.size(F.filter(F.zip_with(F.slice("toks", F.col("at") + 1, span), "want", lambda x, y: x == y),
                                   lambda equal: equal))
            hits = hits.select("d", "k1", "k2", "item", "at", (same / F.lit(float(span))).alias("identity"),
                               F.lit(span).alias("span"))
            if blocks > 1:
                hits = stored(hits.where(F.col("identity") >= identity), "leak-hits")
            found = hits if found is None else found.unionByName(hits)
    fine = F.col("identity") >= identity
    pairs = (found.groupBy("k1", "k2", F.col("d").alias(id_col), F.col("item").alias(item_col))
             .agg(F.min(F.when(fine, F.col("at"))).cast("long").alias("first_word"),
                  F.max(F.when(fine, F.col("at") + F.col("span") - 1)).cast("long").alias("last_word"),
                  F.count(F.when(fine, 1)).alias("n_hits"), F.max(F.when(fine, F.col("identity"))).alias("identity")))
    return pairs.where(F.col("n_hits") > 0)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the rows that overlap an item."""
    bad = overlaps(docs, items, id_col, text_col, item_col, item_text).select("k1", "k2").distinct()
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        k1.alias("k1"), k2.alias("k2"))
    return keyed.join(bad, ["k1", "k2"], "left_anti").select("row.*")
