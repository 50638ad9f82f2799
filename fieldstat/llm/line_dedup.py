"""Operator 10: drop lines that many documents share (DataFrame functions only).

Lines are exploded with their position, normalised and hashed to 128 bits; the
distinct documents of each hash are counted; lines of frequent hashes go from
every document but the one with the largest id; the rest is reassembled by
position. Only hashes and positions are shuffled until the last join.

Defined results: a null or empty text is one empty line. Rows whose id is null
neither count as documents nor lose lines. Rows that repeat an id count as one
document; each keeps or loses its own lines. Columns that the input has under
the names of the result's columns are replaced. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstat.llm.tables import SPACES, ascii_lower, row_key, salted_join, stored

MIN_CHARS = 20
MIN_DOCS = 3


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Row keys and 0-based positions of the lines to drop: k1, k2, dropped (array)."""
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    lines = (docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
             .select(F.col(id_col).alias("d"), k1.alias("k1"), k2.alias("k2"),
                     F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("pos", "line"))
             .select("d", "k1", "k2", "pos", line_key(F.col("line")).alias("key"))
             .where(F.char_length("key") >= min_chars)
             .select("d", "k1", "k2", "pos", F.xxhash64(F.lit(1), "key").alias("h1"),
                     F.xxhash64(F.lit(2), "key").alias("h2")))
    lines = stored(lines, "line-keys")
    shared = (lines.groupBy("h1", "h2")
              .agg(F.countDistinct("d").alias("n"), F.count("*").alias("rows"), F.max("d").alias("keeper"))
              .where(F.col("n") >= min_docs).select("h1", "h2", "rows", "keeper"))
    shared = stored(shared, "line-shared")
    return (salted_join(lines, shared, ["h1", "h2"], "rows", ["k1", "pos"])
            .where(F.col("d") != F.col("keeper"))
            .groupBy("k1", "k2").agg(F.collect_set("pos").alias("dropped")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the shared lines gone from ``text_col``, plus n_lines and n_dropped."""
    gone = shared_lines(docs, id_col, text_col, min_chars, min_docs)
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    # The lines are split below the join, so that above it they are a column and not computed anew.
    split = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"),
        k1.alias("k1"), k2.alias("k2"),
        F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1).alias("lines"),
        F.col(text_col).isNull().alias("no_text"))
    joined = split.join(gone, ["k1", "k2"], "left")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped")),
                       lambda i: F.get(F.col("lines"), i))
    text = F.when(F.col("no_text"), F.lit(None).cast("string")).otherwise(
        F.array_join(F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(kept), "\n"))
    added = {"n_lines": F.size("lines").cast("long"),
             "n_dropped": F.coalesce(F.size("dropped"), F.lit(0)).cast("long")}
    out = [text.alias(c) if c == text_col else F.col("row").getField(c).alias(c)
           for c in docs.columns if c not in added]
    return joined.select(*out, *[v.alias(k) for k, v in added.items()])
