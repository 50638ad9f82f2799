"""Small tables with every awkward row, and plain-Python versions of the operators."""

import re

from pyspark.sql import types as T

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def numbered(n, start=0):
    return " ".join(f"w{start + i}x" for i in range(n))


def docs(spark, rows):
    """Rows of (doc_id, text[, source[, lang]])."""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "a", None) for r in rows]
    return spark.createDataFrame(full, DOCS)


AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (None, "alpha beta"), (None, None), (4, numbered(30_000)), (5, "same text here"),
           (5, "same text here"), (6, "Ünïcode wörds ¿qué? 漢字"), (7, "\n\n"), (8, "!!! ... ---")]


def jaccard(a, b, k=5):
    def grams(t):
        w = words(t)
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x | y else 0.0
