"""Operator 11: groups spelling variants by dynamic programming over a sorted vocabulary.

Words within one edit (one code point inserted, deleted or replaced) are found
by scanning sorted lists of words. For a word of the list, the words behind it
are aligned with it row by row of a banded edit matrix (three cells a row). A
row depends only on the prefix read so far, so the next word keeps the rows of
the prefix that it shares with the last one (their LCP), and once a row has no
cell of at most one edit, all words that share its prefix are skipped at once.

Lists are kept short and whole. Where two near words part (their LCP) is a
position of the longer one; the positions of a word are cut into windows, and
for a window [lo, hi) and a longer length L two words are in one list if they agree
in the lo code points before it and in those after it. A pair is taken in the one
window that its LCP is in, so none is lost or taken twice. Lists of over ``LIST``
words halve their window and part again, until a window is one position; such
a list has at most one word for each code point that occurs there.

A word's form is its near word of the largest count, if that is ``RATIO`` times its
own or more; roots follow the forms by doubling, a round of joins for each
doubling.

Defined results: a null text has no words; a null id is the empty string where
a run is hashed. Rows that repeat an id or text all count. An empty table gives
no rows; other columns are not looked at. Texts may be of any length; a run of
letters is a word of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstat.llm.tables import ascii_lower, salted_join, stored

MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5
MISSPELL = 199
LIST = 128               # most words of a list that is scanned before its window is halved
FAR = 2                  # cells of the edit matrix count up to here

PAIR = "word string, n long, near string, near_n long"


def damaged(id_col: Column, run: Column, modulus: int = MISSPELL) -> Column:
    """``run`` without one code point where the hash of id and run is a multiple of ``modulus``."""
    h = F.crc32(F.concat_ws(":", F.coalesce(id_col.cast("string"), F.lit("")), run).cast("binary"))
    at = F.pmod(h, F.char_length(run)).cast("int")
    return F.when(h % modulus == 0, F.concat(F.left(run, at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
               min_count: int = MIN_COUNT, modulus: int = MISSPELL) -> DataFrame:
    """(word, n) of all words of ``docs`` that are long and frequent enough."""
    # Shorter runs cannot give a word, so the expression passes over them; a run is still matched whole.
    runs = F.regexp_extract_all(ascii_lower(F.col(text_col)), F.lit(f"[a-zÀ-ÿ]{{{min_chars},}}"), F.lit(0))
    words = docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("run"))
    words = words.select(damaged(F.col("id"), F.col("run"), modulus).alias("word"))
    return (words.where(F.char_length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= min_count))


def common(a: str, b: str) -> int:
    """How many code points two words share at their beginning."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def near_in_sorted(words: list[str]) -> Iterator[tuple[int, int]]:
    """Positions (i < j) of the words of a sorted list of distinct words that are one edit apart."""
    n = len(words)
    lcp = [0, *(common(a, b) for a, b in zip(words, words[1:]))]
    smaller = [n] * n                      # the next position with a smaller LCP
    open_at: list[int] = []
    for j, d in enumerate(lcp):
        while open_at and lcp[open_at[-1]] > d:
            smaller[open_at.pop()] = j
        open_at.append(j)
    rows = [(FAR, 0, 1)] + [(1, 0, 1)] * max(map(len, words), default=0)
    for i in range(n - 1):
        m = len(words[i])
        q = [*words[i], None, None, None]
        # rows[d] holds the cells (d, d - 1), (d, d), (d, d + 1) of the matrix of the prefix read and of q.
        j, d = i + 1, lcp[i + 1]
        rows[:d + 1] = [(FAR, 0, 1)] + [(1, 0, 1)] * d
        while True:
            w, best = words[j], 0
            a, b, c = rows[d]
            for d in range(d, len(w)):
                x = w[d]
                a = min(a + (q[d - 1] != x), b + 1)
                b = min(b + (q[d] != x), a + 1, c + 1)
                c = min(c + (q[d + 1] != x), b + 1)
                rows[d + 1] = (a, b, c)
                if a >= FAR and b >= FAR and c >= FAR:
                    best = FAR
                    break
            if best < FAR:
                k = m - len(w)
                if -1 <= k <= 1 and rows[len(w)][k + 1] < FAR:
                    yield i, j
                j += 1
            else:
                j += 1
                while j < n and lcp[j] > d:
                    j = smaller[j]
            if j >= n:
                break
            d = lcp[j]


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: list[tuple[str, int, str, int]] = []
        for size, lo, hi, members in zip(*(batch.column(c).to_pylist() for c in ("size", "lo", "hi", "members"))):
            members = sorted((m["word"], m["n"]) for m in members)
            words = [w for w, _ in members]
            for i, j in near_in_sorted(words):
                if max(len(words[i]), len(words[j])) == size and lo <= common(words[i], words[j]) < hi:
                    found += [(*members[i], *members[j]), (*members[j], *members[i])]
        cols = list(zip(*found)) if found else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                          pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64())],
                                         ["word", "n", "near", "near_n"])


def _windows(lo: Column, hi: Column) -> Column:
    mid = F.floor((lo + hi) / 2).cast("int")
    return F.array(F.struct(lo.alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), hi.alias("hi")))


def near_words(vocab: DataFrame, limit: int = LIST) -> DataFrame:
    """(word, n, near, near_n): every pair of words of ``vocab`` (word, n) one edit apart, in both orders."""
    length = F.char_length("word")
    rows = vocab.select("word", "n", F.explode(F.array(length, length + 1)).alias("size"))
    rows = rows.select("word", "n", "size", F.inline(_windows(F.lit(0), F.col("size"))))
    key = ["size", "lo", "hi", "h"]
    found = None
    while True:
        h = F.xxhash64(F.left("word", F.col("lo")), F.right("word", F.col("size") - F.col("hi")))
        rows = stored(rows.select("word", "n", "size", "lo", "hi", h.alias("h")), "spelling-windows")
        lists = stored(rows.groupBy(*key).agg(F.count("*").alias("rows")).where(F.col("rows") > 1), "spelling-lists")
        done = (F.col("rows") <= limit) | (F.col("hi") - F.col("lo") == 1)
        whole = (rows.hint("merge").join(lists.where(done).select(*key), key)
                 .groupBy(*key).agg(F.collect_list(F.struct("word", "n")).alias("members")))
        pairs = stored(whole.select("size", "lo", "hi", "members").mapInArrow(_scanned, PAIR), "spelling-pairs")
        found = pairs if found is None else found.unionByName(pairs)
        long = lists.where(~done)
        if long.isEmpty():
            return found
        rows = salted_join(rows, long, key, "rows", ["word"]).select(
            "word", "n", "size", F.inline(_windows(F.col("lo"), F.col("hi")))).where(F.col("lo") < F.col("hi"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every row of ``forms`` (word, form): the end of the chain of forms. Chains have no cycle."""
    at = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        weight = at.groupBy("root").agg(F.count("*").alias("n"))
        ahead = ahead.join(weight.hint("merge"), "root")
        moved = stored(salted_join(at, ahead, ["root"], "n", ["word"]).select("word", F.col("next").alias("root")), "spelling-moved")
        if moved.isEmpty():
            return at
        rest = at.join(moved.select("word").hint("merge"), "word", "left_anti")
        at = stored(rest.unionByName(moved), "spelling-roots")


def variants(vocab: DataFrame, ratio: int = RATIO, limit: int = LIST) -> DataFrame:
    """Each word of ``vocab`` (word, n) with its form, root, number of near words and its form's count."""
    vocab = stored(vocab, "spelling-vocabulary")
    # Of the near words, the most frequent, then the first in code-point order.
    near = (near_words(vocab, limit).groupBy("word", "n")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    formed = -F.col("best.less") >= ratio * F.col("n")
    near = stored(near.select("word", "n_near", F.when(formed, F.col("best.near")).alias("form"),
                              F.when(formed, -F.col("best.less")).alias("form_n")), "spelling-near")
    ends = roots(near.where(F.col("form").isNotNull()).select("word", "form"))
    return (vocab.hint("merge").join(near, "word", "left").hint("merge").join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                      min_count: int = MIN_COUNT, ratio: int = RATIO, modulus: int = MISSPELL, limit: int = LIST) -> DataFrame:
    """The words of ``docs`` with their spelling groups, as ``variants`` has them."""
    return variants(vocabulary(docs, id_col, text_col, min_chars, min_count, modulus), ratio, limit)
