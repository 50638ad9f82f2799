"""Operators 3, 4, 8 and 10 against plain Python, on awkward rows."""

import hashlib
import itertools
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fieldstat.llm import decontam, license, line_dedup, mixing
from tests.llm.helpers import AWKWARD, UPPER, docs, numbered, words

SPACES = " \t\n\v\f\r"


def brute_lines(rows):
    holders = defaultdict(set)
    for i, t in rows:
        if i is not None and t is not None:
            for line in t.split("\n"):
                holders[line.strip(SPACES).translate(UPPER)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keys = [x.strip(SPACES).translate(UPPER) for x in lines]
        keep = [x for x, k in zip(lines, keys)
                if i is None or len(k) < 20 or len(holders[k]) < 3 or max(holders[k]) == i]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return Counter(out)


def test_line_dedup(spark):
    common = "A line that Many documents hold"
    rows = [(i, f"own {i}\n  {common.upper() if i % 2 else common}\t\nshort\nown {i}") for i in range(12)]
    rows += [(20, f"{common}\n{common}\nx"), (20, f"{common}\ny"), (21, "É line with accents, in two\nz"), (22, "é line with accents, in two"),
             (23, "É line with accents, in two"), (24, "ab\r\nab "), (25, "only twice, long enough\n"), (26, "only twice, long enough"),
             (26, "only twice, long enough")] + AWKWARD
    got = line_dedup.dedup_lines(docs(spark, rows)).withColumn("text", F.coalesce("text", F.lit("")))
    found = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect())
    assert found == brute_lines(rows)


def test_line_dedup_clashing_and_empty(spark):
    d = docs(spark, [(i, "the very same long line here") for i in range(4)])
    d = d.withColumns({"n_lines": F.lit("x"), "k1": F.lit(1), "h1": F.lit(2), "pos": F.lit(3), "line": F.lit("q"), "row": F.lit(0)})
    out = line_dedup.dedup_lines(d)
    assert out.columns.count("n_lines") == 1 and {"k1", "h1", "pos", "line", "row"} < set(out.columns)
    assert {(r.doc_id, r.text) for r in out.collect()} == {(0, ""), (1, ""), (2, ""), (3, "the very same long line here")}
    assert line_dedup.dedup_lines(d.limit(0)).count() == 0


def brute_base(text):
    w = words(text)
    found = []
    for phrase, label in license.BASE:
        p = phrase.split()
        found += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    at = [i for i, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_license_base(spark):
    rows = [(10, "The MIT License. mit license, MIT\nLicense"), (11, "CC BY-SA 4.0 and the apache   LICENSE"), (12, "smit license"),
            (13, "GNU General Public License v3, gnu general public license"), (14, "xcc by, cc bye, cc\nby"), (15, "é MIT license é"),
            (16, "apache license mit license apache license")] + AWKWARD
    got = license.scan(docs(spark, rows)).collect()
    want = Counter(brute_base(t) for _, t in rows)
    assert Counter((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_license_many_notices_in_one_text(spark):
    rows = [(n, "a mit license, b " * n) for n in (0, 1, 2, 3, 7, 60_000)]
    found = {r.doc_id: r for r in license.scan(docs(spark, rows)).collect()}
    for n, _ in rows:
        assert (found[n].n_found, found[n].n_base, found[n].labels) == (n, n, "mit" if n else "")
    assert len({rx for *_, rx in license.rules()}) > 500 and len(license.NAMES) + len(license.BODIES) > 150


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"),
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
    ("SPDX-License-Identifier: MIT", "mit"),
    ("the GNU Lesser General Public License, version 2.1", "lgpl-2.1"),
    ("Mozilla Public License and Boost Software License", "bsl,mpl"),
    ("you need a driving license", ""),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files", "mit"),
    ("Redistribution and use in source and binary forms, with or without\n   modification, are permitted provided", "bsd"),
    ("GNU GPL", "gpl"), ("under GPLv3 or later", "gpl-3"), ("Apache-2.0", "apache-2.0"), ("Licensed under LGPL", "lgpl"),
    ("Creative Commons Attribution 4.0 International", "cc-by-4.0"), ("see https://www.gnu.org/licenses/lgpl-3.0.html", "lgpl-3"),
    ("you may redistribute the chairs in this room, without asking", ""),
])
def test_license_rules(spark, text, labels):
    assert license.scan(docs(spark, [(1, text)])).head().labels == labels


def test_license_suppression(spark):
    # A mention inside a grant, and that inside a version, count once; a second mention counts again.
    r = license.scan(docs(spark, [(1, "Licensed under the Mozilla Public License, version 2.0. Mozilla Public License")])).head()
    assert (r.labels, r.n_found, r.score) == ("mpl,mpl-2.0", 2, 0.9)
    assert len(license.rules()) > 300
    d = docs(spark, [(1, "mit license")]).withColumns({"labels": F.lit(1), "line": F.lit(2), "low": F.lit(3), "n": F.lit(4)})
    out = license.scan(d)
    assert out.columns.count("labels") == 1 and out.head().low == 3 and license.scan(d.limit(0)).count() == 0


def test_license_white_space(spark):
    # None of these holds another stem, so nothing else opens the base scan.
    rows = [(i, t) for i, t in enumerate(["CC\nBY", "CC BY", "CC/BY", "cc_by x", "CC: BY", "a cc  by b", "xcc by"])]
    got = license.scan(docs(spark, rows)).collect()
    assert Counter((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == Counter(brute_base(t) for _, t in rows)
    assert all(r.score >= license.BASE_SURE and "cc-by" in r.labels for r in got if r.n_base) and sum(r.n_base for r in got) == 6
    wrapped = [(1, "the GNU Lesser General\nPublic License,\n  version 2.1"), (2, "Mozilla  Public\t License"), (3, "placed into\nthe public\r\ndomain"),
               (4, "Creative\nCommons  Zero"), (5, "licensed\nunder the terms  of the zlib\nlicense")]
    got = {r.doc_id: r.labels for r in license.scan(docs(spark, wrapped)).collect()}
    assert got == {1: "lgpl-2.1", 2: "mpl", 3: "public-domain", 4: "cc0", 5: "zlib"}


def water(sizes, weights=(5, 2, 1), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    target, fixed, total = {}, set(), sum(sizes.values())
    while True:
        left = total - sum(cap * sizes[s] for s in fixed)
        free = sum(w[s] for s in order if s not in fixed)
        target = {s: cap * sizes[s] if s in fixed else left * w[s] / free for s in order}
        over = {s for s in order if s not in fixed and target[s] > cap * sizes[s]}
        if not over:
            return target
        fixed |= over


def test_mix(spark):
    rows = [(i, numbered(1 + i * 7 % 90), "abcdefg"[i * i % 7]) for i in range(700)]
    rows += [(1000 + i, numbered(40), None) for i in range(50)] + [(2000, numbered(9), "tiny"), (2001, "", "void"), (2002, None, "void")]
    rows += [(None, "one two three", "a"), (5, rows[5][1], rows[5][2])]
    d = docs(spark, rows)
    got = mixing.mix(d).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = water(sizes)
    assert len(got) == len(rows) and sum(want.values()) == pytest.approx(sum(sizes.values()))
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source] and r.size == len((r.text or "").split())
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.02 * t, 3), (s, taken[s], t)
    again = {(r.doc_id, r.copies) for r in mixing.mix(d.repartition(7)).collect()}
    assert again == {(r.doc_id, r.copies) for r in got}
    copies = mixing.mixed_documents(d)
    assert copies.columns == [*d.columns, "copy"] and copies.count() == sum(r.copies for r in got)
    # Rates are exponential in the size within a source, up to the cap.
    one = sorted({(r.size, r.rate) for r in got if r.source == "b" and r.size and r.rate < 3})
    slopes = {round(__import__("math").log(rate) / size, 6) for size, rate in one}
    assert len(slopes) == 1


def test_mix_empty(spark):
    assert mixing.mix(docs(spark, [(1, "a b", "a")]).limit(0)).count() == 0
    r = mixing.mix(docs(spark, [(1, "a b", "a")]).withColumns({"size": F.lit("x"), "lam": F.lit(1), "moves": F.lit(2)})).head()
    assert (r.size, r.taken, r.lam) == (2, 2, 1)


def brute_overlaps(rows, items, span=decontam.SPAN):
    out = set()
    for i, t in rows:
        x = words(t)
        for item, u in items:
            y = words(u)
            if len(y) < decontam.MIN_WORDS:
                continue
            n = min(span, len(y))
            for a in range(len(x) - n + 1):
                for b in range(len(y) - n + 1):
                    same = [x[a + j] == y[b + j] for j in range(n)]
                    seeds = decontam.MASKS if n == span else ("1" * n,)
                    if sum(same) >= decontam.IDENTITY * n and any(all(s for s, m in zip(same, mask) if m == "1") for mask in seeds):
                        out.add((i, item))
    return out


def test_decontam(spark):
    item = [f"q{i}" for i in range(30)]
    edited = item[:]
    edited[2], edited[10], edited[18] = "x", "y", "z"
    rows = [(1, numbered(50) + " " + " ".join(item) + " " + numbered(20, 500)), (2, numbered(80)), (3, " ".join(edited)),
            (4, " ".join(item[:12])), (5, "a b c d e f"), (6, "B C D, e F; g"), (7, " ".join(x if i % 3 else "n" for i, x in enumerate(item)))] + AWKWARD
    items = [(100, " ".join(item)), (101, "b c d e f"), (102, "too short"), (103, None), (104, ""), (None, " ".join(item))]
    d = docs(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.overlaps(d, bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == brute_overlaps(rows, [x for x in items if x[0] is not None])
    hit = got.where("doc_id = 1").head()
    assert (hit.first_word, hit.last_word, hit.identity) == (50, 79, 1.0)
    left = decontam.decontaminate(d.withColumn("row", F.lit(1)), bench)
    assert left.columns == [*d.columns, "row"] and left.count() == len(rows) - got.select("doc_id").distinct().count()
    assert decontam.overlaps(d, bench.limit(0)).count() == 0 and decontam.overlaps(d.limit(0), bench).count() == 0


def test_decontam_finds_every_window_that_counts(spark):
    # Every place of as many changed words as a window may have, for whole windows and for short items.
    items, rows = [], []
    for n in range(decontam.MIN_WORDS, decontam.SPAN + 1):
        item = [f"i{n}w{j}" for j in range(n)]
        items.append((n, " ".join(item)))
        differ = int(n * (1 - decontam.IDENTITY) + 1e-9)
        for k in (differ, differ + 1):
            for at in itertools.combinations(range(n), k):
                rows.append((len(rows), " ".join("new" if j in at else w for j, w in enumerate(item)), n, k <= differ))
    d = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(d, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(i, n) for i, _, n, counts in rows if counts}


def test_decontam_blocks(spark, monkeypatch):
    rows = [(i, numbered(40, i * 40)) for i in range(20)]
    items = spark.createDataFrame([(i, numbered(20, i * 40 + 5)) for i in range(0, 20, 2)], "item_id long, text string")
    monkeypatch.setattr(decontam, "BLOCK_WINDOWS", 30)
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(docs(spark, rows), items).collect()}
    assert got == {(i, i) for i in range(0, 20, 2)}


def test_decontam_broadcasts_a_block_at_a_time(spark, monkeypatch):
    rows, items = [(i, numbered(40, 100 * i)) for i in range(6)], [(i, numbered(16, 100 * i + 10)) for i in range(0, 6, 2)]
    items = spark.createDataFrame(items, "item_id long, text string")
    want = {tuple(r) for r in decontam.overlaps(docs(spark, rows), items).collect()}
    monkeypatch.setattr(decontam, "BLOCK_WINDOWS", 6)
    found = decontam.overlaps(docs(spark, rows), items)
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in found.collect()} == want and len(want) == 3


def test_query_digest(spark, tmp_path):
    from fieldstat.llm.queries import op10_line_dedup
    rows = [(i, "a line that is long enough\nx") for i in range(3)] + [(9, None)]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in op10_line_dedup(spark, str(tmp_path)).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {0: (2, 1, digest("x")), 1: (2, 1, digest("x")), 2: (2, 0, digest(rows[2][1])), 9: (1, 0, digest(""))}
