"""Operators 11 to 13 against brute force, on random and awkward rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from fieldstat.llm import conversations as conv
from fieldstat.llm import covering, spelling
from tests.llm.helpers import AWKWARD, UPPER, docs, numbered

SPACES = " \t\n\v\f\r"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
WORD = re.compile("[^\x20\x09-\x0d]+")


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_sorted_scan_finds_all_pairs():
    rng = random.Random(1)
    for _ in range(300):
        words = sorted({"".join(rng.choice("abé"[:rng.choice([2, 3])]) for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(0, 40))})
        want = [(i, j) for i, j in itertools.combinations(range(len(words)), 2) if one_edit(words[i], words[j])]
        assert sorted(spelling.near_in_sorted(words)) == want


def brute_words(rows):
    n = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += len(run) >= 6
    n = {w: c for w, c in n.items() if c >= 5}
    out, form = {}, {}
    for w in n:
        near = [x for x in n if one_edit(w, x)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
        out[w] = len(near)
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], out[w], n.get(form[w]))
    return out


def spelled():
    rng = random.Random(2)
    base = ["variant", "spelling", "éclairée", "running", "abcdef", "grouping"]
    rows = []
    for i in range(160):
        words = []
        for _ in range(60):
            w = rng.choice(base)
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("aeé") + w[k:], w[:k] + rng.choice("aeÉ") + w[k + 1:]])
            words.append(rng.choice([w, w.upper(), w]))
        rows.append((i % 150, " ".join(words) + ". 7x7"))
    # Counts of 1, 5, 25, 125 make a chain of forms; ties of equal counts go to the first in order.
    rows += [(900, " ".join(["chainaa"] * 5 + ["chainab"] * 25 + ["chainbb"] * 125 + ["chaincb"] * 125))]
    return rows + [(None, "spelling spelling")] + AWKWARD + [(902, "z" * 100_000 + " " + ("y" * 50_000 + " ") * 5 + ("y" * 49_999 + " ") * 30)]


def test_spelling_variants(spark):
    rows = spelled()
    want = brute_words(rows)
    assert sum(v[0] is not None for v in want.values()) > 20 and any(v[0] != v[1] and v[0] for v in want.values())
    for limit in (128, 3):
        found = spelling.spelling_variants(docs(spark, rows), limit=limit).collect()
        assert len(found) == len(want)
        assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found} == want


def test_spelling_clashing_and_empty(spark):
    d = docs(spark, [(1, "colour " * 9), (2, "color " * 60 + "colors " * 6)]).withColumns(
        {c: F.lit("x") for c in ("id", "run", "word", "n", "near", "size", "lo", "hi", "h", "rows")})
    found = {r.word: (r.form, r.root, r.n_near) for r in spelling.spelling_variants(d).collect()}
    assert found == {"colour": (None, "colour", 0), "colors": (None, "colors", 0)}
    assert spelling.spelling_variants(d.limit(0)).count() == 0


def brute_print(text):
    w = WORD.findall((text or "").translate(UPPER))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, ids, radius):
    label = list(range(len(prints)))

    def end(x):
        while label[x] != x:
            x = label[x]
        return x
    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            label[max(end(i), end(j))] = min(end(i), end(j))
    least = defaultdict(list)
    for i, x in enumerate(ids):
        if x is not None:
            least[end(i)].append(x)
    return [min(least[end(i)], default=None) for i in range(len(prints))]


def test_masks_cover_every_place():
    for radius, bits in ((1, 16), (2, 20), (3, 24)):
        ms = covering.masks(radius, bits)
        assert len(ms) == 2 ** (radius + 1) - 1
        assert all(any(not m & e for m in ms) for e in covering.ball(radius, bits))
    assert all(any(not m & e for m in covering.masks()) for e in covering.ball(3))


def test_simhash_components(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(40):
        base = [rng.choice(words) for _ in range(rng.randint(60, 120))]
        for j in range(rng.choice([1, 2, 8])):
            for _ in range(j and 1):
                base[rng.randrange(len(base))] = rng.choice(words)
            rows.append((100 + len(rows), rng.choice([" ", "\n", "\t ", "  "]).join(base).replace("w1", "W1")))
    rows += AWKWARD + [(rows[0][0], rows[5][1]), (None, rows[3][1]), (7000, rows[3][1]), (7001, "  é"), (7002, "a b"), (7003, "A\tb ")]
    prints = [brute_print(t) for _, t in rows]
    least = brute_components(prints, [i for i, _ in rows], 3)
    want = Counter((i, format(p, "016x"), c) for (i, _), p, c in zip(rows, prints, least))
    assert len(set(least)) < len(set(prints))
    for bucket in (covering.BUCKET, 2):
        got = covering.near_duplicates(docs(spark, rows), bucket=bucket).collect()
        assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


def test_links_of_random_fingerprints(spark):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        for _ in range(rng.choice([0, 1, 6])):
            for _ in range(rng.choice([1, 2, 3, 4])):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    prints = sorted(prints)
    want = brute_components(prints, prints, 3)
    fps = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    for bucket in (16, 3, 1):
        edges = [(r.u % (1 << 64), r.v % (1 << 64)) for r in covering.links(fps, bucket=bucket).collect()]
        assert all(u != v for u, v in edges)
        label = {p: p for p in prints}
        for _ in prints:
            for u, v in edges:
                label[u] = label[v] = min(label[u], label[v])
        assert [label[p] for p in prints] == want


def test_simhash_clashing_and_empty(spark):
    d = docs(spark, [(1, "x y z"), (2, "x  Y z")]).withColumns({c: F.lit("x") for c in ("id", "fp", "line", "n", "component_id")})
    assert {(r.doc_id, r.component_id) for r in covering.near_duplicates(d).collect()} == {(1, 1), (2, 1)}
    assert covering.near_duplicates(d.limit(0)).count() == 0


NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
NAME = {2: "user", 3: "assistant"}


def brute_repair(rows):
    """All edits of one conversation's (turn, role, text) in order; per state the least (cost, audit)."""
    seen, faults = set(), []
    for _, role, text in rows:
        said = text.strip(SPACES)
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))

    def more(best, state, found):
        if state not in best or found[:2] < best[state][:2]:
            best[state] = found

    def put_in(best):
        for _ in range(2):
            for s, (cost, audit, lines) in list(best.items()):
                more(best, NEXT[s], (cost + 2, audit + "I", (*lines, NAME[NEXT[s]] + ":")))
        return best
    best = put_in({0: (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for s, (cost, audit, lines) in best.items():
            more(after, s, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = fault == "truncated"
            kept = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role[:1], s))
            if kept:
                more(after, kept, (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
            more(after, NEXT[s], (cost + 2 + extra, audit + "R", (*lines, f"{NAME[NEXT[s]]}:{text}")))
        best = put_in(after)
    cost, audit, lines = min((best[s] for s in (0, 3) if s in best), key=lambda x: x[:2])
    turns = [t for t, _, _ in rows if t is not None]
    first = [r[:1] for _, r, _ in rows]
    n = Counter(faults)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["blank"], n["duplicate"], n["truncated"],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_conversations(rows):
    hurt = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        hurt[c] += [(turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return {c: brute_repair(sorted(found, key=order)) for c, found in hurt.items()}


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repaired(d, **more):
    return {r[0]: tuple(r[c] for c in FIELDS) for r in conv.repair(conv.damage(d), d, **more).collect()}


def talk():
    rng = random.Random(6)
    roles = ["system", "user", "assistant", None, "", "tool", "user", "assistant", "Über", "s"]
    rows = [(rng.choice([None, *range(1, 9), *[9] * 8]), rng.choice([None, *range(60)]), rng.choice(roles),
             rng.choice([None, "", " \n\t", " ", "é.", "so.", f"{rng.randint(0, 30)}!", f"no {rng.randint(0, 9)}", "why?\r\n"]))
            for _ in range(900)]
    rows += [(20, t, "user", "a.") for t in range(40)] + [(21, 3, "assistant", "Equal.")] * 30 + [(22, None, None, None)]
    return rows + [(23, t, "ua"[t % 2] + "x", f"fine {t}.") for t in range(30)] + [(24, -(2 ** 62), "user", "a."), (24, 2 ** 62, "user", "b.")]


def test_conversation_repair(spark):
    rows = talk()
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = brute_conversations(rows)
    want[24] = (None if want[24][0] >= 2 ** 63 else want[24][0], *want[24][1:])
    assert repaired(d) == want
    assert repaired(d, chunk=3, fan=2, buckets=5) == want


def test_blocks_agree_with_single_rows():
    t, rng = conv.tables(), random.Random(7)
    for _ in range(200):
        symbols = "".join(rng.choice("012345678") for _ in range(rng.randint(0, 30)))
        v, end = conv.summary(symbols)
        for right in range(len(t.vectors)):
            g, least = t.vectors[right], 0
            for symbol in reversed(symbols):
                g = conv.before(g, int(symbol))
                least, g = least + min(g), tuple(x - min(g) for x in g)
            assert t.vectors[v[right]] == g
            for state in range(4):
                edits, _, last, cost = conv.trace(symbols, right, state)
                assert last == end[right][state] and cost == least + g[state] - t.vectors[right][last]
                assert len(edits) == len(symbols)


def test_repaired_rows_are_right(spark):
    d = spark.createDataFrame(talk(), "conv_id long, turn long, role string, text string")
    rows = conv.numbered(d)
    lines = conv.repaired(rows, conv.edits(rows, chunk=7), chunk=7).orderBy("key", "pos", "sub").collect()
    roles = defaultdict(str)
    for r in lines:
        roles[r.key] += r.role[:1]
    assert roles and all(re.fullmatch("(s?(ua)+)?", x) for x in roles.values())


def test_conversations_clashing_and_empty(spark):
    d = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "assistant", "b.")], "conv_id long, turn long, role string, text string")
    extra = d.withColumns({c: F.lit("x") for c in ("key", "n", "pos", "rows", "fault", "audit", "_time", "hit", "symbol")})
    assert repaired(extra) == repaired(d) == brute_conversations([tuple(r) for r in d.collect()])
    assert conv.repair(conv.damage(extra.limit(0)), extra.limit(0)).count() == 0
    long = spark.createDataFrame([(1, 0, "user", numbered(30_000) + "."), (1, 1, "assistant", "x" * 3_000_000 + "!")], d.schema)
    assert repaired(long) == brute_conversations([tuple(r) for r in long.collect()])
