"""Operator 13: repair of conversation structure with Four-Russians block tables.

A conversation is right if the initials of its roles are ``(s?(ua)+)?``. Every row is
kept (0), given the role user or assistant (2) or deleted (3; blank and duplicate
rows must be), and empty rows of either role can be put in anywhere (2); a
truncated row that stays costs 1 more. The cheapest edits, and of those the
ASCII-least string of their initials, are found over four states (nothing yet;
after a system, a user, an assistant row).

The costs to the end from each of the four states, less their least one, can only
be one of a few vectors. For each vector and each block of ``BLOCK`` row symbols the
vector before the block, what it adds, and the state at its end for each state at
its start are computed once; a conversation is then processed from its end by one
lookup a block. Tracing goes forward: each block is expanded backward from its
right vector to those between its rows, and the least letter that can still reach
the least cost is taken, which is exact for ties.

A conversation is cut into chunks of ``CHUNK`` rows. Chunks are summed up by the same
tables for every possible right vector, ``FAN`` neighbours at a time and again in
levels, then right vectors and left states are dealt back down, so that one
conversation may hold any share of all rows. Only the digest of a repaired
conversation has to see its lines in order: they pass one task as a stream.

Defined results: null roles and texts are one space; a null conversation id is a
conversation of its own. Rows are taken by turn, nulls first, then role, then text.
Equal rows of a turn are one row with a count: all but the first are duplicates. A
role is as good as its first character; an empty one is no initial. An empty
table gives no rows; other columns are not looked at. Gaps beyond a long are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldstat.llm.tables import SPACES, salted_join, stored
from fieldstat.operators.ranking import running_total

BLOCK = 4
CHUNK = 4096             # rows of a conversation that are traced at once
FAN = 256                # neighbours summed up at a level
INITIALS = "sua"         # any other initial is x
DELETED, PADDING = 8, 9  # symbols: initial (s, u, a, x), 4 more if truncated; these two
SYMBOLS = 10
NEXT = (2, 2, 3, 2)      # the state after a row of the only role (user or assistant) that may follow
ROLE = {2: "user", 3: "assistant"}
KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}   # state and initial to state
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
LEGAL = {"su", "ua", "au"}


def _with_inserts(g: list[int]) -> tuple[int, ...]:
    """Costs to the end if rows may also be put in here."""
    u = min(g[2], g[3] + INSERT)
    return min(g[0], u + INSERT), min(g[1], u + INSERT), u, min(g[3], u + INSERT)


def _choices(g: tuple[int, ...], symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost to the end, state after) of what can be done with a row before costs ``g``."""
    found = [("D", DELETE + g[state], state)]
    if symbol < DELETED:
        more = TRUNCATED if symbol >= 4 else 0
        if (state, symbol % 4) in KEPT:
            after = KEPT[state, symbol % 4]
            found.append(("K", more + g[after], after))
        found.append(("R", REROLE + more + g[NEXT[state]], NEXT[state]))
    return found


def before(g: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs to the end before a row, from those after it."""
    if symbol == PADDING:
        return g
    return _with_inserts([min(c for _, c, _ in _choices(g, symbol, s)) for s in range(4)])


def least_edits(g: tuple[int, ...], symbol: int, state: int) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits up to and with a row, and the state after it."""
    if symbol == PADDING:
        return "", state
    h, edits = before(g, symbol), ""
    while True:
        row = {e: after for e, cost, after in _choices(g, symbol, state) if cost == h[state]}
        if "D" in row:
            return edits + "D", state
        if INSERT + h[NEXT[state]] == h[state]:
            edits, state = edits + "I", NEXT[state]
            continue
        edit = min(row)
        return edits + edit, row[edit]


END = (0, 2 * INSERT, INSERT, 0)                # costs to the end behind the last row
LAST = ("", "II", "I", "")                     # rows put in there


@dataclass
class Tables:
    """Normalised cost vectors; transitions by row symbol and by block of symbols."""

    vectors: list[tuple[int, ...]]
    to: list[list[int]]                        # by vector and symbol: the vector before the row
    edits: list[list[list[tuple[str, int]]]]   # by vector, symbol and state
    block_to: np.ndarray                       # by vector and block
    block_adds: np.ndarray
    block_end: np.ndarray                      # by vector, block and state


@lru_cache(maxsize=1)
def tables() -> Tables:
    """All vectors that can occur, and the tables of all blocks."""
    vectors, to, adds = [END], [], []
    known = {END: 0}
    for g in vectors:
        to.append([])
        adds.append([])
        for symbol in range(SYMBOLS):
            h = before(g, symbol)
            least = min(h)
            h = tuple(x - least for x in h)
            if h not in known:
                known[h] = len(vectors)
                vectors.append(h)
            to[-1].append(known[h])
            adds[-1].append(least)
    edits = [[[least_edits(g, symbol, s) for s in range(4)] for symbol in range(SYMBOLS)] for g in vectors]
    n = len(vectors)
    one_to, one_add = np.array(to), np.array(adds)
    one_end = np.array([[[e[1] for e in row] for row in by] for by in edits])
    block_to, block_adds = np.arange(n)[:, None], np.zeros((n, 1), int)
    block_end = np.broadcast_to(np.arange(4), (n, 1, 4))
    for _ in range(BLOCK):
        # One more symbol in front: it meets the vector before the block.
        start = one_end[block_to].transpose(0, 2, 1, 3)
        block_end = np.take_along_axis(np.broadcast_to(block_end[:, None], start.shape), start, axis=3).reshape(n, -1, 4)
        block_adds = (block_adds[:, None] + one_add[block_to].transpose(0, 2, 1)).reshape(n, -1)
        block_to = one_to[block_to].transpose(0, 2, 1).reshape(n, -1)
    return Tables(vectors, to, edits, block_to, block_adds, block_end)


def blocks(symbols: str) -> list[int]:
    """The blocks of a string of symbols, filled up at its end."""
    symbols += str(PADDING) * (-len(symbols) % BLOCK)
    return [int(symbols[i:i + BLOCK]) for i in range(0, len(symbols), BLOCK)]


def summary(symbols: str) -> tuple[np.ndarray, np.ndarray]:
    """For every vector behind the rows: the vector before them; for every state before them too: the state behind."""
    t = tables()
    v = np.arange(len(t.vectors))
    end = np.broadcast_to(np.arange(4), (len(v), 4))
    for b in reversed(blocks(symbols)):
        end = np.take_along_axis(end, t.block_end[v, b], axis=1)
        v = t.block_to[v, b]
    return v, end


def trace(symbols: str, right: int, state: int) -> tuple[list[str], list[int], int, int]:
    """Each row's edits and the state before it, the state behind the rows and the edits' cost.

    ``right`` is the vector behind the rows, ``state`` the state before them.
    """
    t = tables()
    behind, v, added = [], right, 0
    for b in reversed(blocks(symbols)):
        behind.append(v)
        added += int(t.block_adds[v, b])
        v = int(t.block_to[v, b])
    cost = added + t.vectors[v][state]
    found, states = [], []
    for i, v in zip(range(0, len(symbols), BLOCK), reversed(behind)):
        block, after = [int(x) for x in symbols[i:i + BLOCK]], []
        for symbol in reversed(block):
            after.append(v)
            v = t.to[v][symbol]
        for symbol, v in zip(block, reversed(after)):
            states.append(state)
            edits, state = t.edits[v][symbol][state]
            found.append(edits)
    return found, states, state, cost - t.vectors[right][state]


def compose(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The summary of two stretches of rows as one."""
    v, end = right
    return left[0][v], np.take_along_axis(end, left[1][v], axis=1)


def _key(conv: Column) -> Column:
    """A string that is never null and tells all conversation ids apart."""
    return F.when(conv.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), conv.cast("string")))


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """``conversations`` with faults dealt by the CRC-32 of conversation and turn; nulls count as one space."""
    space = F.lit(" ")
    where = F.concat_ws(":", F.coalesce(F.col(conv_col).cast("string"), space), F.coalesce(F.col(turn_col).cast("string"), space))
    hit = F.crc32(where.cast("binary")) % 20
    role, text = F.coalesce(F.col(role_col), space), F.coalesce(F.col(text_col), space)
    times = F.explode(F.when(hit == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    rows = conversations.where(hit != 0).select(
        conv_col, turn_col, F.when(hit == 4, F.lit("user")).otherwise(role).alias(role_col),
        F.when(hit == 1, F.lit("")).when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias(text_col),
        times.alias("_time"))
    return rows.drop("_time")


def numbered(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Distinct rows of each conversation in order: key, turn, role, text, n (how often), pos (from 0), rows
    (of the conversation), fault (blank, duplicate, truncated or null: of the first such row), initial, symbol."""
    space = F.lit(" ")
    rows = (conversations.select(_key(F.col(conv_col)).alias("key"), F.col(turn_col).cast("long").alias("turn"),
                                 F.coalesce(F.col(role_col), space).alias("role"), F.coalesce(F.col(text_col), space).alias("text"))
            .groupBy("key", "turn", "role", "text").agg(F.count("*").alias("n")))
    rows = stored(rows.withColumns({"t1": F.xxhash64(F.lit(1), "role", "text"), "t2": F.xxhash64(F.lit(2), "text", "role"),
                                    "known": F.col("turn").isNotNull(), "at": F.coalesce("turn", F.lit(0))}), "conv-rows")
    firsts = stored(rows.groupBy("key", "t1", "t2").agg(F.min(F.struct("known", "at")).alias("first"), F.count("*").alias("times")),
                    "conv-firsts")
    rows = salted_join(rows, firsts, ["key", "t1", "t2"], "times", ["known", "at"])
    said = F.btrim(F.col("text"), F.lit(SPACES))
    fault = (F.when(said == "", "blank")
             .when((F.col("known") != F.col("first.known")) | (F.col("at") != F.col("first.at")), "duplicate")
             .when(~F.right(said, F.lit(1)).isin(*".!?"), "truncated"))
    initial = F.left("role", F.lit(1))
    rows = rows.select("key", "turn", "role", "text", "n", "known", "at", fault.alias("fault"),
                       F.when(initial.isin(*INITIALS), initial).otherwise("x").alias("initial"))
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), DELETED).otherwise(
        F.expr(f"locate(initial, '{INITIALS}x')") - 1 + F.when(F.col("fault") == "truncated", 4).otherwise(0))
    order = ["known", "at", "role"]
    ranked = running_total(rows, [*order, "text"], ["key"], out="pos", total="rows", buckets=buckets,
                           deal_by=[*order, F.left("text", F.lit(64))])
    return stored(ranked.select("key", "turn", "role", "text", "n", "fault", "initial", symbol.cast("string").alias("symbol"),
                                (F.col("pos") - 1).alias("pos"), "rows"), "conv-numbered")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [summary("".join(r["symbol"] for r in rows)) for rows in batch.column("lines").to_pylist()]
        yield _level(batch.column("key"), batch.column("chunk"), found)


def _level(key: pa.Array, at: pa.Array, found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([key, at, pa.array([v.tolist() for v, _ in found], pa.list_(pa.int32())),
                                       pa.array([e.ravel().tolist() for _, e in found], pa.list_(pa.int32()))],
                                      ["key", "at", "to", "end"])


LEVEL = "key string, at long, to array<int>, end array<int>"


def _kids(kids: list[dict]) -> list[tuple[int, tuple[np.ndarray, np.ndarray]]]:
    return [(k["at"], (np.array(k["to"]), np.array(k["end"]).reshape(-1, 4))) for k in kids]


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for kids in batch.column("kids").to_pylist():
            whole = None
            for _, part in reversed(_kids(kids)):
                whole = part if whole is None else compose(part, whole)
            found.append(whole)
        yield _level(batch.column("key"), batch.column("up"), found)


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple[str, int, int, int]] = []
        for key, kids, right, state in zip(*(batch.column(c).to_pylist() for c in ("key", "kids", "right", "state"))):
            parts, rights = _kids(kids), []
            for _, (to, _end) in reversed(parts):
                rights.append(right)
                right = int(to[right])
            for (at, (_to, end)), v in zip(parts, reversed(rights)):
                out.append((key, at, v, state))
                state = int(end[v, state])
        cols = list(zip(*out)) if out else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                          pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32())],
                                         ["key", "up", "right", "state"])


def placed(chunks: DataFrame, fan: int = FAN) -> DataFrame:
    """(key, chunk, right, state): the vector behind each chunk and the state before it."""
    level = chunks.select("key", "chunk", "lines").mapInArrow(_summaries, LEVEL)
    levels = []
    while True:
        groups = stored(level.groupBy("key", F.floor(F.col("at") / fan).alias("up"))
                        .agg(F.array_sort(F.collect_list(F.struct("at", "to", "end"))).alias("kids")), "conv-level")
        levels.append(groups)
        if groups.where(F.col("up") > 0).isEmpty():
            break
        level = groups.mapInArrow(_summed, LEVEL)
    start = levels[-1].select("key", "up", F.lit(0).alias("right"), F.lit(0).alias("state"))
    for groups in reversed(levels):
        start = groups.hint("merge").join(start, ["key", "up"]).select("key", "kids", "right", "state").mapInArrow(
            _dealt, "key string, up long, right int, state int")
    return start.withColumnRenamed("up", "chunk")


STEP = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string())]))
TRACED = ("key string, chunk long, audit string, cost long, illegal long, first string, last string, "
          "steps array<array<struct<edit: string, role: string>>>")


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for lines, right, state, last in zip(*(batch.column(c).to_pylist() for c in ("lines", "right", "state", "last"))):
            edits, states, state, cost = trace("".join(r["symbol"] for r in lines), right, state)
            if last and LAST[state]:
                edits.append(LAST[state])
                states.append(state)
                cost += INSERT * len(LAST[state])
            copies = [r["n"] - 1 for r in lines] + [0] * (len(edits) - len(lines))
            steps = []
            for letters, s in zip(edits, states):
                steps.append(row := [])
                for e in letters:
                    if e in "IR":
                        s = NEXT[s]
                    row.append({"edit": e, "role": ROLE[s] if e in "IR" else None})
            initials = [r["initial"] for r in lines]
            illegal = sum(x + y not in LEGAL for x, y in zip(initials, initials[1:]))
            out.append(("".join(e + "D" * c for e, c in zip(edits, copies)), cost + DELETE * sum(copies), illegal + sum(copies),
                        initials[0], initials[-1], steps))
        cols = list(zip(*out)) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("chunk"), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
             pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string()),
             pa.array(cols[5], pa.list_(STEP))],
            ["key", "chunk", "audit", "cost", "illegal", "first", "last", "steps"])


def edits(rows: DataFrame, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """The cheapest edits of ``numbered`` rows, one row a chunk: key, chunk, audit (the edits' initials), cost, illegal
    (adjacent initials that may not follow each other, inside the chunk), first and last initial, steps (of each row)."""
    lines = F.array_sort(F.collect_list(F.struct("pos", "symbol", "initial", "n")))
    chunks = (rows.groupBy("key", F.floor(F.col("pos") / chunk).alias("chunk"))
              .agg(lines.alias("lines"), F.max("rows").alias("rows"))
              .withColumn("last", (F.col("chunk") + 1) * chunk >= F.col("rows")))
    chunks = stored(chunks, "conv-chunks")
    several = F.col("rows") > chunk
    alone = chunks.where(~several).withColumns({"right": F.lit(0), "state": F.lit(0)})
    parts = chunks.where(several)
    parts = parts.hint("merge").join(placed(parts, fan), ["key", "chunk"])
    both = alone.unionByName(parts).select("key", "chunk", "lines", "last", "right", "state")
    return stored(both.mapInArrow(_traced, TRACED), "conv-traced")


def repaired(rows: DataFrame, traced: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The rows after the edits: key, pos and sub (their order), edit (K, R or I), turn (null if put in), role, text."""
    steps = traced.select("key", "chunk", F.posexplode("steps").alias("i", "row"))
    steps = steps.select("key", (F.col("chunk") * chunk + F.col("i")).alias("pos"), F.posexplode("row").alias("sub", "step"))
    steps = steps.where(F.col("step.edit") != "D")
    own = rows.select("key", "pos", "turn", F.col("role").alias("_role"), "text")
    put_in = F.col("step.edit") == "I"
    return steps.hint("merge").join(own, ["key", "pos"], "left").select(
        "key", "pos", "sub", F.col("step.edit").alias("edit"), F.when(~put_in, F.col("turn")).alias("turn"),
        F.coalesce("step.role", "_role").alias("role"), F.when(put_in, F.lit("")).otherwise(F.col("text")).alias("text"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(key: str, digest: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest])], ["key", "sha256"])

    now, state = None, hashlib.sha256()
    for batch in batches:
        for key, line in zip(batch.column("key").to_pylist(), batch.column("line").to_pylist()):
            if key != now:
                if now is not None:
                    yield out(now, state.hexdigest())
                now, state = key, hashlib.sha256(line.encode())
            else:
                state.update(b"\n" + line.encode())
    if now is not None:
        yield out(now, state.hexdigest())


def digests(lines: DataFrame) -> DataFrame:
    """(key, sha256) of the ``role:text`` lines of ``repaired`` rows, which pass one task in order as a stream."""
    ordered = lines.select("key", "pos", "sub", F.concat_ws(":", "role", "text").alias("line"))
    return (ordered.repartition("key").sortWithinPartitions("key", "pos", "sub").select("key", "line")
            .mapInArrow(_digests, "key string, sha256 string"))


def repair(conversations: DataFrame, ids: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text", chunk: int = CHUNK, fan: int = FAN, buckets: int | None = None) -> DataFrame:
    """One row for each conversation of ``ids`` (or of ``conversations``): its faults, the cheapest edits and what they give."""
    ids = (conversations if ids is None else ids).select(conv_col).distinct().withColumn("key", _key(F.col(conv_col)))
    rows = numbered(conversations, conv_col, turn_col, role_col, text_col, buckets)
    traced = edits(rows, chunk, fan)

    def having(fault: str, of: Column) -> Column:
        return F.sum(F.when(F.col("fault") == fault, of).otherwise(0))

    wide = F.col("turn").cast("decimal(20,0)")
    gaps = (F.max(wide) - F.min(wide) + 1 - F.count_distinct("turn")).try_cast("long")
    blank, duplicate = having("blank", F.col("n")), having("duplicate", F.col("n"))
    copies = F.sum(F.when(F.col("fault").isin("blank", "duplicate"), 0).otherwise(F.col("n") - 1))
    faults = rows.groupBy("key").agg(
        F.when(F.count("turn") == 0, F.lit(0)).otherwise(gaps).alias("gaps"), blank.alias("blank"),
        (duplicate + copies).alias("duplicate"),
        having("truncated", F.lit(1)).alias("truncated"))
    ahead = F.lag("last").over(Window.partitionBy("key").orderBy("chunk"))
    joins = traced.select("key", "chunk", "audit", "cost", "illegal", F.concat(ahead, F.col("first")).alias("joint"))
    least = joins.groupBy("key").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"]), "").alias("audit"),
        F.sum("cost").alias("cost"),
        F.sum(F.col("illegal") + F.when(F.col("joint").isNotNull() & ~F.col("joint").isin(*LEGAL), 1).otherwise(0)).alias("illegal"))
    found = (ids.hint("merge").join(faults, "key", "left").hint("merge").join(least, "key", "left").hint("merge")
             .join(digests(repaired(rows, traced, chunk)), "key", "left"))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return found.select(conv_col, *[F.when(F.col("illegal").isNull(), F.lit(0)).otherwise(F.col(c)).cast("long").alias(c) for c in counts],
                        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", empty).alias("repaired_sha256"))
