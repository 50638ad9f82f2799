"""Words and shingles of Arrow string columns as numpy arrays, for use inside tasks.

A word is a run of ASCII digits, ASCII letters (lower-cased) and non-ASCII
bytes, as ``tables.word_line`` has it. Texts are taken in chunks of about
``CHUNK`` bytes, so that memory does not depend on the batch; a longer text is
one chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
U64 = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _letters() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for b in range(256):
        c = b + 32 if 0x41 <= b <= 0x5A else b
        if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80:
            table[b] = c
    return table


LETTERS = _letters()
_VALUE = mix64(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
ODD = mix64(np.arange(1, 65, dtype=U64) * U64(0xA0761D6478BD642F)) | U64(1)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n-1 of the base and of its inverse, modulo 2^64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, U64(base))
            p[0] = U64(1)
            _powers[name] = np.cumprod(p, dtype=U64)
    return _powers["up"], _powers["down"]


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets from 0) of consecutive rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, where, data = column.buffers()
    off = np.frombuffer(where, kind)[column.offset:column.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        to = min(to, n)
        yield at, to, raw[off[at]:off[to]], off[at:to + 1] - off[at]
        at = to


@dataclass
class Words:
    """Words of a chunk: the text each is in, its hash, its bytes [start, end)."""

    doc: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    per_doc: np.ndarray
    prefix: np.ndarray
    down: np.ndarray

    def part_hash(self, start: np.ndarray, end: np.ndarray, salt: int) -> np.ndarray:
        """Hash of the bytes [start, end) of the chunk, apart from that of whole words."""
        h = (self.prefix[end] - self.prefix[start]) * self.down[start]
        return mix64(h + (end - start).astype(U64) * ODD[0] + ODD[salt])


def words(raw: np.ndarray, off: np.ndarray) -> Words:
    """All words of a chunk's texts."""
    n, docs = len(raw), len(off) - 1
    low = LETTERS[raw]
    inside = low > 0
    first = np.zeros(n + 1, bool)
    first[off] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | first[:n]))
    end = np.flatnonzero(inside & (~after | first[1:])) + 1
    up, down = powers(n + 1)
    prefix = np.zeros(n + 1, U64)
    np.cumsum(_VALUE[low] * up[:n], out=prefix[1:])
    doc = np.searchsorted(off, start, "right") - 1
    h = (prefix[end] - prefix[start]) * down[start]
    h = mix64(h + (end - start).astype(U64) * ODD[0])
    return Words(doc, h, start, end, np.bincount(doc, minlength=docs), prefix, down)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of ``k`` words; a text of fewer words has one shingle of them all."""
    n = len(w.hash)
    m = max(0, n - k + 1)
    h = np.zeros(m, U64)
    for j in range(k):
        h += w.hash[j:j + m] * ODD[j]
    whole = w.doc[:m] == w.doc[k - 1:k - 1 + m]
    doc, h = w.doc[:m][whole], mix64(h[whole])
    few = np.flatnonzero((w.per_doc > 0) & (w.per_doc < k))
    if len(few):
        begin = np.searchsorted(w.doc, few)
        pos = np.concatenate([np.arange(b, b + c) for b, c in zip(begin, w.per_doc[few])])
        seg = np.repeat(np.arange(len(few)), w.per_doc[few])
        part = w.hash[pos] * ODD[pos - begin[seg]]
        total = np.add.reduceat(part, np.searchsorted(seg, np.arange(len(few))))
        doc = np.concatenate([doc, few])
        h = np.concatenate([h, mix64(total + w.per_doc[few].astype(U64))])
    return doc, h


def counted(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, hash) in order of both, and how often each occurs."""
    if not len(h):
        return doc, h, np.zeros(0, np.int64)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return doc[at], h[at], np.diff(np.append(at, len(h)))
