"""Byte-level helpers on Arrow text columns.

Texts are read as UTF-8 bytes straight from the Arrow buffers: one contiguous
byte array plus document offsets, with no Python string per document or word.
Everything works on slices of bounded size, so memory does not follow the
partition. A null text has no bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACE = np.zeros(256, dtype=bool)  # \x20 and \x09-\x0D
SPACE[[9, 10, 11, 12, 13, 32]] = True
NOT_SPACE = ~SPACE

#: Digits, ASCII letters and every byte of a non-ASCII character.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_rng = np.random.Generator(np.random.PCG64(20260101))
_TABLE = _rng.integers(0, 2**64, size=64 * 256, dtype=np.uint64)
_GRAM = _rng.integers(0, 2**64, size=256, dtype=np.uint64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (splitmix64's constants); a bijection."""
    h = h ^ (h >> np.uint64(30))
    h *= _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return h


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column, nulls as empty texts;
    document i is bytes[offsets[i]:offsets[i + 1]]."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no or several chunks
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, count=n + 1, offset=8 * column.offset)
    size = int(offsets[-1] - offsets[0])
    data = column.buffers()[2]
    if size == 0 or data is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8, count=size, offset=int(offsets[0])), offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents holding about ``limit`` bytes each (a longer
    document is a range of its own; at most 4096 documents a range)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n, lo + 4096)
        yield lo, hi
        lo = hi


def runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, doc) of the maximal runs of bytes in the class ``inside``
    (a table of 256 booleans); no run crosses a document."""
    m = inside[data]
    if not len(m):
        e = np.empty(0, np.int64)
        return e, e, e
    first = np.zeros(len(m) + 1, dtype=bool)
    first[offsets] = True
    s = m.copy()
    s[1:] &= ~m[:-1] | first[1:-1]
    e = m
    e[:-1] &= ~m[1:] | first[1:-1]
    starts = np.flatnonzero(s)
    return starts, np.flatnonzero(e) + 1, np.searchsorted(offsets, starts, side="right") - 1


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every byte run (tabulation hashing by byte and place)."""
    out = np.empty(len(starts), np.uint64)
    size = np.cumsum(ends - starts)
    lo = 0
    while lo < len(starts):
        hi = max(int(np.searchsorted(size, (size[lo - 1] if lo else 0) + (1 << 18), side="right")), lo + 1)
        n = ends[lo:hi] - starts[lo:hi]
        first = np.cumsum(n) - n
        inner = np.arange(int(n.sum())) - np.repeat(first, n)
        v = _TABLE[((inner & 63) << 8) | data[np.repeat(starts[lo:hi], n) + inner]]
        if int(n.max()) > 64:
            v *= ((inner >> 6) * 2 + 1).astype(np.uint64)
        out[lo:hi] = np.add.reduceat(v, first)
        lo = hi
    out ^= (ends - starts).astype(np.uint64) * _M1
    return mix(out)


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, doc) of every word of A-Z-lower-cased texts, in order."""
    hashes, docs = [], []
    for lo, hi in slices(offsets):
        part = LOWER[data[offsets[lo]:offsets[hi]]]
        s, e, d = runs(part, offsets[lo:hi + 1] - offsets[lo], inside)
        hashes.append(hash_runs(part, s, e))
        docs.append(d + lo)
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(docs)


def gram_hash(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of data[i:i + k] for every i it fits (k <= len(data))."""
    h, power, width = _GRAM[data], np.uint64(0x9E3779B97F4A7C15), 1
    out, done = None, 0
    while True:
        if k & width:
            size = len(data) - done - width + 1
            out = h[:size].copy() if out is None else out[:size] * power + h[done:done + size]
            done += width
        if width * 2 > k:
            return mix(out)
        h = h[:-width] * power + h[width:]
        power = np.uint64(int(power) ** 2 % 2**64)
        width *= 2


def radix_groups(rows: np.ndarray, group: np.ndarray | None = None) -> np.ndarray:
    """Group numbers of equal byte rows (n, width), by most-significant-digit
    passes over eight bytes each: a pass orders the rows that are still alike
    by their next digit, and rows that are alone drop out. ``group`` gives a
    known partition to refine. Numbers have gaps."""
    n, width = rows.shape
    group = np.zeros(n, np.int64) if group is None else group.astype(np.int64)
    if width % 8:
        rows = np.pad(rows, ((0, 0), (0, 8 - width % 8)))
    digits = np.ascontiguousarray(rows).view(">u8")
    active, top = np.arange(n), int(group.max(initial=0)) + 1
    for j in range(digits.shape[1]):
        if len(active) < 2:
            break
        digit, held = digits[active, j].astype(np.uint64), group[active]
        order = np.lexsort((digit, held))
        active, digit, held = active[order], digit[order], held[order]
        new = np.ones(len(active), dtype=bool)
        new[1:] = (held[1:] != held[:-1]) | (digit[1:] != digit[:-1])
        number = np.cumsum(new) - 1
        group[active] = top + number
        top += int(number[-1]) + 1
        active = active[np.bincount(number)[number] > 1]
    return group


def renumber(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first member, number from 0) of every group number."""
    _, first, number = np.unique(group, return_index=True, return_inverse=True)
    return first, number
