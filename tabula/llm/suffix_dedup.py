"""Exact substring deduplication with a depth-limited radix sort of suffixes.

A byte is removed if it lies in a string of ``length`` bytes that also starts
in a document with a smaller id. Suffixes are ordered only through ``length``
bytes, by most-significant-digit passes; suffixes that end up in one group are
exactly the repeated windows, and the smallest document of a group keeps its
copy.

A window is reached through an anchor: of the ``length - LEFT`` byte grams in
it, the one with the least hash (the leftmost of equals). Equal windows have
their anchor at the same place, so (1) anchors whose gram occurs in one
document only are dropped with all their windows, by a lookup between blocks
of documents and buckets of grams; (2) the others send their surroundings, once
per block, to the gram's bucket, where the radix passes run; (3) the answers
return and the bytes are cut. About 1 in 16 positions is an anchor, so step 1
sends 6 bytes for 16 bytes of text; texts are shuffled once, and the exchange
is used by all three steps.

A gram that many different surroundings share (a phrase of a third of all
documents) is divided: step 1 counts the surroundings of every gram, and the
more there are, the more parts its windows get by their place about the anchor,
up to one part per place. All windows of a part hold the same core of bytes
around the gram, and go to the bucket of the core's hash; with one part per
place that is the hash of the whole window, of which a block sends one entry.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.llm import blocks as B
from tabula.llm import ragged

LEFT = 30
CHUNK = 1 << 17
HOT = 1 << 12  # surroundings of a gram, of all blocks, that go to a bucket undivided
SLICE = 1 << 15
BLOCK_BYTES = 1 << 22
_PLACE = np.uint64((1 << 20) - 1)
_NEVER = np.uint64(2**64 - 1)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(place, first window, last window, gram hash, hash of the ends of the
    surroundings) of all anchors of a block; windows do not cross documents. A
    chunk border may give an anchor twice, with its windows divided."""
    n, k = len(data), length - LEFT
    edge = np.zeros(n + 1, np.int8)  # windows that fit their document start and end
    last = offsets[1:] - length
    fits = last >= offsets[:-1]
    edge[offsets[:-1][fits]] += 1
    edge[last[fits] + 1] -= 1
    inside = np.cumsum(edge[:n], dtype=np.int8).view(bool)
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    for a in range(0, n, CHUNK):
        part = data[a:a + CHUNK + length - 1]
        if len(part) < length:
            break
        h = ragged.gram_hash(part, k)
        v = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while width * 2 <= LEFT + 1:
            v = np.minimum(v[:-width], v[width:])
            width *= 2
        if rest := LEFT + 1 - width:
            v = np.minimum(v[:-rest], v[rest:])
        starts = np.flatnonzero(inside[a:a + len(v)])
        if not len(starts):
            continue
        place = (v[starts] & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        end = np.append(first[1:], len(starts)) - 1
        ends = h[starts[first]] + h[starts[end] + LEFT] * np.uint64(3)
        gram = ragged.mix(h[place[first]])  # the least hashes of many are small; mixed, they spread over the buckets
        for x, y in zip(out, (place[first] + a, starts[first] + a, starts[end] + a, gram, ends), strict=True):
            x.append(y)
    empty = (np.int64, np.int64, np.int64, np.uint64, np.uint64)
    return tuple(np.concatenate(x) if x else np.empty(0, t) for x, t in zip(out, empty, strict=True))


class Block:
    """Anchors of a block of documents, and what it sends."""

    def __init__(self, table: pa.Table, length: int):
        # rows come in any order; chunks, and so the entries at their borders, must not follow it
        self.table = table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.length = length
        self.data, self.offsets = ragged.text_bytes(table.column("text"))
        self.ids = B.doc_ids(table)
        self.place, self.first, self.last, gram, ends = anchors(self.data, self.offsets, length)
        doc = np.searchsorted(self.offsets, self.place, side="right") - 1
        order = np.lexsort((ends, gram))
        ordered = gram[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(order) else np.empty(0, bool)
        self.keys = ordered[new]  # sorted, distinct
        starts = np.flatnonzero(new)
        ids = self.ids[doc[order]]
        self.several = np.minimum.reduceat(ids, starts) != np.maximum.reduceat(ids, starts) if len(starts) else np.empty(0, bool)
        differ = new.copy()
        differ[1:] |= ends[order][1:] != ends[order][:-1]
        self.surroundings = np.add.reduceat(differ, starts, dtype=np.int64) if len(starts) else np.empty(0, np.int64)
        self.key_of = np.empty(len(order), np.int64)
        self.key_of[order] = np.cumsum(new) - 1

    def entries(self, levels: np.ndarray) -> None:
        """Distinct surroundings of the anchors whose gram is shared (a level
        above 0): the bytes of their windows (zero elsewhere) and the range of
        window places. Windows of an anchor whose gram has level v are divided
        by their places into 2 ** (v - 1) parts."""
        level = levels[self.key_of] if len(self.key_of) else np.empty(0, np.int64)
        used = np.flatnonzero(level)
        width = 32 >> (level[used] - 1)  # places in a part
        place, low, high = self.place[used], self.place[used] - self.last[used], self.place[used] - self.first[used]
        first_part = low // width
        parts = high // width - first_part + 1
        which = np.repeat(np.arange(len(used)), parts)
        part = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts) + first_part[which]
        width, place = width[which], place[which]
        low, high = np.maximum(low[which], part * width), np.minimum(high[which], part * width + width - 1)
        key = self.keys[self.key_of[used[which]]]
        for a in range(0, len(which), SLICE):  # the core: what all windows of a part hold
            divided = a + np.flatnonzero(width[a:a + SLICE] < 32)
            if len(divided):
                begin = place[divided] - part[divided] * width[divided]
                size = self.length - np.minimum(width[divided] - 1, LEFT - part[divided] * width[divided])
                column = np.arange(self.length)
                core = np.where(column < size[:, None], self.data[np.minimum(begin[:, None] + column, len(self.data) - 1)], 0).astype(np.uint8)
                key[divided] = ragged.mix(_digest(core) + part[divided].astype(np.uint64))
        self.place, self.first, self.last = place, place - high, place - low
        self.doc = np.searchsorted(self.offsets, place, side="right") - 1
        padded = np.concatenate([np.zeros(LEFT, np.uint8), self.data, np.zeros(self.length, np.uint8)])
        view = np.lib.stride_tricks.sliding_window_view(padded, LEFT + self.length)
        column = np.arange(LEFT + self.length)
        rows = np.empty((len(place), LEFT + self.length + 2), np.uint8)
        for a in range(0, len(place), SLICE):
            s = slice(a, a + SLICE)
            rows[s, :-2] = np.where((column >= LEFT - high[s, None]) & (column < LEFT - low[s, None] + self.length), view[place[s]], 0)
        rows[:, -2], rows[:, -1] = low, high
        digest = _digest(rows)
        order = np.lexsort((digest, key))  # by content, whatever the order of the rows
        key, digest = key[order], digest[order]
        new = np.ones(len(order), dtype=bool)
        alike = 1 + np.flatnonzero((key[1:] == key[:-1]) & (digest[1:] == digest[:-1]))
        for a in range(0, len(alike), SLICE):
            i = alike[a:a + SLICE]
            new[i] = (rows[order[i]] != rows[order[i - 1]]).any(axis=1)
        self.rows, self.entry_key = rows[order[new]], key[new]
        self.entry_of = np.empty(len(order), np.int64)
        self.entry_of[order] = np.cumsum(new) - 1
        self.least = np.full(len(self.rows), B.LAST)
        np.minimum.at(self.least, self.entry_of, self.ids[self.doc])


def _digest(rows: np.ndarray) -> np.ndarray:
    pad = -rows.shape[1] % 8
    words = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, pad)))).view("<u8")
    h = np.zeros(len(rows), np.uint64)
    for j in range(words.shape[1]):
        h = ragged.mix(h + words[:, j] * np.uint64(2 * j + 0x9E3779B97F4A7C15))
    return h


def _masks(rows: np.ndarray, least: np.ndarray, length: int) -> np.ndarray:
    """For every entry of a bucket, a bit for each window place at which a
    document smaller than the entry's smallest has the same window. Entries are
    taken in slices that hold all with a hash of their gram."""
    gram = np.concatenate([_digest(rows[a:a + SLICE, LEFT:length]) for a in range(0, len(rows), SLICE)]) if len(rows) else np.empty(0, np.uint64)
    order = np.argsort(gram, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], gram[order][1:] != gram[order][:-1]])) if len(rows) else np.empty(0, np.int64)
    out = np.zeros(len(rows), np.uint32)
    a = 0
    while a < len(rows):
        k = int(np.searchsorted(starts, a + SLICE, side="right")) - 1
        b = int(starts[k]) if starts[k] > a else int(starts[k + 1]) if k + 1 < len(starts) else len(rows)
        if a + SLICE >= len(rows):
            b = len(rows)
        some = order[a:b]
        out[some] = _slice_masks(rows[some], least[some], length)
        a = b
    return out


def _slice_masks(rows: np.ndarray, least: np.ndarray, length: int) -> np.ndarray:
    low, high = rows[:, -2], rows[:, -1]
    gram = ragged.radix_groups(rows[:, LEFT:length])  # the gram at the anchor: length - LEFT bytes
    kind, number = ragged.renumber(ragged.radix_groups(rows, gram))  # entries with equal surroundings
    best = np.full(len(kind), B.LAST)
    np.minimum.at(best, number, least)
    _, gram_of = ragged.renumber(gram[kind])
    mixed = np.flatnonzero(np.bincount(gram_of)[gram_of] > 1)  # grams with different surroundings
    out = np.zeros(len(rows), np.uint32)
    for place in range(LEFT + 1):
        smallest = best.copy()
        here = mixed[(low[kind[mixed]] <= place) & (place <= high[kind[mixed]])]
        if len(here):
            windows = rows[kind[here], LEFT - place:LEFT - place + length]
            first, group = ragged.renumber(ragged.radix_groups(windows, gram_of[here]))
            least_in = np.full(len(first), B.LAST)
            np.minimum.at(least_in, group, best[here])
            smallest[here] = least_in[group]
        hit = (smallest[number] < least) & (low <= place) & (place <= high)
        out |= hit.astype(np.uint32) << np.uint32(place)
    return out


def repeated(docs: DataFrame, *, length: int = 50, keep: list[str] | None = None, characters: bool = False, hot: int = HOT) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default doc_id) plus n_bytes,
    n_removed, spans (start and end, in bytes, of every maximal removed run)
    and kept (the remaining bytes), one row per row of ``docs`` (doc_id, text).

    Texts are UTF-8 bytes, null is empty; matches do not cross documents and
    are judged on the input. Rows with equal ids do not remove from each other;
    a null id counts as larger than all others. With ``characters``, a
    character of several bytes goes as soon as one of them does, so that what
    is kept is text again. ``hot`` is the number of surroundings above which a
    gram is divided; results do not depend on it. Columns of ``docs`` with the added names are
    replaced."""
    if not LEFT + 8 <= length <= 255 - LEFT:
        raise ValueError(f"length must be {LEFT + 8} to {255 - LEFT}")
    added = ["n_bytes", "n_removed", "spans", "kept"]
    keep = [c for c in (["doc_id"] if keep is None else keep) if c not in (*added, "block")]
    buckets = B.count_for(docs, BLOCK_BYTES)  # and as many blocks
    rows = B.blocked(docs, ["doc_id", *keep], count=buckets)

    def send_grams(table: pa.Table) -> pa.Table:
        block = Block(table, length)
        seen = (block.several.astype("<u2") << 15) | np.minimum(block.surroundings, 32767).astype("<u2")
        return B.send(B.block_of(table), block.keys, buckets, True, lambda cuts: B.binary(seen, cuts))

    def answer_grams(table: pa.Table) -> pa.Array:
        keys, counts = B.numbers(table.column("keys"), "<u4")
        seen, _ = B.numbers(table.column("extra"), "<u2")
        _, number, count = np.unique(keys, return_inverse=True, return_counts=True)
        shared = (count > 1) | (np.bincount(number, weights=seen >> 15) > 0)
        total = np.bincount(number, weights=seen & 32767)
        divided = np.minimum(np.ceil(np.log2(np.maximum(total / hot, 1))), 5)
        level = np.where(shared, 1 + divided, 0).astype(np.uint8)
        press = zstandard.ZstdCompressor(level=1)
        return pa.array([press.compress(x.tobytes()) for x in np.split(level[number], np.cumsum(counts)[:-1])], pa.binary())

    def gram_levels(answered: pa.Table) -> np.ndarray:
        press = zstandard.ZstdDecompressor()
        return np.frombuffer(b"".join(press.decompress(x) for x in answered.sort_by("bucket").column("answer").to_pylist()), np.uint8).astype(np.int64)

    def send_entries(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["bucket", "block", "keys", "extra"]
        if not left.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int32(), pa.int32(), pa.binary(), pa.binary())], names=names)
        block = Block(left, length)
        block.entries(gram_levels(right))
        used, cuts = B.bucket_cuts(block.entry_key, buckets)
        press = zstandard.ZstdCompressor(level=1)
        packed = [press.compress(np.ascontiguousarray(block.rows[a:b]).tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.table([pa.array(used, pa.int32()), pa.array(np.full(len(used), B.block_of(left)), pa.int32()), pa.array(packed, pa.binary()), B.binary(block.least, cuts)], names=names)

    def answer_entries(table: pa.Table) -> pa.Table:
        least, counts = B.numbers(table.column("extra"), "<i8")
        press = zstandard.ZstdDecompressor()
        entries = np.frombuffer(b"".join(press.decompress(x) for x in table.column("keys").to_pylist()), np.uint8).reshape(len(least), -1)
        found = _masks(entries, least, length)
        return pa.table([table.column("bucket"), table.column("block"), B.binary(found.astype("<u4"), np.concatenate([[0], np.cumsum(counts)]))], names=["bucket", "block", "answer"])

    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table([*(left.column(c) for c in keep), *(pa.array([], t) for t in (pa.int64(), pa.int64(), pa.list_(span), pa.binary()))], names=[*keep, *added])
        block = Block(left, length)
        which = right.column("step").to_numpy() if right.num_rows else np.empty(0, np.int32)
        block.entries(gram_levels(right.filter(pa.array(which == 0))))
        masks = B.answers(right.filter(pa.array(which == 1)), "<u4")
        n = len(block.data)
        flags = np.zeros(n + 1, np.int32)  # removed windows, by their start
        entry = block.entry_of
        later = block.ids[block.doc] > block.least[entry]  # a smaller document of this block has the same
        np.add.at(flags, block.first[later], 1)
        np.add.at(flags, block.last[later] + 1, -1)
        starts = np.cumsum(flags[:n], dtype=np.int32) > 0
        rest = np.flatnonzero(~later)
        mask = masks[entry[rest]]
        for place in range(LEFT + 1):
            starts[block.place[rest[(mask >> np.uint32(place)) & 1 == 1]] - place] = True
        edge = np.zeros(n + length + 1, np.int32)  # a removed window covers length bytes
        hit = np.flatnonzero(starts)
        edge[hit] += 1
        edge[hit + length] -= 1
        gone = np.cumsum(edge[:n], dtype=np.int32) > 0
        del flags, starts, edge
        if characters and n:
            number = np.cumsum((block.data & 0xC0) != 0x80, dtype=np.int32)
            split = np.zeros(int(number[-1]) + 1, dtype=bool)  # characters of which a byte goes
            split[number[gone]] = True
            gone = split[number]
            del number
        # a window starts in its document and fits it, so no run crosses a border
        edge = np.zeros(n + 1, dtype=bool)
        edge[block.offsets] = True
        begins = np.flatnonzero(gone & np.concatenate([[True], ~gone[:-1]] if n else [[]]).astype(bool) | gone & edge[:n])
        ends = np.flatnonzero(gone & (np.append(~gone[1:], True) if n else np.empty(0, bool)) | gone & edge[1:]) + 1
        owner = np.searchsorted(block.offsets, begins, side="right") - 1
        removed = np.searchsorted(np.flatnonzero(gone), block.offsets)
        spans: list = [[] for _ in range(left.num_rows)]
        for d, a, b in zip(owner.tolist(), (begins - block.offsets[owner]).tolist(), (ends - block.offsets[owner]).tolist(), strict=True):
            spans[d].append({"start": a, "end": b})
        kept = B.binary(block.data[~gone], block.offsets - removed)
        return pa.table([*(block.table.column(c) for c in keep), pa.array(np.diff(block.offsets)), pa.array(np.diff(removed)), pa.array(spans, pa.list_(span)), kept], names=[*keep, *added])

    shared = B.lookup(rows, B.lean(send_grams), B.lean(answer_grams))
    sent = rows.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(B.lean(send_entries), B.SENT)
    found = sent.groupBy("bucket").applyInArrow(B.lean(answer_entries), B.ANSWER)
    both = shared.withColumn("step", F.lit(0)).unionByName(found.withColumn("step", F.lit(1)))
    span_type = T.StructType().add("start", T.LongType()).add("end", T.LongType())
    schema = T.StructType([docs.schema[c] for c in keep]).add("n_bytes", T.LongType()).add("n_removed", T.LongType())
    schema = schema.add("spans", T.ArrayType(span_type)).add("kept", T.BinaryType())
    return rows.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(B.lean(cut), schema)


def remove_repeats(docs: DataFrame, *, length: int = 50) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` (a character that is
    cut in part goes whole). A text without a cut stays as it is, null too, and
    so do all other columns, whatever their names."""
    columns = docs.columns
    named = {c: f"_in{i}" for i, c in enumerate(columns) if c not in ("doc_id", "text")}
    rows = docs.select("doc_id", "text", *[F.col(c).alias(n) for c, n in named.items()], F.col("text").isNull().alias("_null"))
    found = repeated(rows, length=length, keep=["doc_id", *named.values(), "_null"], characters=True)
    found = found.withColumn("text", F.when(~F.col("_null"), F.col("kept").cast("string")))
    return found.select(*[F.col(named.get(c, c)).alias(c) for c in columns])
