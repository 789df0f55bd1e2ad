"""Language-model scoring with Brown's class-based bigrams.

Exchange clustering assigns words to classes so that the class bigrams of the
training texts are as likely as possible; a word is then scored as
P(class | class before) * P(word | class). Every word of the training texts has
a class of its own choice; only unseen words take one from the last bytes of
their spelling (``SLOTS`` hashed endings). All counts are over all training texts:

1. word counts, from one partial count per task and bucket of words;
2. seed: the ``TOP`` most frequent words each, and the others by their endings,
   are units; bigram counts of units, likewise (at most units^2 numbers);
3. exchange rounds of units: a Spark job sums each unit's neighbours by class,
   the driver (which holds units x classes numbers, bounded by the model) moves
   units while the likelihood grows;
4. the other words: a Spark table keeps each word's counts of the seed classes
   before and after it; tasks move words from their ending's class to their
   best one, given the words of all classes (classes x classes numbers), in
   hashed halves, as long as that raises the likelihood;
5. scoring: blocks of texts look up the class and the exact training count of
   each of their words (see ``tabula.llm.blocks``); the class bigrams are then
   counted over the words' own classes, and the texts scored by them.

While a word of step 4 picks its class, rarer neighbours count by the class of
their ending; the class bigrams of step 5 hold every word's own class.

P(word | class) is the word's share of its class, less the Good-Turing mass of
unseen words (the share of words seen once), which the class's unseen words
have together. The end of a text is a token with a class of its own, and
precedes the first word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.llm import blocks as B
from tabula.llm import ragged

TOP, SLOTS, ENDING_BYTES, CLASSES, ROUNDS = 4096, 1024, 3, 48, 9
WORD_ROUNDS = 4
_FEW = 64


@dataclass
class Model:
    top: np.ndarray  # sorted hashes of the frequent words; place = unit
    classes: np.ndarray  # class of each unit; the last unit is the end
    unseen: np.ndarray  # P(any unseen word | class)
    class_tokens: np.ndarray
    tokens: int  # N
    types: int  # V
    texts: int
    words: DataFrame  # bucket, block (-1), keys and extra (classes) of the words outside top
    buckets: int  # of ``words``
    train: DataFrame  # text

    @cached_property
    def transition(self) -> np.ndarray:
        """log10 P(class | class before), counted over the training texts."""
        docs = self.train.select(F.monotonically_increasing_id().alias("doc_id"), "text", F.lit(True).alias("train"))
        return self.log_transition(_class_bigrams(_classed(docs, self, "train", []), len(self.class_tokens)))

    def log_transition(self, table: np.ndarray) -> np.ndarray:
        share = (self.class_tokens + 1) / (self.class_tokens.sum() + len(table))
        return np.log10((table + share) / (table.sum(1, keepdims=True) + 1))

    def units(self, words: np.ndarray, slots: np.ndarray) -> np.ndarray:
        return _units(self.top, words, slots)


def _units(top: np.ndarray, words: np.ndarray, slots: np.ndarray) -> np.ndarray:
    if not len(top):
        return slots.astype(np.int64)
    at = np.minimum(np.searchsorted(top, words), len(top) - 1)
    return np.where(top[at] == words, at, len(top) + slots.astype(np.int64))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hash, slot of its ending, document) of all words in order."""
    out: list[list[np.ndarray]] = [[], [], []]
    for lo, hi in ragged.slices(offsets):
        part = ragged.LOWER[data[offsets[lo]:offsets[hi]]]
        s, e, d = ragged.runs(part, offsets[lo:hi + 1] - offsets[lo], ragged.NOT_SPACE)
        out[0].append(ragged.hash_runs(part, s, e))
        out[1].append((ragged.hash_runs(part, np.maximum(s, e - ENDING_BYTES), e) % np.uint64(SLOTS)).astype(np.int32))
        out[2].append(d + lo)
    return tuple(np.concatenate(x) if x else np.empty(0, t) for x, t in zip(out, (np.uint64, np.int32, np.int64), strict=True))


def _partial_counts(buckets: int) -> Callable:
    """In a task: distinct words with count and slot, one row per bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def merged() -> tuple:
            words, first, number = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True)
            return words, np.bincount(number, weights=np.concatenate([h[1] for h in held])).astype(np.int64), np.concatenate([h[2] for h in held])[first]

        def rows() -> pa.RecordBatch:
            words, count, slot = merged()
            used, cuts = B.bucket_cuts(words, buckets)
            return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), B.binary(words, cuts), B.binary(count.astype("<u4"), cuts), B.binary(slot.astype("<u2"), cuts)], names=["bucket", "words", "counts", "slots"])
        for b in batches:
            data, offsets = ragged.text_bytes(b.column("text"))
            for lo, hi in ragged.slices(offsets, 8 << 20):
                words, slots, _ = tokens(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                if len(words):
                    words, first, count = np.unique(words, return_index=True, return_counts=True)
                    held.append((words, count, slots[first]))
                if sum(len(h[0]) for h in held) > 2_000_000:
                    held = [merged()]
                    if len(held[0][0]) > 1_000_000:
                        yield rows()
                        held = []
        if held:
            yield rows()
    return run


_STATISTICS = "part int, sums binary, words binary, counts binary, slots binary"
_PARTS = 16


def _statistics_row(part: int, sums: np.ndarray, words: np.ndarray, counts: np.ndarray, slots: np.ndarray) -> pa.Table:
    """One row: types, singles and tokens by slot, and the TOP most frequent words."""
    best = np.lexsort((words, -counts))[:TOP]
    parts = [sums.astype("<i8"), words[best].astype("<u8"), counts[best].astype("<i8"), slots[best].astype("<i8")]
    return pa.table([pa.array([part], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in parts)], names=["part", "sums", "words", "counts", "slots"])


def _word_statistics(train: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(types, singles and tokens by slot; hashes, counts and slots of the top
    words), merged from buckets to _PARTS rows before they reach the driver."""
    def total(table: pa.Table) -> pa.Table:
        words, _ = B.numbers(table.column("words"), "<u8")
        counts, _ = B.numbers(table.column("counts"), "<u4")
        slots, _ = B.numbers(table.column("slots"), "<u2")
        words, first, number = np.unique(words, return_index=True, return_inverse=True)
        count, slot = np.bincount(number, weights=counts).astype(np.int64), slots[first].astype(np.int64)
        sums = np.stack([np.bincount(slot, weights=w, minlength=SLOTS) for w in (np.ones(len(slot)), count == 1, count)])
        return _statistics_row(table.column("bucket")[0].as_py() % _PARTS, sums, words, count, slot)

    def merge(table: pa.Table) -> pa.Table:
        sums = B.numbers(table.column("sums"), "<i8")[0].reshape(-1, 3, SLOTS).sum(0)
        words, counts, slots = (B.numbers(table.column(c), t)[0] for c, t in (("words", "<u8"), ("counts", "<i8"), ("slots", "<i8")))
        return _statistics_row(table.column("part")[0].as_py(), sums, words, counts, slots)
    partial = train.select("text").mapInArrow(_partial_counts(buckets), "bucket int, words binary, counts binary, slots binary")
    rows = partial.groupBy("bucket").applyInArrow(total, _STATISTICS).groupBy("part").applyInArrow(merge, _STATISTICS).collect()
    if not rows:
        none = np.empty(0, np.int64)
        return np.zeros((3, SLOTS), np.int64), np.empty(0, np.uint64), none, none
    sums = sum(np.frombuffer(r.sums, "<i8").reshape(3, SLOTS) for r in rows)
    words, counts, slots = (np.concatenate([np.frombuffer(r[c], t) for r in rows]) for c, t in (("words", "<u8"), ("counts", "<i8"), ("slots", "<i8")))
    best = np.lexsort((words, -counts))[:TOP]
    return sums, words[best], counts[best], slots[best]


def _sequence(units: np.ndarray, doc: np.ndarray, n: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(unit before, unit) of all tokens of n documents, ends included, by
    document; the document of a token follows from the counts."""
    size = np.bincount(doc, minlength=n) + 1
    seq = np.full(int(size.sum()), end, np.int64)
    last = np.cumsum(size) - 1
    word = np.ones(len(seq), dtype=bool)
    word[last] = False
    seq[word] = units
    before = np.empty_like(seq)
    before[1:] = seq[:-1]
    before[last - size + 1] = end
    return before, seq


def _bigrams(train: DataFrame, top: np.ndarray, buckets: int) -> DataFrame:
    """Bigram counts of units, by first unit (side 0) and by second (side 1)."""
    n_units = len(top) + SLOTS + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            codes, number = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return codes, np.bincount(number, weights=np.concatenate([h[1] for h in held])).astype(np.int64)
        for b in batches:
            data, offsets = ragged.text_bytes(b.column("text"))
            for lo, hi in ragged.slices(offsets, 8 << 20):
                words, slots, doc = tokens(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                before, unit = _sequence(_units(top, words, slots), doc, hi - lo, n_units - 1)
                held.append(np.unique(before * n_units + unit, return_counts=True))
                if sum(len(h[0]) for h in held) > 4_000_000:
                    held = [merged()]
        if held:
            codes, count = merged()
            for side in (0, 1):
                bucket = (codes // n_units if side == 0 else codes % n_units) % buckets
                order = np.argsort(bucket, kind="stable")
                used, starts = np.unique(bucket[order], return_index=True)
                cuts = np.append(starts, len(order))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), side), pa.int32()), pa.array(used, pa.int32()), B.binary(codes[order].astype("<u4"), cuts), B.binary(count[order].astype("<i8"), cuts)], names=["side", "bucket", "codes", "counts"])

    def total(table: pa.Table) -> pa.Table:
        codes, _ = B.numbers(table.column("codes"), "<u4")
        counts, _ = B.numbers(table.column("counts"), "<i8")
        codes, number = np.unique(codes, return_inverse=True)
        counts = np.bincount(number, weights=counts).astype(np.int64)
        return pa.table([table.column("side").slice(0, 1), pa.array([codes.astype("<u4").tobytes()], pa.binary()), pa.array([counts.astype("<i8").tobytes()], pa.binary())], names=["side", "codes", "counts"])
    rows = train.select("text").mapInArrow(partial, "side int, bucket int, codes binary, counts binary")
    return rows.groupBy("side", "bucket").applyInArrow(total, "side int, codes binary, counts binary").checkpoint()


def _neighbours(bigrams: DataFrame, classes: np.ndarray, n_classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(right, left, own): each unit's counts of the classes after and before
    it, and of itself after itself. units x classes numbers."""
    n_units = len(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for side, codes, counts in zip(*(b.column(c).to_pylist() for c in ("side", "codes", "counts")), strict=True):
                codes, counts = np.frombuffer(codes, "<u4").astype(np.int64), np.frombuffer(counts, "<i8")
                first, second = codes // n_units, codes % n_units
                mine, other = (first, second) if side == 0 else (second, first)
                units, number = np.unique(mine, return_inverse=True)
                table = np.bincount(number * n_classes + classes[other], weights=counts, minlength=len(units) * n_classes).reshape(len(units), n_classes)
                own = np.bincount(number, weights=counts * (mine == other), minlength=len(units))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(units), side), pa.int32()), pa.array(units), pa.array(own.astype(np.int64)), pa.array([r.astype("<i8").tobytes() for r in table], pa.binary())], names=["side", "unit", "own", "counts"])
    sides = np.zeros((2, n_units, n_classes))
    own = np.zeros(n_units)
    for r in bigrams.mapInArrow(run, "side int, unit bigint, own bigint, counts binary").collect():
        sides[r.side, r.unit] = np.frombuffer(r.counts, "<i8")
        own[r.unit] = r.own
    return sides[0], sides[1], own


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def _class_table(right: np.ndarray, classes: np.ndarray, n_classes: int) -> np.ndarray:
    table = np.zeros((n_classes, n_classes))
    np.add.at(table, classes, right)
    return table


def likelihood(table: np.ndarray) -> float:
    """The part of the log-likelihood that depends on the classes."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(1)).sum() - _xlogx(table.sum(0)).sum())


def exchange(right: np.ndarray, left: np.ndarray, own: np.ndarray, classes: np.ndarray, units: np.ndarray, fixed: int) -> np.ndarray:
    """Move each of ``units`` to the class with the best likelihood, given the
    neighbours' classes. Class ``fixed`` (the end) takes no part."""
    classes = classes.copy()
    n = right.shape[1]
    table = _class_table(right, classes, n)
    diagonal = np.arange(n)
    for w in units.tolist():
        a = classes[w]
        r, l, s = right[w].copy(), left[w].copy(), own[w]
        if a == fixed or not r.any():
            continue
        r[a] = max(r[a] - s, 0)
        l[a] = max(l[a] - s, 0)
        table[a] = np.maximum(table[a] - r, 0)
        table[:, a] = np.maximum(table[:, a] - l, 0)
        table[a, a] = max(table[a, a] - s, 0)
        base = _xlogx(table)
        rows = _xlogx(table + r) - base
        cols = _xlogx(table + l[:, None]) - base
        both = _xlogx(table[diagonal, diagonal] + r + l + s) - base[diagonal, diagonal]
        gain = rows.sum(1) + cols.sum(0) - rows[diagonal, diagonal] - cols[diagonal, diagonal] + both
        out, into = table.sum(1), table.sum(0)
        gain -= _xlogx(out + r.sum() + s) - _xlogx(out) + _xlogx(into + l.sum() + s) - _xlogx(into)
        gain[fixed] = -np.inf
        b = int(gain.argmax())
        if gain[b] <= gain[a] + 1e-9:
            b = a
        classes[w] = b
        table[b] += r
        table[:, b] += l
        table[b, b] += s
    return classes


_CONTEXTS = "bucket int, words binary, slots binary, sizes binary, codes binary, counts binary"


_KINDS = ("<u8", "<u2", "<u2", "<u2", "<u4")


def _context_rows(used: np.ndarray, cuts: np.ndarray, words: np.ndarray, slots: np.ndarray, sizes: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> list[pa.Array]:
    entry = np.concatenate([[0], np.cumsum(sizes)])[cuts]
    return [pa.array(used, pa.int32()), B.binary(words.astype("<u8"), cuts), B.binary(slots.astype("<u2"), cuts), B.binary(sizes.astype("<u2"), cuts),
            B.binary(codes.astype("<u2"), entry), B.binary(counts.astype("<u4"), entry)]


def _summed(words: np.ndarray, slots: np.ndarray, codes: np.ndarray, counts: np.ndarray, n_codes: int) -> tuple[np.ndarray, ...]:
    """(sorted distinct words, their slots and numbers of entries, codes,
    counts) of entries."""
    words, first, number = np.unique(words, return_index=True, return_inverse=True)
    entry, place = np.unique(number * n_codes + codes, return_inverse=True)
    counts = np.bincount(place, weights=counts).astype(np.int64)
    return words, slots[first], np.bincount(entry // n_codes, minlength=len(words)), entry % n_codes, counts


def _contexts(train: DataFrame, top: np.ndarray, classes: np.ndarray, total: int, buckets: int) -> DataFrame:
    """Rows of _CONTEXTS, one per bucket: of each word outside ``top`` the counts
    of the seed classes after it (codes from 0) and before it (from ``total``)."""
    end = len(classes) - 1
    names = ["bucket", "words", "slots", "sizes", "codes", "counts"]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(_context_rows(*B.bucket_cuts(held[0][0], buckets), *held[0]), names=names)

        def merge() -> None:
            held[:] = [_summed(*(np.concatenate([np.repeat(h[i], h[2]) for h in held]) for i in (0, 1)), *(np.concatenate([h[i] for h in held]) for i in (3, 4)), 2 * total)]
        for b in batches:
            data, offsets = ragged.text_bytes(b.column("text"))
            for lo, hi in ragged.slices(offsets, 8 << 20):
                words, slots, doc = tokens(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                units = _units(top, words, slots)
                before, unit = _sequence(units, doc, hi - lo, end)
                after = np.append(unit[1:], end)[unit != end]
                rare = units >= len(top)
                if rare.any():
                    words, slots, n = words[rare], slots[rare], int(rare.sum())
                    codes = np.concatenate([classes[after[rare]], total + classes[before[unit != end][rare]]])
                    held.append(_summed(np.concatenate([words, words]), np.concatenate([slots, slots]), codes, np.ones(2 * n), 2 * total))
                if sum(len(h[3]) for h in held) > 4_000_000:
                    merge()
                    if len(held[0][3]) > 2_000_000:
                        yield rows()
                        held = []
        if held:
            merge()
            yield rows()

    def summed(table: pa.Table) -> pa.Table:
        words, slots, sizes, codes, counts = (B.numbers(table.column(c), t)[0] for c, t in zip(names[1:], _KINDS, strict=True))
        rows = _summed(np.repeat(words, sizes), np.repeat(slots, sizes), codes.astype(np.int64), counts, 2 * total)
        return pa.table(_context_rows(np.array([table.column("bucket")[0].as_py()]), np.array([0, len(rows[0])]), *rows), names=names)
    return train.select("text").mapInArrow(partial, _CONTEXTS).groupBy("bucket").applyInArrow(summed, _CONTEXTS).checkpoint()


def _best(sizes: np.ndarray, codes: np.ndarray, counts: np.ndarray, now: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The best class of each word, given its entries, its class and ``table``:
    by class, the counts of all words' neighbours by code. The last class is the
    end, which takes no word."""
    out, ends = now.copy(), np.cumsum(sizes)
    base, held = _xlogx(table), table.sum(1) / 2
    few = _xlogx(table.T + np.arange(_FEW)[:, None, None]) - base.T  # gain by count, code and class: no logarithms for small counts
    few_cost = _xlogx(held + np.arange(_FEW)[:, None]) - _xlogx(held)
    for lo in range(0, len(now), 1 << 14):
        hi = min(lo + (1 << 14), len(now))
        part = slice(int(ends[lo] - sizes[lo]), int(ends[hi - 1]))
        word = np.repeat(np.arange(hi - lo), sizes[lo:hi])
        code, count, at = codes[part], counts[part].astype(float), now[lo:hi]
        n = np.bincount(word, weights=count, minlength=hi - lo) / 2
        gain = few[np.minimum(counts[part], _FEW - 1), code]
        many = np.flatnonzero(count >= _FEW)
        gain[many] = _xlogx(table.T[code[many]] + count[many, None]) - base.T[code[many]]
        mine = at[word]  # its own counts are in the table of its class
        gain[np.arange(len(code)), mine] = base[mine, code] - _xlogx(np.maximum(table[mine, code] - count, 0))
        gain = np.add.reduceat(gain, ends[lo:hi] - sizes[lo:hi] - part.start, axis=0)
        cost = few_cost[np.minimum(n, _FEW - 1).astype(np.int64)]
        many = np.flatnonzero(n >= _FEW)
        cost[many] = _xlogx(held + n[many, None]) - _xlogx(held)
        rows = np.arange(hi - lo)
        cost[rows, at] = _xlogx(held[at]) - _xlogx(np.maximum(held[at] - n, 0))
        gain -= 2 * cost
        gain[:, -1] = -np.inf
        best = gain.argmax(1)
        out[lo:hi] = np.where(gain[rows, best] > gain[rows, at] + 1e-9, best, at)
    return out


def _value(table: np.ndarray) -> float:
    """The part of the log-likelihood of all neighbours that depends on the classes."""
    return float(_xlogx(table).sum() - 2 * _xlogx(table.sum(1) / 2).sum())


def _moved(batch: pa.RecordBatch, seed: np.ndarray, moves: list[tuple[int, np.ndarray]]) -> Iterator[tuple]:
    """(bucket, words, seed classes, classes, sizes, codes, counts) of rows of
    _CONTEXTS. ``seed``: class by slot. In each of ``moves`` the half of the
    words that it names has picked a class by a table."""
    for row in batch.to_pylist():
        words, slots, sizes, codes, counts = (np.frombuffer(row[c], t) for c, t in zip(("words", "slots", "sizes", "codes", "counts"), _KINDS, strict=True))
        sizes, codes = sizes.astype(np.int64), codes.astype(np.int64)
        classes = seed[slots]
        for half, table in moves:
            turn = (words & np.uint64(1)) == half
            of = np.repeat(turn, sizes)
            if turn.any():
                classes[turn] = _best(sizes[turn], codes[of], counts[of], classes[turn], table)
        yield row["bucket"], words, seed[slots], classes, sizes, codes, counts


def _sums(rows: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum of ``make`` (whole numbers) over all tasks, added up in _PARTS
    groups before it reaches the driver."""
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() % _PARTS
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([make(batches).astype("<i8").tobytes()], pa.binary())], names=["part", "sums"])

    def add(table: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(x, "<i8") for x in table.column("sums").to_pylist())
        return pa.table([table.column("part").slice(0, 1), pa.array([sums.tobytes()], pa.binary())], names=["part", "sums"])
    found = rows.mapInArrow(run, "part int, sums binary").groupBy("part").applyInArrow(add, "part int, sums binary").collect()
    return sum((np.frombuffer(r.sums, "<i8") for r in found), np.zeros(int(np.prod(shape)), np.int64)).reshape(shape)


def _word_classes(contexts: DataFrame, seed: np.ndarray, table: np.ndarray, rounds: int) -> tuple[DataFrame, np.ndarray]:
    """(bucket, block -1, keys, extra: classes of all words of ``contexts``;
    tokens, types and singles of these words by class). ``table``: class
    bigrams with every word in the class of its ending."""
    total = len(table)
    first = state = np.concatenate([table, table.T], axis=1)
    value, moves = _value(state), []
    for i in range(rounds):
        trial = [*moves, (i % 2, state)]

        def change(batches: Iterator[pa.RecordBatch], trial=trial) -> np.ndarray:
            out = np.zeros(state.size)
            for b in batches:
                for _, _, before, now, sizes, codes, counts in _moved(b, seed, trial):
                    for classes, sign in ((before, -1), (now, 1)):
                        out += np.bincount(np.repeat(classes, sizes) * 2 * total + codes, weights=sign * counts.astype(float), minlength=len(out))
            return out
        next_ = first + _sums(contexts, change, state.shape)
        reached = _value(next_)
        if reached > value:  # else words moved against each other
            moves, state, value = trial, next_, reached

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bucket, words, _, classes, sizes, _, counts in _moved(b, seed, moves):
                tokens_ = np.add.reduceat(counts.astype(np.int64), np.cumsum(sizes) - sizes) // 2
                sums = np.stack([np.bincount(classes, weights=w, minlength=total) for w in (tokens_, np.ones(len(words)), tokens_ == 1)])
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([-1], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (words, classes.astype("u1"), sums.astype("<i8")))],
                                                 names=["bucket", "block", "keys", "extra", "sums"])
    words = contexts.mapInArrow(final, B.SENT + ", sums binary").checkpoint()

    def stats(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        return sum((np.frombuffer(x, "<i8") for b in batches for x in b.column("sums").to_pylist()), np.zeros(3 * total, np.int64))
    return words.drop("sums"), _sums(words.select("sums"), stats, (3, total))


def fit(train: DataFrame, *, n_classes: int = CLASSES, rounds: int = ROUNDS, word_rounds: int = WORD_ROUNDS) -> Model:
    """Learn from every row of ``train`` (text). A null text is empty; an empty
    table gives a model that knows no word."""
    if n_classes > 254:
        raise ValueError("at most 254 classes")
    buckets = 2 * B.partitions(train.sparkSession)
    texts = train.count()
    sums, top, top_count, top_slot = _word_statistics(train, buckets)
    types, singles, count = (x.copy() for x in sums)
    order = np.argsort(top, kind="stable")
    top, top_count, top_slot = top[order], top_count[order], top_slot[order]
    all_types, all_tokens = int(types.sum()) + (texts > 0), int(count.sum()) + texts
    np.subtract.at(types, top_slot, 1)
    np.subtract.at(singles, top_slot, (top_count == 1).astype(np.int64))
    np.subtract.at(count, top_slot, top_count)
    unit_tokens = np.concatenate([top_count, count, [texts]])
    unit_types = np.concatenate([np.ones(len(top), np.int64), types, [1]])
    unit_singles = np.concatenate([(top_count == 1).astype(np.int64), singles, [0]])
    n_units, end, total = len(unit_tokens), n_classes, n_classes + 1
    classes = np.empty(n_units, np.int64)
    classes[np.argsort(-unit_tokens[:-1], kind="stable")] = np.arange(n_units - 1) % n_classes
    classes[-1] = end
    bigrams = _bigrams(train, top, B.partitions(train.sparkSession))
    right, left, own = _neighbours(bigrams, classes, total)
    value = likelihood(_class_table(right, classes, total))
    by_count = np.argsort(-unit_tokens, kind="stable")
    for i in range(rounds):
        moved = exchange(right, left, own, classes, by_count[i % 3::3], end)
        if (moved == classes).all():
            continue
        next_ = _neighbours(bigrams, moved, total)
        reached = likelihood(_class_table(next_[0], moved, total))
        if reached <= value:  # neighbours moved against each other
            continue
        classes, value, (right, left, own) = moved, reached, next_
    buckets = B.partitions(train.sparkSession)
    words, held = _word_classes(_contexts(train, top, classes, total, buckets), classes[len(top):-1], _class_table(right, classes, total), word_rounds)
    for row, of_top in zip(held, (top_count, np.ones(len(top)), top_count == 1), strict=True):
        row += np.bincount(classes[:len(top)], weights=of_top, minlength=total).astype(np.int64)
    class_tokens, class_types, class_singles = held
    class_tokens[end], class_types[end] = texts, 1
    unseen = np.where(class_tokens > 0, (class_singles + 1) / (class_tokens + class_types + 2), 1.0)
    unseen[end] = 0.0
    return Model(top, classes, unseen, class_tokens, all_tokens, all_types, texts, words, buckets, train.select("text"))


def _classed(docs: DataFrame, model: Model, train: str, keep: list[str]) -> DataFrame:
    """``keep``, _learned, n_tokens, n_known, base_score, _words (the part of
    the score that the words give) and _classes (one byte per token) of docs."""
    rows = B.blocked(docs, ["doc_id", *keep, train])
    names = ["_learned", "n_tokens", "n_known", "base_score", "_words", "_classes"]

    def read(table: pa.Table) -> tuple:
        data, offsets = ragged.text_bytes(table.column("text"))
        words, slots, doc = tokens(data, offsets)
        return words, slots, doc, *np.unique(words, return_inverse=True)

    def learned(table: pa.Table) -> np.ndarray:
        return table.column(train).fill_null(False).to_numpy(zero_copy_only=False).astype(bool)

    def send(table: pa.Table) -> pa.Table:
        _, _, doc, keys, number = read(table)
        counts = np.bincount(number, weights=learned(table)[doc], minlength=len(keys)).astype("<u4")
        return B.send(B.block_of(table), keys, model_buckets, False, lambda cuts: B.binary(counts, cuts))

    def answer(table: pa.Table) -> pa.Table:
        own = np.array(table.column("block").to_pylist()) < 0
        held, table = table.filter(pa.array(own)), table.filter(pa.array(~own))
        if not table.num_rows:
            return pa.table([table.column("bucket"), table.column("block"), pa.array([], pa.binary())], names=["bucket", "block", "answer"])
        known, kinds = B.numbers(held.column("keys"), "<u8")[0], B.numbers(held.column("extra"), "u1")[0].astype(np.int64)
        keys, sizes = B.numbers(table.column("keys"), "<u8")
        counts, _ = B.numbers(table.column("extra"), "<u4")
        keys, number = np.unique(keys, return_inverse=True)
        value = np.bincount(number, weights=counts).astype("<i8") << 8
        if len(known):  # the low byte: 1 + the word's own class
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            value |= np.where(known[at] == keys, kinds[at] + 1, 0)
        return pa.table([table.column("bucket"), table.column("block"), B.binary(value[number], np.concatenate([[0], np.cumsum(sizes)]))], names=["bucket", "block", "answer"])

    # what the tasks need; a model also holds tables, which stay with the driver
    model_buckets, top, classes, unseen, class_tokens = model.buckets, model.top, model.classes, model.unseen, model.class_tokens
    n_train, n_types, n_texts = model.tokens, model.types, model.texts

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        n = left.num_rows
        words, slots, doc, _, number = read(left)
        got = B.answers(right, "<i8")[number] if len(words) else np.empty(0, np.int64)
        end = len(classes) - 1
        _, unit = _sequence(_units(top, words, slots), doc, n, end)
        size = np.bincount(doc, minlength=n) + 1
        owner = np.repeat(np.arange(n), size)
        c, kind = np.full(len(unit), n_texts, np.int64), classes[unit]
        c[unit != end] = got >> 8
        kind[unit != end] = np.where(got & 255, (got & 255) - 1, kind[unit != end])
        word = np.where(c > 0, (1 - unseen[kind]) * c / np.maximum(class_tokens[kind], 1), unseen[kind])
        word[unit == end] = 1.0
        base = np.log10((c + 1) / (n_train + 1 * (n_types + 1)))
        sums = lambda x: np.bincount(owner, weights=x, minlength=n)
        return pa.table([*(left.column(x) for x in keep), pa.array(learned(left)), pa.array(size.astype(np.int64)), pa.array(sums(c > 0).astype(np.int64)), pa.array(sums(base)),
                         pa.array(sums(np.log10(np.maximum(word, 1e-300)))), B.binary(kind.astype("u1"), np.concatenate([[0], np.cumsum(size)]))], names=[*keep, *names])

    sent = rows.groupBy("block").applyInArrow(send, B.SENT).unionByName(model.words)
    answers = sent.groupBy("bucket").applyInArrow(answer, B.ANSWER)
    schema = T.StructType([docs.schema[c] for c in keep])
    for name, kind in zip(names, (T.BooleanType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.BinaryType()), strict=True):
        schema = schema.add(name, kind)
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, schema)


def _pairs(column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class before, class, length by text) of the tokens of all texts; each
    text ends in the class ``end``, which also precedes its first word."""
    seq, size = B.numbers(column, "u1")
    return np.concatenate([[end], seq[:-1]]).astype(np.int64)[:len(seq)], seq.astype(np.int64), size


def _class_bigrams(classed: DataFrame, total: int) -> np.ndarray:
    """Bigram counts of classes over the learned rows of ``classed``."""
    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros(total * total, np.int64)
        for b in batches:
            before, kind, _ = _pairs(b.column("_classes"), total - 1)
            out += np.bincount(before * total + kind, minlength=len(out))
        return out
    return _sums(classed.where("_learned").select("_classes"), count, (total, total))


def score(docs: DataFrame, model: Model, train: str, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default doc_id) plus n_tokens, n_known
    (tokens seen in training), train_tokens, base_score (add-one unigrams) and
    score (log10 probability of the text under the classes), one row per row.
    ``docs`` has doc_id, text and the boolean column ``train``, which names the
    rows that ``model`` was learned from. A null text is empty: its only token
    is the end. Columns of ``docs`` with the added names are replaced. The
    classes of all tokens, one byte each, are written to the checkpoint folder."""
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    keep = [c for c in (["doc_id"] if keep is None else keep) if c not in (*added, "block")]
    classed = _classed(docs, model, train, keep).checkpoint()
    total, n_train = len(model.class_tokens), model.tokens
    transition = model.log_transition(_class_bigrams(classed, total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            before, kind, size = _pairs(b.column("_classes"), total - 1)
            logs = np.bincount(np.repeat(np.arange(len(size)), size), weights=transition[before, kind], minlength=len(size))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in (*keep, "n_tokens", "n_known")), pa.array(np.full(len(size), n_train, np.int64)), b.column("base_score"),
                                              pa.array(b.column("_words").to_numpy() + logs)], names=[*keep, *added])

    schema = T.StructType([docs.schema[c] for c in keep])
    for name, kind in zip(added, (T.LongType(),) * 3 + (T.DoubleType(),) * 2, strict=True):
        schema = schema.add(name, kind)
    return classed.mapInArrow(run, schema)
