"""Spelling variants by dynamic programming over sorted word lists.

Two words are near if one inserted, deleted or replaced character (code point)
makes one of the other. A word's form is its near word of largest count, if
that is many times its own; its root is where the forms lead.

The vocabulary is dealt into lists that hold every near pair exactly once. With
m the length of a pair's shorter word and e the length of its common prefix, a
list (m, low, high, key) holds words of m and m + 1 characters for pairs with
low <= e < high: all of them share their first ``low`` and last ``m - high``
characters, the key. At first low, high is 0, m / 2 or m / 2, m + 1; a list of
more than ``LIST`` words is divided at the middle of low and high until it is
small, which the alphabet bounds at the latest when high is low + 1. Words
travel once per list; no pair is sent anywhere.

A list is sorted by what lies between the parts of its key, with the common
prefix of neighbours (LCP). The prefixes of a sorted list are its ranges, and a
row of the edit matrix belongs to a range, so it is computed once for all words
below it: all queries descend together, a step per character; ranges divide
where the LCP is as long as the prefix; a row has three cells, as an edit apart
means at most one column off the diagonal; and a range whose row holds no value
under two is skipped with all its words. What is found is counted per word in
the task.

Words are of the class ``[A-Za-z\\u00C0-\\u00FF]``, so a character is one Latin-1
byte. A null text has no words, a null doc_id is written as nothing, repeated
rows count as often as they occur, and an empty table has no words. Words of
any length take part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm import blocks as B
from tabula.session import checkpoint_dir

RUN = re.compile(rb"[a-z\xc0-\xff]+")
LIST = 1 << 15
TASK_ROWS = 1 << 17
STATES = 1 << 18
_HELD = 1 << 18


def _runs(text: bytes) -> Iterator[list[bytes]]:
    """The runs of a lower-cased text, in lists of bounded size."""
    if len(text) < 1 << 22:
        yield RUN.findall(text)
        return
    found = RUN.finditer(text)
    while some := [m.group() for m in islice(found, 1 << 18)]:
        yield some


def count_words(docs: DataFrame, *, min_length: int = 7, min_count: int = 2, damage: int | None = None) -> DataFrame:
    """word and n of all runs of ``docs`` (doc_id, text) with A-Z lower-cased,
    at least ``min_length`` characters and ``min_count`` occurrences. With
    ``damage``, a run whose crc32 (of doc_id, colon, run) that number divides
    loses the character at crc32 modulo its length, as a misspelling would."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

        def sent() -> pa.RecordBatch:
            out = pa.record_batch([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], schema=schema)
            held.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
                seed = zlib.crc32(f"{doc}:".encode())
                # a character outside Latin-1 becomes one that is no letter; bytes.lower() knows A-Z only
                for runs in _runs(text.encode("latin-1", "replace").lower()):
                    for run, n in Counter(runs).items():
                        if len(run) < min_length:
                            continue
                        if damage:
                            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
                            if h % damage == 0:
                                at = h % len(run)
                                run = run[:at] + run[at + 1:]
                                if len(run) < min_length:
                                    continue
                        held[run] += n
                    if len(held) > _HELD:
                        yield sent()
        if held:
            yield sent()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), "text").where("text is not null")
    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _keyed(vocabulary: DataFrame) -> DataFrame:
    """The words of all lists, before any is divided: m, low, high, key, word, n."""
    size = F.length("word")
    lists = F.explode(F.flatten(F.array(*[F.array(
        F.struct(m.alias("m"), F.lit(0).alias("low"), F.floor(m / 2).cast("int").alias("high")),
        F.struct(m.alias("m"), F.floor(m / 2).cast("int").alias("low"), (m + 1).alias("high"))) for m in (size, size - 1)])))
    return _with_key(vocabulary.select("word", "n", lists.alias("list")).select("word", "n", "list.*"))


def _with_key(rows: DataFrame) -> DataFrame:
    tail = F.greatest(F.col("m") - F.col("high"), F.lit(0))
    key = F.concat(F.col("word").substr(F.lit(1), F.col("low")), F.lit("-"), F.col("word").substr(F.length("word") - tail + 1, tail))
    return rows.select("m", "low", "high", key.alias("key"), "word", "n")


def _divided(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` with every list of more than ``limit`` words divided."""
    names = ["m", "low", "high", "key"]
    while True:
        top = F.least("high", F.col("m"))  # positions above m are one
        large = rows.groupBy(*names).agg(F.count("*").alias("_size")).where((F.col("_size") > limit) & (top - F.col("low") > 1)).drop("_size").checkpoint()
        if large.isEmpty():
            return rows
        marked = rows.join(large.withColumn("_large", F.lit(True)), names, "left")
        middle = F.floor((F.col("low") + top) / 2).cast("int")
        halves = F.when(F.col("_large"), F.array(F.struct("low", middle.alias("high")), F.struct(middle.alias("low"), "high"))) \
            .otherwise(F.array(F.struct("low", "high")))
        rows = _with_key(marked.select("m", "word", "n", F.explode(halves).alias("part")).select("m", "part.*", "word", "n")).checkpoint()


class SortedList:
    """Lists of one width: their words between the parts of the key, sorted."""

    def __init__(self, group: np.ndarray, middle: np.ndarray):
        """``middle``: rows of bytes, zero after their end, two columns spare."""
        rows, width = middle.shape
        digits = np.ascontiguousarray(np.pad(middle, ((0, 0), (0, -width % 8)))).view(">u8")
        self.order = np.lexsort((*digits.T[::-1], group))
        self.text = middle[self.order]
        group = group[self.order]
        self.length = (self.text != 0).sum(axis=1)
        differ = self.text[1:] != self.text[:-1]
        lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        self.lcp = np.concatenate([[-1], np.where(group[1:] != group[:-1], -1, lcp)])
        starts = np.flatnonzero(self.lcp < 0)
        self.low = np.repeat(starts, np.diff(np.append(starts, rows)))
        self.high = np.repeat(np.append(starts[1:], rows), np.diff(np.append(starts, rows)))

    def near(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (row, row) one edit apart, both ways, in bounded batches."""
        alone = self.high - self.low < 2
        queries = np.flatnonzero(~alone)
        widest = np.minimum(self.high[queries] - self.low[queries], 256)
        cuts = np.searchsorted(np.cumsum(widest), np.arange(STATES, int(widest.sum()) + STATES, STATES), side="right")
        for a, b in zip(np.concatenate([[0], np.maximum(cuts[:-1], 1)]), cuts, strict=True):
            if b > a:
                yield self._descend(queries[a:b])

    def _descend(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, width = self.text.shape
        low, high = self.low[q], self.high[q]
        two = np.full(len(q), 2, np.int8)
        row = [two, two - 2, two - 1]  # columns d - 1, d, d + 1 of the edit matrix, 2 for all above one
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for d in range(width):
            if not len(q):
                break
            starts = np.flatnonzero(self.lcp <= d)  # ranges of words alike in d + 1 characters
            first = np.searchsorted(starts, low)
            count = np.searchsorted(starts, high) - first
            parent = np.repeat(np.arange(len(q)), count)
            child = np.repeat(first - np.cumsum(count) + count, count) + np.arange(len(parent))
            low, high = starts[child], np.append(starts, n)[child + 1]
            q, row = q[parent], [r[parent] for r in row]
            c = self.text[low, d]
            off = self.length[q] - d
            ended = c == 0  # the word of this range is d characters long
            last = np.choose(np.clip(off + 1, 0, 2), row)
            hit = ended & (np.abs(off) < 2) & (last == 1)
            found.append((q[hit], low[hit]))
            before = self.text[q, d - 1] if d else np.zeros(len(q), np.uint8)
            here, after = self.text[q, d], self.text[q, d + 1] if d + 1 < width else np.zeros(len(q), np.uint8)
            left = np.minimum(row[0] + (c != before), row[1] + 1)
            middle = np.minimum(np.minimum(row[1] + (c != here), row[2] + 1), left + 1)
            right = np.minimum(row[2] + (c != after), middle + 1)
            new = [np.where(off - 1 < k, 2, np.minimum(x, 2)).astype(np.int8) for k, x in ((-1, left), (0, middle), (1, right))]
            live = ~ended & (np.minimum(np.minimum(new[0], new[1]), new[2]) < 2)
            q, low, high, row = q[live], low[live], high[live], [x[live] for x in new]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(Latin-1 bytes, offsets) of all words together."""
    raw = [w.encode("latin-1") for w in words.to_pylist()]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(w) for w in raw], dtype=np.int64)])


def _near_in(table: pa.Table) -> pa.Table:
    """Per word of some lists: its near words there, their number and the one
    of largest count (the smallest of equals)."""
    words = pc.dictionary_encode(table.column("word").combine_chunks())
    order = pc.sort_indices(words.dictionary).to_numpy()
    word = np.empty(len(order), np.int64)
    word[order] = np.arange(len(order))
    word = word[words.indices.to_numpy()]  # in the order of the words
    n = table.column("n").to_numpy()
    m, start, high = (table.column(c).to_numpy().astype(np.int64) for c in ("m", "low", "high"))
    data, offsets = _bytes(table.column("word").combine_chunks())
    keys = pc.dictionary_encode(table.column("key").combine_chunks())
    key = keys.indices.to_numpy().astype(np.int64)
    length = np.diff(offsets)
    size = length - start - np.maximum(m - high, 0)  # characters between the parts of the key
    results: list[tuple[np.ndarray, np.ndarray]] = []
    wide = np.minimum(high, m + 1) - start
    for w in np.unique(wide).tolist():
        rows = np.flatnonzero(wide == w)
        _, group = np.unique(np.stack([m[rows], start[rows], high[rows], key[rows]], axis=1), axis=0, return_inverse=True)
        kept = np.bincount(group)[group] > 1
        rows, group = rows[kept], group[kept]
        if not len(rows):
            continue
        columns = np.arange(w + 3)
        inside = columns < size[rows][:, None]
        at = np.minimum(offsets[rows][:, None] + start[rows][:, None] + columns, len(data) - 1)
        found = SortedList(group, np.where(inside, data[at], 0).astype(np.uint8))
        for a, b in found.near():
            common = (found.text[a] != found.text[b]).argmax(axis=1)
            x, y = rows[found.order[a]], rows[found.order[b]]
            own = (common < high[x] - start[x]) & ((length[x] == m[x]) | (length[y] == m[x]))
            results.append((x[own], y[own]))
    x = np.concatenate([a for a, _ in results]) if results else np.empty(0, np.int64)
    y = np.concatenate([b for _, b in results]) if results else np.empty(0, np.int64)
    best = np.lexsort((word[y], -n[y], word[x]))
    x, y = x[best], y[best]
    first = np.flatnonzero(np.concatenate([[True], word[x][1:] != word[x][:-1]])) if len(x) else np.empty(0, np.int64)
    counts = np.diff(np.append(first, len(x)))
    take = table.column("word").take
    return pa.table([take(pa.array(x[first])), pa.array(counts, pa.int64()), pa.array(n[y[first]], pa.int64()), take(pa.array(y[first]))],
                    names=["word", "n_near", "best_n", "best"])


def near_words(vocabulary: DataFrame, *, limit: int = LIST) -> DataFrame:
    """For every word of ``vocabulary`` (word, n: distinct words) that has near
    words: word, n_near, and best_n and best, the near word of largest n."""
    checkpoint_dir(vocabulary.sparkSession)
    tasks = max(1, min(B.partitions(vocabulary.sparkSession), -(-vocabulary.count() // 4096)), -(-vocabulary.count() * 4 // TASK_ROWS))
    rows = _divided(_keyed(vocabulary), limit).withColumn("task", F.pmod(F.xxhash64("m", "low", "high", "key"), F.lit(tasks)).cast("int"))
    found = rows.groupBy("task").applyInArrow(_near_in, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best")) \
        .select("word", "n_near", (-F.col("_best.n")).alias("best_n"), F.col("_best.word").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """word and root, where the forms (word, form) lead; every round doubles
    the way. A form has ``factor`` times the count, so ways are short."""
    roots = forms.select("word", F.col("form").alias("root")).checkpoint()
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = roots.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")).checkpoint()
        roots = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return roots


def group_variants(vocabulary: DataFrame, *, factor: int = 10) -> DataFrame:
    """Every word of ``vocabulary`` (word, n) with n, n_near (0 if none), form
    (its near word of largest n, ties to the smaller word, if that n is at
    least ``factor`` times its own; else null), form_n and root."""
    checkpoint_dir(vocabulary.sparkSession)
    vocabulary = vocabulary.select("word", "n").checkpoint()
    near = near_words(vocabulary)
    is_form = F.col("best_n") >= factor * F.col("n")
    joined = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")).checkpoint()
    roots = _roots(joined.where("form is not null"))
    return joined.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
