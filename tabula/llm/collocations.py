"""Phrase collocations by the stripes pattern.

A stripe belongs to a prefix of zero, one or two words and counts the words
that follow it. The entry of word w in the stripe of prefix p is the count of
the phrase p w, so one structure holds it all: the entries of a stripe are the
extensions of its prefix, the prefix's own total is an entry of the stripe one
word shorter, and the largest entries over a phrase to its right (its own
stripe) and to its left (the entry of its last word in the stripes that end in
its first) tell whether a longer phrase subsumes it.

Blocks of documents build stripes, bounded by their size, and send them to
buckets, which merge them elementwise and answer with the global counts. The
next longer stripes are built only over phrases that have reached ``min_count``
(a longer phrase is never more frequent). Words travel as strings once, in the
stripe of the empty prefix, whose buckets compare them as bytes and number the
frequent ones of every language; longer stripes hold these numbers, so counts
are exact. A stripe whose prefix is frequent is divided by its next words into
parts of about ``STRIPE`` occurrences, as the total is known before it is
built; a pair of words that fills a third of the corpus is one entry per block.
The merged stripes are written to the checkpoint folder, and the words of the
phrases that remain are looked up there (the commonest words are broadcast).

Texts are cut at piece borders into rows of about ``ROW_BYTES`` before they are
dealt to blocks, so a long text is not one task's (a single piece stays whole).
A null text is empty; a null language is ``und``; repeated rows count as often
as they occur; an empty table has no phrases.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabula.llm import blocks as B
from tabula.llm import ragged
from tabula.operators.joins import heavy_join
from tabula.session import shared_path

BREAK = np.zeros(256, dtype=bool)  # .,;:!? and \x0A-\x0D end a piece
BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
WORD = ~BREAK
WORD[[0x20, 0x09]] = False

ROW_BYTES = 1 << 18
SMALL_BLOCK, LARGE_BLOCK = 1 << 20, 1 << 23
STRIPE = 1 << 16
SALTS = 64
_NONE = "und"


def _strings(lengths: np.ndarray, data: bytes) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _raw(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a large_binary array."""
    offsets = np.frombuffer(strings.buffers()[1], np.int64, len(strings) + 1, 8 * strings.offset)
    data = strings.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)


def _numbered(strings: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(distinct strings in byte order, the number of each string): the rows of
    a block come in any order, and what it sends must not follow it."""
    coded = strings.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    number = np.empty(len(order), np.int64)
    number[order.to_numpy()] = np.arange(len(order))
    return coded.dictionary.take(order), number[coded.indices.to_numpy()]


_SIZES = ("<u1", "<u2", "<u4", "<u8")


def _pack(columns: list[np.ndarray], data: bytes = b"") -> bytes:
    """Columns of numbers from 0, each in the bytes its largest needs, and ``data``."""
    head, parts = [], []
    for c in columns:
        size = next(i for i in range(4) if int(c.max(initial=0)) < 1 << (8 << i))
        head += [size, len(c)]
        parts.append(c.astype(_SIZES[size]).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(np.array(head, "<u4").tobytes() + b"".join(parts) + data)


def _unpack(packed: bytes, n: int) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    out, at = [], 8 * n
    for size, count in np.frombuffer(raw, "<u4", 2 * n).reshape(n, 2).tolist():
        out.append(np.frombuffer(raw, _SIZES[size], count, at).astype(np.int64))
        at += count << size
    return out, raw[at:]


def _groups(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first member, number) of the groups of rows equal in all columns."""
    number = columns[0]
    for c in columns[1:]:
        number = number * (int(c.max(initial=0)) + 1) + c
        if len(columns) > 2:
            number = np.unique(number, return_inverse=True)[1]
    _, first, number = np.unique(number, return_index=True, return_inverse=True)
    return first, number


def _to_buckets(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


class Block:
    """The words of a block of texts, and its stripes as counts of phrases."""

    def __init__(self, table: pa.Table):
        data, offsets = ragged.text_bytes(table.column("text"))
        data = ragged.LOWER[data]
        starts, ends, doc = ragged.runs(data, offsets, WORD)
        names, lang = _numbered(pa.concat_arrays(table.column("lang").chunks).cast(pa.large_binary()))
        lang = lang[doc]
        piece = np.cumsum(BREAK[data], dtype=np.int32)
        self.joined = (doc[1:] == doc[:-1]) & (piece[starts[1:]] == piece[starts[:-1]])  # word i + 1 follows word i in a piece
        words, word = _numbered(_strings(ends - starts, data[WORD[data]].tobytes()))
        v = len(words)
        self.strings = pa.concat_arrays([words, names])
        at, raw = _raw(self.strings)
        hashes = ragged.hash_runs(raw, at[:-1], at[1:])
        code = lang * v + word
        counts = np.bincount(code, minlength=len(names) * v)
        used = np.flatnonzero(counts)
        back = np.cumsum(counts > 0) - 1
        self.of_word = back[code]  # number of each word's (lang, word)
        self.lang, self.word, self.n = used // max(v, 1) + v, used % max(v, 1), counts[used]
        self.hash = ragged.mix(hashes[self.word] + hashes[self.lang] * np.uint64(3))
        self.tokens = np.unique(lang, return_counts=True)
        self.v = v

    def _texts(self, numbers: np.ndarray) -> tuple[np.ndarray, bytes]:
        """(lengths, bytes) of strings."""
        offsets, data = _raw(self.strings.take(pa.array(numbers)))
        return np.diff(offsets), data[offsets[0]:offsets[-1]].tobytes()

    def send_words(self, buckets: int) -> Iterator[tuple[int, bytes]]:
        """The stripe of the empty prefix, by language."""
        for b, rows in self._by_bucket(_to_buckets(self.hash, buckets)):
            langs, lang = np.unique(self.lang[rows], return_inverse=True)
            lengths, data = self._texts(np.concatenate([self.word[rows], langs]))
            yield b, _pack([lengths, lang, self.n[rows]], data)

    def read_words(self, answers: pa.Table, buckets: int) -> None:
        """The words' totals (0 below the least count), numbers and owners."""
        f, self.id = self._answer(_to_buckets(self.hash, buckets), answers, 2)
        self.f, self.owned = f >> 1, f & 1 == 1

    def frequent_words(self) -> bytes:
        """The frequent words that this block owns, with their numbers and totals."""
        rows = np.flatnonzero(self.owned)
        langs, lang = np.unique(self.lang[rows], return_inverse=True)
        lengths, data = self._texts(np.concatenate([self.word[rows], langs]))
        return _pack([lengths, lang, self.id[rows], self.f[rows]], data)

    def _by_bucket(self, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(bucket, kind="stable")
        used, at = np.unique(bucket[order], return_index=True)
        if not len(used):
            return
        yield from zip(used.tolist(), np.split(order, at[1:]), strict=True)

    def _answer(self, bucket: np.ndarray, answers: pa.Table, columns: int) -> list[np.ndarray]:
        """Answers, in the order sent, put back to the rows they are for."""
        out = [np.zeros(len(bucket), np.int64) for _ in range(columns)]
        if len(bucket):
            got = [_unpack(x, columns)[0] for x in answers.sort_by("bucket").column("answer").to_pylist()]
            order = np.argsort(bucket, kind="stable")
            for j, x in enumerate(out):
                x[order] = np.concatenate([g[j] for g in got])
        return out

    def pairs(self, buckets: int, stripe: int = STRIPE) -> None:
        """The stripes of the frequent words, sorted by the words' numbers."""
        self.stripe = stripe
        often = self.f[self.of_word] > 0
        self.first = np.flatnonzero(self.joined & often[:-1] & often[1:]) if len(often) > 1 else np.empty(0, np.int64)
        rank = np.argsort(np.argsort(self.id, kind="stable"))  # of the words by number
        size = max(len(rank), 1)
        code = rank[self.of_word[self.first]] * size + rank[self.of_word[self.first + 1]]
        used, self.of_pair, self.n2 = np.unique(code, return_inverse=True, return_counts=True)
        by_rank = np.argsort(rank)
        self.a, self.b = by_rank[used // size], by_rank[used % size]
        part = self.hash[self.b] % (1 + self.f[self.a] // stripe).astype(np.uint64)
        self.bucket2 = _to_buckets(ragged.mix(self.hash[self.a] + part * np.uint64(0x9E3779B97F4A7C15)), buckets)

    def send_pairs(self) -> Iterator[tuple[int, bytes]]:
        """Stripes: prefixes (as steps) with their numbers of entries, and the entries."""
        for b, rows in self._by_bucket(self.bucket2):
            a = self.id[self.a[rows]]
            first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
            yield b, _pack([np.diff(a[first], prepend=0), np.diff(np.append(first, len(a))), self.id[self.b[rows]], self.n2[rows]])

    def send_triples(self, answers: pa.Table, buckets: int) -> Iterator[tuple[int, bytes]]:
        """Stripes of the frequent pairs: prefixes (the first words as steps)
        with their totals and numbers of entries, and entries with the totals
        of their last two words. A pair that goes on nowhere in this block is
        sent by its owner only."""
        answered, = self._answer(self.bucket2, answers, 1)
        f2 = answered >> 1
        number = np.full(len(self.of_word) + 1, -1)
        number[self.first] = self.of_pair  # the pair that starts at a word
        often = number >= 0
        often[often] = f2[number[often]] > 0
        at = np.flatnonzero(often[:-1] & often[1:])
        size = max(len(f2), 1)
        used, n3 = np.unique(number[at] * size + number[at + 1], return_counts=True)
        left, right = used // size, used % size  # the pairs a b and b c
        last = self.b[right]
        part = (self.hash[last] % (1 + f2[left] // self.stripe).astype(np.uint64)).astype(np.int64)
        alone = np.setdiff1d(np.flatnonzero((f2 > 0) & (answered & 1 == 1)), left)
        prefix, sub = np.concatenate([left, alone]), np.concatenate([part, np.zeros(len(alone), np.int64)])
        first, row = _groups(prefix, sub)
        prefix, sub, row = prefix[first], sub[first], row[:len(left)]
        held = np.bincount(row, minlength=len(prefix))
        pair_hash = ragged.mix(self.hash[self.a[prefix]] + self.hash[self.b[prefix]] * np.uint64(5))
        bucket = _to_buckets(ragged.mix(pair_hash + sub.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), buckets)
        entries = np.lexsort((row, bucket[row]))
        ends = np.searchsorted(bucket[row][entries], np.arange(buckets + 1))
        for b, rows in self._by_bucket(bucket):
            own, p = entries[ends[b]:ends[b + 1]], prefix[rows]
            yield b, _pack([np.diff(self.id[self.a[p]], prepend=0), self.id[self.b[p]], f2[p], held[rows], self.id[last[own]], n3[own], f2[right[own]]])

    def totals(self) -> bytes:
        lengths, data = self._texts(self.tokens[0] + self.v)
        return _pack([lengths, self.tokens[1]], data)


def _together(messages: list[bytes], n: int) -> tuple[list[np.ndarray], list[list[int]], list[bytes]]:
    """(columns of all messages, their rows by message and column, their bytes)."""
    read = [_unpack(m, n) for m in messages]
    return [np.concatenate([c[j] for c, _ in read]) for j in range(n)], [[len(x) for x in c] for c, _ in read], [d for _, d in read]


def _lang_words(messages: list[bytes], n: int) -> tuple[pa.Array, np.ndarray, np.ndarray, list[np.ndarray], list[int]]:
    """(strings in byte order, numbers of the words and of their languages, further
    columns, rows by message) of messages that hold words by language."""
    (lengths, lang, *rest), rows, data = _together(messages, n)
    strings, number = _numbered(_strings(lengths, b"".join(data)))
    sizes = [r[1] for r in rows]
    starts = np.concatenate([[0], np.cumsum([r[0] for r in rows])[:-1]])  # of a message's strings; its languages follow its words
    word = np.concatenate([np.arange(a, a + size) for a, size in zip(starts.tolist(), sizes, strict=True)])
    lang = np.repeat(starts + np.array(sizes), sizes) + lang
    return strings, number[word], number[lang], rest, sizes


def _merged(ids: list[np.ndarray], n: np.ndarray, block: np.ndarray, min_count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first member, number, answer) of the groups of equal ``ids``. The answer
    of an entry is twice its total, and one more in the first block that holds
    it (the owner); 0 if the total is below ``min_count``."""
    first, number = _groups(*ids)
    total = np.zeros(len(first), np.int64)
    np.add.at(total, number, n)
    owner = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(owner, number, block)
    return first, number, np.where(total[number] >= min_count, 2 * total[number] + (block == owner[number]), 0)


def _answer_words(messages: list[bytes], blocks: np.ndarray, bucket: int, buckets: int, min_count: int) -> list[bytes]:
    """Merges stripes of the empty prefix, and numbers the frequent words: by
    language and bytes within the bucket, so that numbers are the same whenever
    a task runs again."""
    _, word, lang, (n,), sizes = _lang_words(messages, 3)
    first, number, answer = _merged([lang, word], n, np.repeat(blocks, sizes), min_count)
    often = np.zeros(len(first), dtype=bool)
    often[number[answer > 0]] = True
    ids = np.where(often, np.cumsum(often) * buckets + bucket, 0)[number]  # groups are in the order of (lang, word)
    cuts = np.cumsum(sizes)[:-1]
    return [_pack([x, y]) for x, y in zip(np.split(answer, cuts), np.split(ids, cuts), strict=True)]


def _steps(column: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Sums of steps, anew in every message."""
    return np.concatenate([np.cumsum(x) for x in np.split(column, np.cumsum(sizes)[:-1])])


def _answer_pairs(messages: list[bytes], blocks: np.ndarray, min_count: int) -> list[bytes]:
    """Merges stripes of single words elementwise."""
    (steps, held, w2, n), rows, _ = _together(messages, 4)
    w1 = np.repeat(_steps(steps, [r[0] for r in rows]), held)
    sizes = [r[2] for r in rows]
    _, _, answer = _merged([w1, w2], n, np.repeat(blocks, sizes), min_count)
    return [_pack([x]) for x in np.split(answer, np.cumsum(sizes)[:-1])]


_COLUMNS = ["w1", "w2", "w3", "a", "l2", "r1", "inside", "f", "n"]
_MERGED = pa.schema([(c, pa.int64()) for c in _COLUMNS] + [("lang", pa.string()), ("word", pa.string())])


def _table(size: int, **columns) -> pa.Table:
    return pa.table([columns[f.name].cast(f.type) if isinstance(columns.get(f.name), pa.Array) else pa.array(columns[f.name], f.type) if f.name in columns
                     else pa.nulls(size, f.type) for f in _MERGED], schema=_MERGED)


def _phrases(messages: list[bytes], min_count: int) -> list[pa.Table]:
    """Merges stripes of pairs: a row per pair and frequent triple, and per pair
    inside a triple its largest count."""
    (steps, w2, a, held, w3, n, f23), rows, _ = _together(messages, 7)
    w1 = _steps(steps, [r[0] for r in rows])
    prefix = np.repeat(np.arange(len(w1)), held)
    p_first, p_number = _groups(w1, w2)
    e_first, e_number = _groups(p_number[prefix], w3)
    total = np.zeros(len(e_first), np.int64)
    np.add.at(total, e_number, n)
    often = total >= min_count
    own, total = e_first[often], total[often]
    p = prefix[own]  # the triple's prefix
    out = [_table(len(p_first), w1=w1[p_first], w2=w2[p_first], a=a[p_first])]
    if len(own):
        out.append(_table(len(own), w1=w1[p], w2=w2[p], w3=w3[own], a=total, l2=a[p], r1=f23[own]))
        for x, y in ((w1[p], w2[p]), (w2[p], w3[own])):
            first, number = _groups(x, y)
            most = np.zeros(len(first), np.int64)
            np.maximum.at(most, number, total)
            out.append(_table(len(first), w1=x[first], w2=y[first], inside=most))
    return out


def _cut(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Long texts as several rows, cut at piece borders."""
    schema = pa.schema([("deal", pa.int64()), ("lang", pa.string()), ("text", pa.string())])
    for batch in batches:
        batch = pa.RecordBatch.from_arrays([batch.column(c) for c in schema.names], schema=schema)
        long = pc.greater(pc.binary_length(batch.column("text")), size).to_numpy(zero_copy_only=False)
        if not long.any():
            yield batch
            continue
        yield batch.filter(pa.array(~long))
        for i in np.flatnonzero(long).tolist():
            text = batch.column("text")[i].as_py().encode()
            ends = np.flatnonzero(BREAK[np.frombuffer(text, np.uint8)]) + 1
            at, part = 0, 0
            while at < len(text):
                k = int(np.searchsorted(ends, at + size, side="right")) - 1
                end = int(ends[k]) if k >= 0 and ends[k] > at else int(ends[k + 1]) if k + 1 < len(ends) else len(text)
                deal = (batch.column("deal")[i].as_py() + part * 0x9E3779B97F4A7C15 + 2**63) % 2**64 - 2**63
                yield pa.record_batch([pa.array([deal], pa.int64()), batch.column("lang").slice(i, 1), pa.array([text[at:end].decode()])], schema=schema)
                at, part = end, part + 1


_SENT = "bucket int, block int, stripes binary"
_STRIPES, _TOTALS, _WORDS = 0, 1, 2


def stripes(docs: DataFrame, *, lang: str = "lang", min_count: int = 10, stripe: int = STRIPE, row_bytes: int = ROW_BYTES) -> DataFrame:
    """Merged stripes: per (lang, phrase) of two or three words with ``a``
    occurrences, at least ``min_count``, the counts of the parts of its cuts
    (l1, r1 after its first word; l2, r2 after its second) and ``inside``, the
    largest count, if any, of a phrase of three words that holds it and reaches
    ``min_count``; and per lang a row with a null phrase and n, all its words.
    Results do not depend on ``stripe`` and ``row_bytes``."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(_NONE)).alias("lang"), F.col("text"), F.xxhash64("doc_id", "text").alias("deal")).where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(min(B.partitions(spark), -(-size // SMALL_BLOCK)), -(-size // LARGE_BLOCK), 1)
    texts = rows.mapInArrow(lambda batches: _cut(batches, row_bytes), "deal bigint, lang string, text string").select("lang", "text", F.pmod("deal", F.lit(n)).cast("int").alias("block"))

    def sent(block: int, messages: Iterator[tuple[int, bytes]]) -> pa.Table:
        found = list(messages)
        return pa.table([pa.array([b for b, _ in found], pa.int32()), pa.array([block] * len(found), pa.int32()), pa.array([m for _, m in found], pa.binary())],
                        names=["bucket", "block", "stripes"])

    def at_level(right: pa.Table, level: int) -> pa.Table:
        return right.filter(pc.equal(right.column("level"), level))

    def send_words(table: pa.Table) -> pa.Table:
        return sent(B.block_of(table), Block(table).send_words(n))

    def read(left: pa.Table, answers: pa.Table) -> Block:
        block = Block(left)
        block.read_words(answers, n)
        block.pairs(n, stripe)
        return block

    def send_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
        return sent(B.block_of(left), read(left, right).send_pairs()) if left.num_rows else sent(0, iter(()))

    def send_triples(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["bucket", "stripes", "kind"]
        if not left.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int32(), pa.binary(), pa.int32())], names=names)
        block, number = read(left, at_level(right, 0)), B.block_of(left)
        found = [(b, m, _STRIPES) for b, m in block.send_triples(at_level(right, 1), n)]
        found += [(number, block.totals(), _TOTALS), (number, block.frequent_words(), _WORDS)]
        return pa.table([pa.array(list(c), t) for c, t in zip(zip(*found, strict=True), (pa.int32(), pa.binary(), pa.int32()), strict=True)], names=names)

    def answered(table: pa.Table, found: list[bytes]) -> pa.Table:
        return pa.table([table.column("bucket"), table.column("block"), pa.array(found, pa.binary())], names=["bucket", "block", "answer"])

    def merge_words(table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_numpy().astype(np.int64)
        return answered(table, _answer_words(table.column("stripes").to_pylist(), blocks, table.column("bucket")[0].as_py(), n, min_count))

    def merge_pairs(table: pa.Table) -> pa.Table:
        return answered(table, _answer_pairs(table.column("stripes").to_pylist(), table.column("block").to_numpy().astype(np.int64), min_count))

    def finish(table: pa.Table) -> pa.Table:
        of = lambda kind: table.filter(pc.equal(table.column("kind"), kind)).column("stripes").to_pylist()
        out = [_MERGED.empty_table()]
        if phrases := of(_STRIPES):
            out += _phrases(phrases, min_count)
        if totals := of(_TOTALS):
            (lengths, count), _, data = _together(totals, 2)
            names, number = _numbered(_strings(lengths, b"".join(data)))
            per = np.zeros(len(names), np.int64)
            np.add.at(per, number, count)
            out.append(_table(len(names), lang=names, n=per))
        if words := of(_WORDS):
            strings, word, own, (ids, f), _ = _lang_words(words, 4)
            out.append(_table(len(ids), w1=ids, f=f, lang=strings.take(pa.array(own)), word=strings.take(pa.array(word))))
        return pa.concat_tables(out)

    dealt = texts.groupBy("block")
    words = dealt.applyInArrow(send_words, _SENT).groupBy("bucket").applyInArrow(merge_words, B.ANSWER)
    pairs = dealt.cogroup(words.groupBy("block")).applyInArrow(send_pairs, _SENT).groupBy("bucket").applyInArrow(merge_pairs, B.ANSWER)
    answers = words.withColumn("level", F.lit(0)).unionByName(pairs.withColumn("level", F.lit(1)))
    merged = dealt.cogroup(answers.groupBy("block")).applyInArrow(send_triples, "bucket int, stripes binary, kind int") \
        .groupBy("bucket").applyInArrow(finish, ", ".join(f"{c} bigint" for c in _COLUMNS) + ", lang string, word string")
    path = shared_path(spark, f"stripes-{uuid.uuid4().hex[:12]}")
    merged.write.parquet(path)
    merged = spark.read.parquet(path)
    # parts of one stripe, and extensions to the left, come from several buckets
    found = merged.where("w2 is not null").groupBy("w1", "w2", "w3").agg(
        F.max(F.when(F.col("a").isNotNull(), F.struct("a", "l2", "r1"))).alias("_f"), F.max("inside").alias("inside"))
    found = found.where("_f is not null").select("w1", "w2", "w3", "_f.*", "inside")
    named = merged.where("word is not null").select(F.col("w1").alias("id"), "lang", "word", "f")
    for i in (1, 2, 3):
        given = named.select(F.col("id").alias(f"w{i}"), F.struct("lang", "word", "f").alias(f"_{i}"), "f")
        found = heavy_join(found, given, f"w{i}", [f"_{i}"], "f", ["w1", "w2", "w3"])
    phrases = found.select(F.col("_1.lang").alias("lang"), F.concat_ws(" ", "_1.word", "_2.word", "_3.word").alias("phrase"), "a", F.col("_1.f").alias("l1"),
                           F.coalesce("r1", "_2.f").alias("r1"), "l2", F.col("_3.f").alias("r2"), "inside", F.lit(None).cast("bigint").alias("n"))
    totals = merged.where("n is not null").groupBy("lang").agg(F.sum("n").alias("n"))
    return phrases.unionByName(totals, allowMissingColumns=True)


def mine(docs: DataFrame, *, lang: str = "lang", min_count: int = 10, subsumed: int = 50, top: int = 2000, **sizes: int) -> DataFrame:
    """The first ``top`` collocations of every language: lang, rank, phrase, a, l, r, n, score.

    score is floor(1000000 * a * a / (l * r)) of the lowest-scoring cut of a
    phrase (the earlier of equals), in decimals of 38 digits; phrases inside a
    longer one with at least ``subsumed`` per cent of their occurrences are
    dropped. Order: score and a descending, phrase in byte order."""
    def score(left: str, right: str) -> str:
        return f"(cast(1000000 as decimal(38,0)) * a * a) div (cast({left} as decimal(38,0)) * {right})"
    found = stripes(docs, lang=lang, min_count=min_count, **sizes)
    found = found.where(F.col("phrase").isNull() | (F.col("a").isNotNull() & ~F.coalesce(100 * F.col("inside") >= subsumed * F.col("a"), F.lit(False))))
    found = found.withColumn("s1", F.expr(score("l1", "r1"))).withColumn("s2", F.when(F.col("l2").isNotNull(), F.expr(score("l2", "r2"))))
    second = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    found = found.select("lang", "phrase", "a", F.when(second, F.col("l2")).otherwise(F.col("l1")).alias("l"), F.when(second, F.col("r2")).otherwise(F.col("r1")).alias("r"),
                         "n", F.when(second, F.col("s2")).otherwise(F.col("s1")).alias("score"), F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("_salt"))
    # the row with the language's total, whose phrase is null, comes first
    order = [F.col("phrase").isNull().desc(), F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    few = found.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_r") <= top + 1)
    ranked = few.withColumn("_r", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("_r") <= top + 1)
    ranked = ranked.withColumn("n", F.max("n").over(Window.partitionBy("lang"))).where("phrase is not null")
    return ranked.select("lang", (F.col("_r") - 1).cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
