"""Benchmark decontamination with suffix arrays of the training texts.

Documents are cut into shards (slices of a partition). Each shard gets a
suffix array over word ids, ordered by the first ``window`` words, of the
suffixes that can matter: those whose first word (and second, for windows of
two words or more) starts some test suffix. Every test suffix is then found in
the shard by binary search; the range of equal suffixes gives the places of all
verbatim matches, which are extended word by word to the longest match.

The benchmark is the stated query set: it is read in blocks of at most
``BLOCK_BYTES``, and each block is checked against all documents in one narrow
pass. With one block nothing is shuffled; with more, the hits of a document
meet by its row key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.llm import ragged

BLOCK_BYTES = 8 << 20
SHARD_BYTES = 4 << 20


@dataclass
class TestSet:
    """Test suffixes of one block of benchmark items, as big-endian word ids."""

    vocabulary: np.ndarray  # sorted word hashes; id = place + 1, 0 = any other word
    words: np.ndarray  # ids of all items' words, one after the other, then `window` zeros
    start: np.ndarray  # of each test suffix in words
    length: np.ndarray  # words that must be equal
    item: np.ndarray  # its item's place in names
    room: np.ndarray  # words from start to the item's end
    pairs: np.ndarray  # sorted id pairs that begin a suffix of two words or more
    names: list[str | None]
    window: int

    @staticmethod
    def build(texts: pa.Array, names: list[str | None], window: int) -> TestSet:
        hashes, doc = ragged.words(*ragged.text_bytes(texts), ragged.ALNUM)
        vocabulary, ids = np.unique(hashes, return_inverse=True)
        ids = ids.astype(np.int64) + 1
        size = np.bincount(doc, minlength=len(names)) if len(names) else np.empty(0, np.int64)
        first = np.cumsum(size) - size
        start, item = [], []
        for i, (n, at) in enumerate(zip(size.tolist(), first.tolist(), strict=True)):
            k = max(n - window, 0) + 1 if n else 0
            start.append(np.arange(at, at + k))
            item.append(np.full(k, i))
        start = np.concatenate(start) if start else np.empty(0, np.int64)
        item = np.concatenate(item) if item else np.empty(0, np.int64)
        length = np.minimum(size[item], window) if len(item) else np.empty(0, np.int64)
        words = np.concatenate([ids, np.zeros(window, np.int64)])
        wide = length > 1
        pairs = np.unique(words[start[wide]] << 32 | words[start[wide] + 1]) if len(start) else np.empty(0, np.int64)
        room = first[item] + size[item] - start if len(item) else np.empty(0, np.int64)
        return TestSet(vocabulary, words, start, length, item, room, pairs, names, window)


def _keys(ids: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Fixed-width byte keys of the suffixes at `at`: they compare like their first `depth` ids."""
    return np.ascontiguousarray(ids[at[:, None] + np.arange(depth)].astype(">u4")).view(f"S{4 * depth}").ravel()


def _matches(hashes: np.ndarray, doc: np.ndarray, test: TestSet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(test suffix, word place, longest match in words) of all matches in a shard."""
    none = np.empty(0, np.int64)
    if not len(hashes) or not len(test.start):
        return none, none, none
    place = np.searchsorted(test.vocabulary, hashes)
    place = np.minimum(place, len(test.vocabulary) - 1)
    ids = np.where(test.vocabulary[place] == hashes, place + 1, 0)
    n, depth = len(ids), test.window
    # a suffix ends with its document: zeros after each document
    shift = np.arange(n) + (doc - doc[0]) * depth
    text = np.zeros(int(shift[-1]) + 1 + depth, np.int64)
    text[shift] = ids
    at = np.flatnonzero(text[:-depth])
    begins = np.zeros(len(at), dtype=bool)
    if len(test.pairs):
        pair = text[at] << 32 | text[at + 1]
        found = np.minimum(np.searchsorted(test.pairs, pair), len(test.pairs) - 1)
        begins = test.pairs[found] == pair
    single = np.unique(test.words[test.start[test.length == 1]])
    if len(single):
        begins |= np.isin(text[at], single)
    at = at[begins]
    if not len(at):
        return none, none, none
    keys = _keys(text, at, depth)
    order = np.argsort(keys, kind="stable")  # the shard's suffix array
    at, keys = at[order], keys[order]
    wanted = test.words[test.start[:, None] + np.arange(depth)]
    past = np.arange(depth) >= test.length[:, None]
    low = np.ascontiguousarray(np.where(past, 0, wanted).astype(">u4")).view(keys.dtype).ravel()
    high = np.ascontiguousarray(np.where(past, 0xFFFFFFFF, wanted).astype(">u4")).view(keys.dtype).ravel()
    lo = np.searchsorted(keys, low, side="left")
    hi = np.searchsorted(keys, high, side="right")
    count = hi - lo
    hit = np.flatnonzero(count)
    if not len(hit):
        return none, none, none
    count = count[hit]
    suffix = np.repeat(hit, count)
    where = at[np.repeat(lo[hit] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))]
    length = test.length[suffix].copy()
    open_ = np.flatnonzero(length < test.room[suffix])
    while len(open_):  # extend those whose next words are equal, too
        a = text[np.minimum(where[open_] + length[open_], len(text) - 1)]
        same = (a > 0) & (a == test.words[test.start[suffix[open_]] + length[open_]])
        length[open_[same]] += 1
        open_ = open_[same]
        open_ = open_[length[open_] < test.room[suffix[open_]]]
    back = np.full(len(text), -1, np.int64)
    back[shift] = np.arange(n)
    return suffix, back[where], length


def _blocks(items: DataFrame, window: int) -> Iterator[TestSet]:
    """The benchmark in blocks of about BLOCK_BYTES; each is bounded."""
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES) or 1
    for i in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()
        yield TestSet.build(pa.array([r.text for r in rows], pa.string()), [r.item_id for r in rows], window)


def _scan(docs: DataFrame, test: TestSet, keep: list[str]) -> DataFrame:
    """Per document: n_words, hits (pairs of word place and covered length) and items."""
    names = pa.array([x if x is not None else "" for x in test.names], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = ragged.text_bytes(b.column("text"))
            for lo, hi in ragged.slices(offsets, SHARD_BYTES):
                hashes, doc = ragged.words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], ragged.ALNUM)
                n = hi - lo
                size = np.bincount(doc, minlength=n)
                first = np.cumsum(size) - size
                suffix, place, longest = _matches(hashes, doc, test)
                owner = doc[place]
                spans: list = [[] for _ in range(n)]
                items: list = [[] for _ in range(n)]
                for d in np.unique(owner).tolist():
                    mine = owner == d if len(owner) < 4096 else np.flatnonzero(owner == d)
                    got = np.unique(np.stack([place[mine] - first[d], test.length[suffix[mine]], longest[mine]]), axis=1)
                    spans[d] = [{"place": int(p), "words": int(w), "longest": int(x)} for p, w, x in got.T]
                    items[d] = names.take(pa.array(np.unique(test.item[suffix[mine]]))).to_pylist()
                yield pa.RecordBatch.from_arrays([
                    *(b.column(c).slice(lo, n) for c in keep), pa.array(size.astype(np.int64)),
                    pa.array(spans, pa.list_(pa.struct([("place", pa.int64()), ("words", pa.int64()), ("longest", pa.int64())]))),
                    pa.array(items, pa.list_(pa.string())),
                ], names=[*keep, "n_words", "spans", "items"])

    schema = T.StructType([docs.schema[c] for c in keep]).add("n_words", T.LongType())
    span = T.StructType().add("place", T.LongType()).add("words", T.LongType()).add("longest", T.LongType())
    schema = schema.add("spans", T.ArrayType(span)).add("items", T.ArrayType(T.StringType()))
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def _covered(spans: str) -> Column:
    """Words under any span; spans are sorted by place."""
    end = lambda x: x["place"] + x["words"]
    zero = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("end"))
    return F.aggregate(spans, zero, lambda a, x: F.struct(
        (a["total"] + F.greatest(F.lit(0), end(x) - F.greatest(a["end"], x["place"]))).cast("bigint").alias("total"),
        F.greatest(a["end"], end(x)).cast("bigint").alias("end")), lambda a: a["total"])


def contamination(docs: DataFrame, items: DataFrame, *, window: int = 10, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default doc_id) plus n_words, spans
    (place, words and longest verbatim match of every match, in words), items
    (sorted names of the items met), n_hit (words inside a match) and
    contaminated, one row per row of ``docs`` (doc_id, text).

    ``items`` has item_id and text. A test suffix is ``window`` consecutive
    words of an item, or a whole shorter item. Words are runs of digits, ASCII
    letters and non-ASCII characters, in lower case (A-Z). Null and empty texts
    have no words and match nothing; a null item_id is named ''. Repeated rows
    on either side change nothing but their own row. No benchmark: no hit."""
    keep = ["doc_id"] if keep is None else keep
    taken = {"n_words", "spans", "items", "n_hit", "contaminated"}
    keep = [c for c in keep if c not in taken]
    blocks = list(_blocks(items, window))
    if len(blocks) == 1:
        out = _scan(docs, blocks[0], keep)
    else:  # every block against all documents, met by a key of the row
        keyed = docs.withColumn("_row", F.struct(*(F.col(c) for c in keep), F.xxhash64("text"), F.length("text")))
        parts = None
        for test in blocks:
            part = _scan(keyed, test, ["_row"])
            parts = part if parts is None else parts.unionByName(part)
        merged = parts.groupBy("_row").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_set("spans")).alias("spans"), F.flatten(F.collect_set("items")).alias("items"), (F.count("*") / len(blocks)).cast("int").alias("_n"))
        out = merged.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_n"))).select(*(F.col(f"_row.{c}").alias(c) for c in keep), "n_words", "spans", "items")
    return out.select(*keep, "n_words", F.array_sort(F.array_distinct("spans")).alias("spans"), F.array_sort(F.array_distinct("items")).alias("items")) \
        .withColumn("n_hit", _covered("spans")).withColumn("contaminated", F.col("n_hit") > 0)


def remove_contaminated(docs: DataFrame, items: DataFrame, *, window: int = 10) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage; what stays keeps
    all its columns, whatever their names."""
    columns = docs.columns
    named = {c: f"_in{i}" for i, c in enumerate(columns) if c != "text"}
    rows = docs.select("text", *[F.col(c).alias(n) for c, n in named.items()])
    found = contamination(rows, items, window=window, keep=["text", *named.values()]).where(~F.col("contaminated"))
    return found.select(*[F.col(named.get(c, c)).alias(c) for c in columns])
