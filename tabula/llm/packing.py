"""Sequence packing by power-of-two decomposition.

Each document's token ids (with an end id) are split into pieces whose lengths
are the binary decomposition of its token count: as many pieces of the maximum
length as fit, then one piece for each set bit of the rest. A piece is a whole
sequence, pieces of equal length share a bucket, so a batch drawn from one
bucket needs no padding and no sequence holds two documents.

One narrow pass, no shuffle. Byte-level BPE splits a text before every blank
that follows a visible character, so a slice of documents is cut there, each
distinct segment is encoded once, and the ids are gathered back; the cache of
encoded segments is bounded by ``CACHE_SEGMENTS`` and emptied beyond it.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.llm import ragged

CACHE_SEGMENTS = 1 << 20
SLICE_BYTES = 2 << 20


def lengths_of(n: int, longest: int) -> list[int]:
    """Piece lengths of a document of n ids, longest first; ``longest`` is a
    power of two."""
    out = [longest] * (n // longest)
    rest = n % longest
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Segment starts: document starts, and blanks right after a visible
    character (no Unicode space either)."""
    n = len(data)
    cut = np.zeros(n + 1, dtype=bool)
    if n > 1:
        cut[1:n] = (data[1:] == 32) & (data[:-1] > 32)
        if data.max() >= 0x80:  # U+0085, U+00A0, U+1680, U+2000.., U+3000 end in 0x80 to 0xAF
            at = np.flatnonzero(cut[1:n] & (data[:-1] >= 0x80)) + 1
            two = data[np.maximum(at - 2, 0)]
            last = data[at - 1]
            three = data[np.maximum(at - 3, 0)]
            space = (two == 0xC2) & ((last == 0x85) | (last == 0xA0)) | (three >= 0xE1) & (three <= 0xE3)
            cut[at[space]] = False
    cut[offsets] = True
    return np.flatnonzero(cut[:n])


class Encoder:
    """Token ids of texts, exactly those of the tokenizer file on whole texts.
    ``special``: the string of a special token in a text is that token, as the
    file has it by default; else it is ordinary text."""

    def __init__(self, path: str, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.segmented = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and not spec.get("normalizer")
                          and spec["model"]["type"] == "BPE" and not spec["model"].get("end_of_word_suffix")
                          and not any(" " in t["content"] or t["single_word"] or t["lstrip"] or t["rstrip"]
                                      for t in spec.get("added_tokens") or [] if special or not t["special"]))
        self._reset()

    def _reset(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.place = np.empty((2, 0), np.int64)  # start and length in ids
        self.ids = np.empty(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [e.ids for e in batch(texts, add_special_tokens=False)]

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts by document)."""
        n = len(offsets) - 1
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(n, np.int64)
        if not self.segmented:
            raw = data.tobytes()
            got = self._encode([raw[a:b].decode("utf-8") for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
            return np.fromiter((i for g in got for i in g), np.uint32), np.array([len(g) for g in got], np.int64)
        starts = _cuts(data, offsets)
        ends = np.append(starts[1:], len(data))
        keys, first, inverse = np.unique(ragged.hash_runs(data, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        if not known.all():
            if len(self.keys) > CACHE_SEGMENTS:
                self._reset()
                known[:] = False
            new = np.flatnonzero(~known)
            raw = data.tobytes()
            got = self._encode([raw[starts[i]:ends[i]].decode("utf-8") for i in first[new]])
            size = np.array([len(g) for g in got], np.int64)
            start = len(self.ids) + np.cumsum(size) - size
            self.ids = np.concatenate([self.ids, np.fromiter((i for g in got for i in g), np.uint32, count=int(size.sum()))])
            every = np.concatenate([self.keys, keys[new]])
            order = np.argsort(every, kind="stable")
            self.keys = every[order]
            self.place = np.concatenate([self.place, np.stack([start, size])], axis=1)[:, order]
            at = np.searchsorted(self.keys, keys)
        start, size = self.place[:, at[inverse]]
        total = np.cumsum(size)
        ids = self.ids[np.repeat(start - (total - size), size) + np.arange(int(total[-1]))]
        doc = np.searchsorted(offsets, starts, side="right") - 1
        return ids, np.bincount(doc, weights=size, minlength=n).astype(np.int64)


_encoders: dict[tuple[str, bool], Encoder] = {}


def pack(docs: DataFrame, tokenizer: str, *, max_length: int = 2048, end_id: int = 1, special: bool = False) -> DataFrame:
    """One row per piece of every document of ``docs`` (doc_id, text; other
    columns are ignored): doc_id, start (the document's ids before it), length
    (a power of two, at most ``max_length``, itself a power of two), ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset (0: a
    piece fills its sequence) and bucket (log2 of the length).

    A null or empty text has just the end id, so every row gives at least one
    piece; repeated rows and null ids are packed row by row. ``tokenizer`` is
    the path of a tokenizers JSON file that every executor can read; with
    ``special`` the strings of its special tokens in a text become those tokens
    (the file's own way), without it they are ordinary text."""
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get((tokenizer, special)) or _encoders.setdefault((tokenizer, special), Encoder(tokenizer, special))
        for b in batches:
            data, offsets = ragged.text_bytes(b.column("text"))
            for lo, hi in ragged.slices(offsets, SLICE_BYTES):
                part = data[offsets[lo]:offsets[hi]]
                ids, counts = encoder(part, offsets[lo:hi + 1] - offsets[lo])
                total = counts + 1
                first = np.cumsum(total) - total
                stream = np.full(int(total.sum()), end_id, np.uint32)
                keep = np.ones(len(stream), dtype=bool)
                keep[first + counts] = False
                stream[keep] = ids
                sizes = [lengths_of(n, max_length) for n in total.tolist()]
                pieces = np.array([len(x) for x in sizes], np.int64)
                length = np.array([x for each in sizes for x in each], np.int64)
                ends = np.cumsum(length)  # documents lie in the stream without gaps
                owner = np.repeat(np.arange(lo, hi), pieces)
                buffer = pa.py_buffer(stream.astype("<u4", copy=False))
                cut = pa.py_buffer(np.concatenate([[0], ends * 4]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").take(pa.array(owner)), pa.array(ends - length - np.repeat(first, pieces)), pa.array(length),
                    pa.Array.from_buffers(pa.binary(), len(length), [None, cut, buffer]), pa.array(np.repeat(total, pieces)),
                ], names=["doc_id", "start", "length", "ids", "doc_tokens"])

    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType())])
    out = docs.select("doc_id", "text").mapInArrow(run, schema)
    return out.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint"),
                            "bucket": F.log2("length").cast("int")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the sequences with one folder per length, so that a trainer reads
    batches of one length."""
    pieces.write.mode("overwrite").partitionBy("bucket").parquet(path)
