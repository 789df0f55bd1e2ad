"""Lookups between blocks of documents and buckets of keys.

Many operators need, for every key (a word, a shingle, a passage) of every
document, something that only all documents together know: its count, or
whether another document has it. A shuffle row per occurrence would cost many
times the input. Instead documents are dealt into blocks; a block sends each of
its distinct keys once, as plain numbers in one binary value per bucket of keys
(so a key that a third of all documents hold is pre-aggregated to one entry per
block); a bucket answers in the same order; and the answers return to their
block. Blocks and buckets follow ``spark.sql.shuffle.partitions`` and so have a
bounded size at every input size.

All numbers sent depend on the contents of a block alone, not on the order of
its rows, so a task that runs again sends the same.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAST = np.iinfo(np.int64).max


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lean(fn: Callable) -> Callable:
    """``fn`` of one or two tables, after which the worker hands unused memory
    back. Workers outlive their task, wait for the next stage's, and share an
    executor's memory; without this each keeps the most it ever needed."""
    def done(out):
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass
        return out
    if fn.__code__.co_argcount == 1:
        return lambda table: done(fn(table))
    return lambda left, right: done(fn(left, right))


def count_for(docs: DataFrame, size: int) -> int:
    """How many blocks of about ``size`` bytes the texts of ``docs`` make (one
    scan of their lengths)."""
    return max(1, -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // size))


def blocked(docs: DataFrame, keep: list[str], per_partition: int = 3, count: int | None = None) -> DataFrame:
    """The columns ``keep`` and text of ``docs``, plus block, of ``count``
    blocks. Rows are dealt by id and text, so neither a hot source nor a
    repeated id fills a block."""
    n = count or per_partition * partitions(docs.sparkSession)
    cols = [c for c in dict.fromkeys([*keep, "text"]) if c != "block"]
    return docs.select(*cols, F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("block"))


def doc_ids(table: pa.Table) -> np.ndarray:
    """doc_id as int64; a null id sorts after all others."""
    return table.column("doc_id").cast(pa.int64()).fill_null(LAST).to_numpy()


def bucket_cuts(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket numbers that occur, their starts and the end) of sorted uint64 keys."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    used, starts = np.unique(bucket.astype(np.int64), return_index=True)
    return used, np.append(starts, len(keys))


def binary(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """data[cuts[i]:cuts[i + 1]] as the bytes of row i."""
    data = np.ascontiguousarray(data)
    item = data.itemsize * int(np.prod(data.shape[1:], initial=1))
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * item).astype(np.int64)), pa.py_buffer(data.tobytes())]).cast(pa.binary())


def numbers(column: pa.ChunkedArray, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """(all values, count by row) of a column of binary numbers."""
    rows = column.to_pylist()
    values = np.frombuffer(b"".join(rows), dtype)
    size = np.dtype(dtype).itemsize
    return values, np.array([len(r) // size for r in rows], np.int64)


def bits(column: pa.ChunkedArray, counts: np.ndarray) -> np.ndarray:
    """Packed booleans of all rows, counts[i] in row i."""
    rows = column.to_pylist()
    return np.concatenate([np.unpackbits(np.frombuffer(r, np.uint8), count=c) for r, c in zip(rows, counts.tolist(), strict=True)]).astype(bool) if rows else np.empty(0, bool)


def pack_bits(flags: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.array([np.packbits(flags[a:b]).tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)], pa.binary())


SENT = "bucket int, block int, keys binary, extra binary"
ANSWER = "bucket int, block int, answer binary"


def send(block: int, keys: np.ndarray, buckets: int, low: bool, extra: Callable[[np.ndarray], pa.Array]) -> pa.Table:
    """Rows of SENT for sorted, distinct keys: the keys (``low``: their low 32
    bits, for lookups that may confuse keys) and ``extra(cuts)``."""
    used, cuts = bucket_cuts(keys, buckets)
    numbers_ = (keys & np.uint64(0xFFFFFFFF)).astype("<u4") if low else keys.astype("<u8")
    return pa.table([pa.array(used, pa.int32()), pa.array(np.full(len(used), block), pa.int32()), binary(numbers_, cuts), extra(cuts)], names=["bucket", "block", "keys", "extra"])


def answers(table: pa.Table, dtype: str) -> np.ndarray:
    """The answers to a block, in the order of its sorted keys."""
    if not table.num_rows:
        return np.empty(0, dtype)
    table = table.sort_by("bucket")
    return np.frombuffer(b"".join(table.column("answer").to_pylist()), dtype)


def answer_bits(table: pa.Table, keys: np.ndarray, buckets: int) -> np.ndarray:
    if not table.num_rows:
        return np.empty(0, bool)
    _, cuts = bucket_cuts(keys, buckets)
    return bits(table.sort_by("bucket").column("answer"), np.diff(cuts))


def block_of(table: pa.Table) -> int:
    return table.column("block")[0].as_py()


def lookup(blocks: DataFrame, sender: Callable[[pa.Table], pa.Table], answer: Callable[[pa.Table], pa.Array]) -> DataFrame:
    """Rows of ANSWER: ``sender`` makes rows of SENT from a block of documents,
    ``answer`` one value per row from all rows of a bucket."""
    def reply(table: pa.Table) -> pa.Table:
        return pa.table([table.column("bucket"), table.column("block"), answer(table)], names=["bucket", "block", "answer"])
    return blocks.groupBy("block").applyInArrow(sender, SENT).groupBy("bucket").applyInArrow(reply, ANSWER)
