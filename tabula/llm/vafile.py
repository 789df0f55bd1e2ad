"""Exact top-k inner-product search with vector-approximation files.

The vectors are dealt into blocks. Each block stores, next to the exact
vectors, one cell number per component (``2 ** bits`` cells with about equally
many values in a block) and the least and largest value of every cell. A query
scans the small approximations first: the cells bound every inner product from
below and above. Vectors whose upper bound is under the k-th best lower bound
are out; the exact vectors of the others are read in the order of their bounds
until the k-th exact score is above every remaining bound, so the answer is
certain.

The queries are a stated set against all rows: they are cut into chunks, each
pair of (block, chunk) meets in one task, and sends k rows per query on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 8192
CHUNK_ROWS = 4096


def usable(vec: str) -> Column:
    """A vector without null or non-finite components (a null one is not)."""
    x = F.col(vec)
    ok = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return F.coalesce(x.isNotNull() & (F.size(x) > 0) & F.forall(x, ok), F.lit(False))


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    """Rows of equal length as a matrix of whole numbers."""
    values = table.column(column).combine_chunks()
    values = values.flatten() if isinstance(values, pa.ListArray) else pa.concat_arrays([c.flatten() for c in values.chunks])
    return values.to_numpy(zero_copy_only=False).astype(np.int64).reshape(table.num_rows, -1)


def build(vectors: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cells, least, largest): cell numbers by row and component, and the
    bounds of every component's cells."""
    n, d = vectors.shape
    levels = 1 << bits
    cells = np.empty((n, d), np.uint8)
    least, largest = np.zeros((d, levels)), np.zeros((d, levels))
    for j in range(d):
        v = np.sort(vectors[:, j])
        marks = np.unique(v[(np.arange(1, levels) * n) // levels])  # cell = marks at or below
        c = np.searchsorted(marks, vectors[:, j], side="right")
        cells[:, j] = c
        at = np.searchsorted(v, marks, side="left")
        starts, ends = np.concatenate([[0], at]), np.concatenate([at, [n]])
        filled = starts < ends
        least[j, :len(starts)][filled] = v[starts[filled]]
        largest[j, :len(starts)][filled] = v[ends[filled] - 1]
    return cells, least, largest


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles where these are exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[-1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vector id, score): the k best of the block for every query,
    ties to the smaller id; a query's own id is left out."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    cells, least, largest = build(vectors, bits)
    column = np.arange(vectors.shape[1])
    low, high = least[column, cells], largest[column, cells]
    centre, half = (low + high) / 2, (high - low) / 2
    out: list[list[np.ndarray]] = [[], [], []]
    for at in range(0, len(queries), 64):
        q = queries[at:at + 64]
        mid, spread = q.astype(np.float64) @ centre.T, np.abs(q).astype(np.float64) @ half.T
        # rounding of sums beyond 2**53 is covered by one part in 2**40
        slack = (np.abs(mid).max(initial=0) + spread.max(initial=0)) / 2**40 if max(np.abs(mid).max(initial=0), spread.max(initial=0)) > 2**50 else 0.0
        upper, lower = mid + spread + slack, mid - spread - slack
        for i, own in enumerate(query_ids[at:at + 64]):
            mine = ids == own
            lo = np.where(mine, -np.inf, lower[i])
            left = len(ids) - int(mine.sum())
            if not left:
                continue
            floor = np.partition(lo, len(lo) - k)[len(lo) - k] if left > k else -np.inf
            rest = np.flatnonzero((upper[i] >= floor) & ~mine)
            rest = rest[np.argsort(-upper[i][rest], kind="stable")]
            scores, read, step = np.empty(0, np.int64), 0, 4 * k
            while read < len(rest):
                scores = np.concatenate([scores, _dot(q[i:i + 1], vectors[rest[read:read + step]])[0]])
                read, step = read + step, step * 2
                if read < len(rest) and len(scores) >= k and np.partition(scores, len(scores) - k)[len(scores) - k] > upper[i][rest[read]]:
                    break
            rest = rest[:len(scores)]
            best = np.lexsort((ids[rest], -scores))[:k]
            out[0].append(np.full(len(best), own))
            out[1].append(ids[rest[best]])
            out[2].append(scores[best])
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in out)


def search(vectors: DataFrame, queries: DataFrame, *, k: int = 10, bits: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` largest integer inner
    products of every query with the rows of ``vectors``, exact, ties to the
    smaller vec_id. Both have vec_id and vec (array of whole numbers).

    A row with the query's own vec_id is no candidate. Rows with a null id, a
    null or empty vector or a null component take no part; vectors meet only
    queries of their own length. Repeated rows of ``vectors`` are candidates
    each; of a repeated query id the smallest vector counts. Fewer than k
    candidates give fewer rows, an empty side none."""
    ok = (F.col("vec_id").isNotNull()) & F.coalesce((F.size("vec") > 0) & F.forall("vec", lambda x: x.isNotNull()), F.lit(False))
    to = F.transform("vec", lambda x: x.cast("bigint"))
    vectors = vectors.where(ok).select(F.col("vec_id").cast("bigint"), to.alias("vec"))
    queries = queries.where(ok).select(F.col("vec_id").cast("bigint"), to.alias("vec")).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    n, m = vectors.count(), queries.count()
    blocks, chunks = max(1, -(-n // BLOCK_ROWS)), max(1, -(-m // CHUNK_ROWS))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    # block numbers run over the rows, not the ids, so repeated ids spread
    vectors = vectors.withColumns({"block": F.pmod(F.xxhash64("vec_id", "vec"), F.lit(blocks)).cast("int"), "chunk": every(chunks)})
    queries = queries.withColumns({"chunk": F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int"), "block": every(blocks)})

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        lengths = [np.asarray(pc.list_value_length(t.column("vec")).to_numpy()) for t in (left, right)]
        for d in np.unique(lengths[1]).tolist():
            a, b = left.filter(pa.array(lengths[0] == d)), right.filter(pa.array(lengths[1] == d))
            if a.num_rows and b.num_rows:
                got = search_block(a.column("vec_id").to_numpy(), _matrix(a, "vec"), b.column("vec_id").to_numpy(), _matrix(b, "vec"), k, bits)
                for x, y in zip(out, got, strict=True):
                    x.append(y)
        cols = [pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64()) for x in out]
        return pa.table(cols, names=["query_id", "vec_id", "score"])

    found = vectors.groupBy("block", "chunk").cogroup(queries.groupBy("block", "chunk")).applyInArrow(meet, "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
