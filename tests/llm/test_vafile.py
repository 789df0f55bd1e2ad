"""VA-file search against brute force."""

import numpy as np
import pytest

from tabula.llm import vafile
from tabula.llm.queries import QUERIES


def brute(rows, queries, k):
    out = []
    for q, v in queries:
        s = sorted((-int(np.dot(np.array(v, object), np.array(x, object))), i) for i, x in rows if i != q and len(x) == len(v))
        out += [(q, r + 1, i, -m) for r, (m, i) in enumerate(s[:k])]
    return sorted(out)


@pytest.mark.parametrize("spread,block", [(3, 8192), (1000, 50), (2**30, 8192)])
def test_ties_and_blocks(spark, monkeypatch, spread, block):
    monkeypatch.setattr(vafile, "BLOCK_ROWS", block)
    monkeypatch.setattr(vafile, "CHUNK_ROWS", 5)
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.integers(-spread, spread + 1, 4).tolist()) for i in range(-20, 230)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]
    v = spark.createDataFrame(rows, "vec_id bigint, vec array<bigint>")
    q = v.where("vec_id % 10 = 0")
    got = sorted(tuple(r) for r in vafile.search(v, q, k=7).collect())
    assert got == brute(rows, [r for r in rows if r[0] % 10 == 0], 7)


def test_odd_rows(spark):
    rows = [(1, [1, 2]), (2, None), (3, []), (4, [1, None]), (None, [5, 5]), (5, [3, 1]), (5, [3, 1]), (6, [1, 1, 1])]
    v = spark.createDataFrame(rows, "vec_id bigint, vec array<bigint>").selectExpr("vec_id", "vec", "1 as rank", "2 as block")
    got = sorted(tuple(r) for r in vafile.search(v, v, k=3).collect())
    assert got == [(1, 1, 5, 5), (1, 2, 5, 5), (5, 1, 1, 5)]
    assert vafile.search(v.where("false"), v).count() == 0 and vafile.search(v, v.where("false")).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op4_va_file_top_k"](spark, sf)
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    rows = [(r.vec_id, np.floor(np.array(r.embedding, np.float64) * 1024).astype(int).tolist()) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()
            if r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding)]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, [r for r in rows if r[0] % 100 == 0], 10)


def test_unusable_vectors(spark):
    inf, nan = float("inf"), float("nan")
    d = spark.createDataFrame([(1, [1.0]), (2, [nan]), (3, [-inf]), (4, [None]), (5, None), (6, [])], "vec_id bigint, e array<float>")
    assert [r.vec_id for r in d.where(vafile.usable("e")).collect()] == [1]
