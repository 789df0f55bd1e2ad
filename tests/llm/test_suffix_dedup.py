"""Depth-limited radix dedup against all windows, byte by byte."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tabula.llm import ragged, suffix_dedup
from tabula.llm.queries import QUERIES


def brute(docs, length):
    first = {}
    last = 2**63 - 1
    for i, text in docs:
        b = (text or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            first[w] = min(first.get(w, last), last if i is None else i)
    out = []
    for i, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < (last if i is None else i):
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, docs, length, **how):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("doc_id", "text", "1 as block", "'x' as kept", "2 as answer")
    got = suffix_dedup.repeated(d, length=length, **how).collect()
    for r in got:
        assert r.n_removed == sum(s.end - s.start for s in r.spans)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got), key=str)


@pytest.mark.parametrize("alphabet,length,seed", [("ab", 50, 1), ("abcdefgh é", 38, 2), ("the of and ", 50, 3), ("xyz", 100, 4)])
def test_random_copies(spark, alphabet, length, seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    passages = [text(rng.randrange(20, 160)) for _ in range(6)]
    docs = []
    for i in range(60):
        parts = [rng.choice(passages)[rng.randrange(0, 9):] if rng.random() < 0.5 else text(rng.randrange(0, 90)) for _ in range(rng.randrange(0, 5))]
        docs.append((rng.randrange(40) if rng.random() < 0.9 else None, "".join(parts)))
    docs += docs[:3] + [(7, None), (8, ""), (100, "ab" * 400), (101, "ab" * 90 + "c" + "ab" * 90), (102, "q" * 300), (3, "q" * 60), (103, "\0" * 120), (104, "\0" * 70 + "x")]
    assert run(spark, docs, length) == brute(docs, length)


@pytest.mark.parametrize("hot", [2, 30, 10**6])
def test_hot_passage_is_divided(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 4000)  # read on the driver
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdef") for _ in range(140))
    docs = [(i, passage[rng.randrange(3):] + str(i) * 30 + passage[:rng.randrange(40, 140)]) for i in range(120)]
    docs += [(i, "".join(rng.choice("xyz") for _ in range(rng.randrange(40))) + passage[40:75] + "".join(rng.choice("xyz") for _ in range(rng.randrange(40)))) for i in range(200, 400)]
    assert run(spark, docs, 50, hot=hot) == brute(docs, 50)


def test_chunks_and_slices(monkeypatch):
    """In one process, so that the small sizes hold."""
    rng = random.Random(4)
    passage = "".join(rng.choice("ab") for _ in range(200))
    rows = [{"block": 0, "doc_id": i, "text": passage[rng.randrange(99):][:rng.randrange(150)] + "".join(rng.choice("ab") for _ in range(rng.randrange(200)))} for i in range(60)]
    wanted = suffix_dedup.Block(pa.Table.from_pylist(rows), 50)
    wanted.entries(np.ones(len(wanted.keys), np.int64))
    found = suffix_dedup._masks(wanted.rows, wanted.least, 50)
    monkeypatch.setattr(suffix_dedup, "SLICE", 16)
    assert (suffix_dedup._masks(wanted.rows, wanted.least, 50) == found).all() and found.any()
    small = suffix_dedup.Block(pa.Table.from_pylist(rows), 50)
    small.entries(np.ones(len(small.keys), np.int64))
    assert (small.rows == wanted.rows).all() and (small.entry_of == wanted.entry_of).all()
    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)
    chunks = suffix_dedup.Block(pa.Table.from_pylist(rows), 50)
    covered = lambda b: sorted(w for f, e in zip(b.first.tolist(), b.last.tolist(), strict=True) for w in range(f, e + 1))
    assert covered(chunks) == covered(suffix_dedup.Block(pa.Table.from_pylist(rows), 50))



def test_empty(spark):
    assert run(spark, [], 50) == []
    with pytest.raises(ValueError):
        suffix_dedup.repeated(spark.createDataFrame([], "doc_id bigint, text string"), length=20)


def test_radix_groups():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 2, (500, 11), dtype=np.uint8)
    group = ragged.radix_groups(rows)
    by = {}
    for r, g in zip(rows, group.tolist(), strict=True):
        assert by.setdefault(r.tobytes(), g) == g
    assert len(set(by.values())) == len(by)


def test_text_after_cut(spark):
    line = "é" * 40 + "0123456789" * 4
    d = spark.createDataFrame([(1, line, 1), (2, "a" + line + "b", 2), (3, None, 3), (4, "", 4)], "doc_id bigint, text string, n_bytes int")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(d.withColumnRenamed("n_bytes", "extra")).collect()}
    assert got[1].text == line and got[2].text == "ab" and got[3].text is None and got[4].text == "" and got[2].extra == 2


def test_query(spark, small_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    got = QUERIES["op9_radix_suffix_dedup"](spark, small_dir).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, 50) and sum(r.n_removed for r in got) > 1000
