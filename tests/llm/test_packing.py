"""Power-of-two packing: pieces against whole-text encoding."""

import zlib

import numpy as np
import pytest

from tabula.llm import packing
from tabula.llm.queries import QUERIES, tokenizer_path

ODD = ["", None, "a", " ", "  a  b ", "x\n\n y\t z", "it's  we'll  go", "　 a  b \u0085 c", "é è  ç 12 345 !!?? ..", "日本語 テキスト 🎉 ok",
       "<|endoftext|> a <|endoftext|>", "w " * 3000, "long" * 5000, " \n \n ", "a\x1c b\x1f c", "dup text", "dup text", "é ́ x"]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, texts, whole, longest):
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    for i, text in texts.items():
        ids, got = whole(text), sorted(by[i], key=lambda r: r["start"])
        assert [i for r in got for i in np.frombuffer(r["ids"], "<u4").tolist()] == ids
        assert [r["length"] for r in got] == packing.lengths_of(len(ids), longest)
        assert all(r["length"] & (r["length"] - 1) == 0 and r["offset"] == 0 and 1 << r["bucket"] == r["length"] for r in got)
        assert {r["doc_tokens"] for r in got} == {len(ids)}
        assert [r["start"] for r in got] == [sum(x["length"] for x in got[:k]) for k in range(len(got))]


@pytest.mark.parametrize("longest", [2048, 4])
def test_odd_texts(spark, whole, longest):
    texts = dict(enumerate(ODD))
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in texts.items()], "doc_id bigint, text string, ids string, length int")
    check([r.asDict() for r in packing.pack(df, tokenizer_path(), max_length=longest).collect()], texts, whole, longest)


def test_null_and_repeated_ids(spark, whole):
    df = spark.createDataFrame([(None, "a b"), (3, "x"), (3, "x")], "doc_id bigint, text string")
    got = packing.pack(df, tokenizer_path()).collect()
    assert sorted((r.doc_id is None, r.length) for r in got) == [(False, 2), (False, 2), (True, 1), (True, 2)]


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, text string"), tokenizer_path()).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([], "doc_id bigint, text string"), tokenizer_path(), max_length=3)


def test_query(spark, small_dir, whole):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    got = QUERIES["op6_power_of_two_packing"](spark, small_dir).collect()
    assert {r.doc_id for r in got} == set(docs)
    for r in got:
        part = np.array(whole(docs[r.doc_id])[r.start:r.start + r.length], "<u4")
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32


def test_buckets_on_disk(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b c d e"), (2, "f")], "doc_id bigint, text string")
    packing.write_buckets(packing.pack(df, tokenizer_path()), str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert all(1 << r.bucket == r.length for r in back.collect()) and back.count() == 3


def test_query_and_pipeline_encode_special_tokens_as_the_file_does(spark, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline
    plain = Tokenizer.from_file(tokenizer_path())
    texts = dict(enumerate([*(t for t in ODD if t), "end <|endoftext|> of", "a  <|endoftext|>  b", "x<|endoftext|>y <|endoftext|><|endoftext|>"]))
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    ids = {i: np.array([*plain.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in texts.items()}
    assert ids[len(texts) - 3].tolist() == [437, 220, 50256, 286, 1]
    for r in QUERIES["op6_power_of_two_packing"](spark, str(tmp_path)).collect():
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())
    for r in corpus_pipeline.pack_sequences(spark, df, str(tmp_path)).collect():
        assert r.ids == ids[r.doc_id][r.start:r.start + r.length].tobytes()
