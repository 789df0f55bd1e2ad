"""MIL toxicity: held-out quality, sentence location, odd rows."""

import pyarrow as pa

from tabula.llm import ragged, toxicity
from tabula.llm.queries import QUERIES


def test_query_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op1_noisy_or_toxicity"](spark, sf)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and dict(got.dtypes)["predicted"] == "int"
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    hit = sum(r.predicted == 1 and r.toxic == 1 for r in rows)
    assert hit / sum(r.toxic for r in rows) > 0.75 and hit / max(1, sum(r.predicted for r in rows)) > 0.85
    assert all(0 <= r.score <= 1 for r in rows)


def fixture(spark):
    texts = [(i, f"A calm day number {i} begins over the hills. The sea was quiet and the wind was low. We went home.", 0) for i in range(60)]
    texts += [(100 + i, f"A calm day number {i} begins over the hills. You vile wretch of a man go away now. We went home.", 1) for i in range(30)]
    texts += [(200, None, 0), (201, "", 0), (202, "... !!!", 0), (300, "quiet " * 30000, 0)]
    d = spark.createDataFrame(texts, "doc_id bigint, text string, label int")
    return d.withColumnRenamed("label", "score"), d.selectExpr("doc_id", "label as toxic").unionAll(spark.sql("select null, 1 union all select 5, null"))


def test_locates_sentences(spark):
    d, labels = fixture(spark)
    model = toxicity.fit(d, labels)
    by = {r.doc_id: r for r in toxicity.score(d, model).collect()}
    assert all(by[i].score < 0.3 and not by[i].offending for i in range(60))
    assert all(by[100 + i].score > 0.7 for i in range(30))
    assert abs(by[200].score - toxicity.LEAK) < 1e-9 and by[200].score == by[201].score == by[202].score and by[300].score < 0.3
    found = {(r.doc_id, r.text) for r in toxicity.offending_sentences(d, model).collect()}
    assert found == {(100 + i, "You vile wretch of a man go away now") for i in range(30)}


def test_empty_and_unlabelled(spark):
    d, labels = fixture(spark)
    model = toxicity.fit(d, labels.where("false"))
    assert toxicity.score(d.where("false"), model).count() == 0
    got = toxicity.score(d.unionAll(d.where("doc_id = 1")).unionAll(spark.sql("select null, 'x', 1")), model, ["doc_id", "text"])
    assert got.columns == ["doc_id", "text", "score", "offending"] and got.count() == d.count() + 2
    assert all(abs(r.score - toxicity.LEAK) < 1e-9 for r in got.collect())


def test_sentence_bounds():
    texts = ["One two three four five six seven eight. Three!\nFour " + "w " * 9 + "x. End", "", "É x? " + "w " * 100]
    found = toxicity.sentences(*ragged.text_bytes(pa.array(texts)))
    spans = [(d, texts[d].encode()[a:b].decode()) for d, a, b in zip(found.doc, found.start, found.end, strict=True)]
    assert spans[:3] == [(0, "One two three four five six seven eight"), (0, "Three!\nFour " + "w " * 9 + "x"), (0, "End")]
    assert [d for d, _ in spans[3:]] == [2, 2, 2] and spans[3][1].startswith("É x? w")
