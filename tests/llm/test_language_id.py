"""Language ID by compression: held-out accuracy and defined odd cases."""

import dataclasses
import random

from pyspark.sql import functions as F

from tabula.llm import language_id
from tabula.llm.queries import QUERIES, fold


def test_query_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op8_compression_language_id"](spark, sf)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 200 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97


def test_odd_rows(spark):
    rows = [(i, "the quick brown fox jumps over the lazy dog and runs away", "en", 0.5) for i in range(30)]
    rows += [(100 + i, "der schnelle braune Fuchs springt über den faulen Hund hinweg", "de", 0.5) for i in range(30)]
    rows += [(200, None, "en", None), (201, "", "de", None), (202, "123 --- 456", None, None), (203, "Der Hund", None, None), (None, "the lazy dog runs away and the brown fox jumps", "en", None), (203, "Der Hund", None, None)]
    rows += [(204, "the lazy dog " * 50000, None, None)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double")
    model = language_id.fit(d, where=~fold(4))
    assert model.languages == ("de", "en")
    got = language_id.predict(d, model)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score", "margin", "rejected"] and got.count() == len(rows)
    by = {r.doc_id: r for r in got.collect()}
    assert [by[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3 and all(by[i].rejected and by[i].score == 0 for i in (200, 201, 202))
    assert by[203].lang_pred == "de" and by[None].lang_pred == "en" and by[204].lang_pred == "en" and not by[204].rejected


def test_narrow_margin_is_rejected(spark):
    d = spark.createDataFrame([(1, "abc", "x"), (2, "abc", "y")], "doc_id bigint, text string, lang string")
    r = language_id.predict(d, language_id.fit(d)).first()
    assert r.rejected and r.margin == 0 and r.lang_pred == "x"


def test_no_labels_and_empty(spark):
    d = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    model = language_id.fit(d)
    assert language_id.predict(d, model).first().lang_pred == "und"
    assert language_id.predict(d.where(F.lit(False)), model).count() == 0


def test_one_language(spark):
    d = spark.createDataFrame([(1, "abc", "x")], "doc_id bigint, text string, lang string")
    assert language_id.predict(d, language_id.fit(d)).first().rejected is False


def test_unlearned_languages_and_noise_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit(docs, where=~fold(4))
    held = docs.where(fold(4)).collect()
    rejected = lambda m, texts: sum(c.classify(t)[3] for c in [language_id.Classifier(m)] for t in texts) / len(texts)
    assert rejected(model, [r.text for r in held]) < 0.02
    for left_out in model.languages:
        known = [(lang, d) for lang, d in zip(model.languages, model.dictionaries, strict=True) if lang != left_out]
        fewer = dataclasses.replace(model, languages=tuple(lang for lang, _ in known), dictionaries=tuple(d for _, d in known))
        assert rejected(fewer, [r.text for r in held if r.lang == left_out]) > 0.85, left_out
    rng = random.Random(3)
    for signs in ("abcdefghijklmnopqrstuvwxyz    ", "0123456789abcdef"):
        assert rejected(model, ["".join(rng.choices(signs, k=5000)) for _ in range(20)]) > 0.85
