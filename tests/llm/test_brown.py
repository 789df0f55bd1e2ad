"""Brown class bigrams: exact base scores, normalised model, better than the base."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tabula.llm import brown
from tabula.llm.queries import QUERIES


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def base(docs, train):
    c, n = Counter(), 0
    for (_, t), learned in zip(docs, train, strict=True):
        if learned:
            c.update([*words(t), None])
    n, v = sum(c.values()), len(c)
    return n, [(len(words(t)) + 1, sum(c[w] > 0 for w in [*words(t), None]), sum(math.log10((c[w] + 1) / (n + 1 * (v + 1))) for w in [*words(t), None])) for _, t in docs]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    train = [zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in docs]
    n, want = base(docs, train)
    got = {r.doc_id: r for r in QUERIES["op5_brown_class_perplexity"](spark, sf).collect()}
    assert len(got) == len(docs)
    for (i, _), learned, (tokens, known, value) in zip(docs, train, want, strict=True):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not learned, tokens, known, n)
        assert r.base_score == pytest.approx(value, abs=1e-6) and r.score < 0
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.97


def test_probabilities_sum_to_one(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the", "a"]) + " " + rng.choice(["cat", "dog", "bird", f"x{rng.randrange(40)}"]) + " " + rng.choice(["runs", "sleeps"]) for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    d = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)] + [(900, "the zebra runs", False)], "doc_id bigint, text string, train boolean")
    model = brown.fit(d.where("train"), n_classes=6)
    assert np.allclose((10 ** model.transition).sum(1), 1)
    counts = Counter(w for t in texts for w in words(t))
    probe = spark.createDataFrame([(i, w, False) for i, w in enumerate(counts)], "doc_id bigint, text string, train boolean")
    scored = {r.doc_id: r for r in brown.score(d.unionAll(probe.selectExpr("doc_id + 1000", "text", "train")), model, "train").collect()}
    end = model.classes[-1]
    first = 0.0
    for i, w in enumerate(counts):  # P(w | start) from log P(w) = log P(w | start) + log P(end | w)
        from tabula.llm import ragged
        import pyarrow as pa
        h, s, _ = brown.tokens(*ragged.text_bytes(pa.array([w])))
        kind = model.classes[model.units(h, s)[0]]
        first += 10 ** (scored[1000 + i].score - model.transition[kind, end])
    rest = sum(10 ** model.transition[end, k] * model.unseen[k] for k in range(len(model.unseen)))
    assert first + rest + 10 ** model.transition[end, end] == pytest.approx(1, abs=1e-6)
    assert scored[900].n_known == 3


def test_exchange_raises_likelihood(spark):
    texts = ["a x b y a x b y", "b x a y", "a y b x b x"] * 5
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    none, some = brown.fit(d, n_classes=2, rounds=0), brown.fit(d, n_classes=2, rounds=6)
    value = lambda m: -np.nansum(10 ** m.transition * m.transition)
    assert value(some) <= value(none) + 1e-9


def test_odd_rows(spark):
    rows = [(1, None, True, 0), (2, "", True, 0), (None, "A a", True, 0), (3, "a b", None, 0), (3, "a b", None, 0), (4, "w" * 10**5 + " x" * 50000, False, 0)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, train boolean, score int")
    model = brown.fit(d.where("train"))
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in brown.score(d, model, "train").collect()), key=str)
    assert got == sorted([(1, 1, 1, 5), (2, 1, 1, 5), (None, 3, 3, 5), (3, 3, 2, 5), (3, 3, 2, 5), (4, 50002, 1, 5)], key=str)
    empty = brown.fit(d.where("false"))
    r = brown.score(d.where("doc_id = 3").withColumn("train", d.train.isNull() & False), empty, "train").first()
    assert r.train_tokens == 0 and r.base_score == 0 and math.isfinite(r.score)
    assert brown.score(d.where("false"), model, "train").count() == 0


def test_rare_words_pick_their_own_class(spark, monkeypatch):
    """Outside the frequent words: equal endings, different neighbours."""
    monkeypatch.setattr(brown, "TOP", 4)
    rng = random.Random(5)
    texts = [" ".join(w for _ in range(20) for w in (("the", f"n{rng.randrange(30)}ing") if rng.random() < 0.5 else ("we", f"v{rng.randrange(30)}ing"))) for _ in range(200)]
    d = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id bigint, text string, train boolean")
    model = brown.fit(d, n_classes=6)
    kinds = {}
    for r in model.words.collect():
        kinds |= zip(np.frombuffer(r.keys, "<u8").tolist(), np.frombuffer(r.extra, "u1").tolist(), strict=True)
    import pyarrow as pa

    from tabula.llm import ragged
    counts = Counter(w for t in texts for w in t.split())
    hashes = {w: int(brown.tokens(*ragged.text_bytes(pa.array([w])))[0][0]) for w in counts}
    rare = [w for w in counts if hashes[w] in kinds]
    assert len(rare) == len(kinds) == len(counts) - 4
    nouns, verbs = ({kinds[hashes[w]] for w in rare if w[0] == x} for x in "nv")
    assert not nouns & verbs
    total = lambda m: sum(r.score for r in brown.score(d, m, "train").collect())
    assert total(model) > total(brown.fit(d, n_classes=6, word_rounds=0))
