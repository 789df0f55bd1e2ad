"""Stripes against counting every phrase in plain Python, and against SQL on the driver's documents."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from oracle_check import compare, duck
from tabula.llm import collocations
from tabula.llm.queries import ORACLE, QUERIES

SCHEMA = "doc_id bigint, text string, lang string, phrase string, block int, score string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, min_count=10, subsumed=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        inside = Counter()
        for p, a in counts.items():
            if len(p) == 3 and a >= min_count:
                for part in (p[:2], p[1:]):
                    inside[part] = max(inside[part], a)
        rows = []
        for p, a in counts.items():
            if len(p) > 1 and a >= min_count and not 100 * inside[p] >= subsumed * a * (inside[p] > 0 or 10**9):
                score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        rows.sort()
        out += [(lang, i + 1, p.decode(), -a, le, r, n[lang], -s) for i, (s, a, p, le, r) in enumerate(rows[:top])]
    return sorted(out)


def run(spark, docs, **how):
    rows = [(i, t, g, "p", 1, "s") for i, t, g in docs]
    return sorted(tuple(r) for r in collocations.mine(spark.createDataFrame(rows, SCHEMA), **how).collect())


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["The", "of", "new", "york", "é", "𝔘", "a\0b", "City", "x", "y", "z "] + [f"w{i}" for i in range(20)]
    ends = [" ", "  ", "\t", ". ", ",", "\n", "\r\n"]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(0, 60)):
            parts.append(rng.choice(["New York City", "of the", rng.choice(words), words[min(int(rng.expovariate(0.4)), 30)]]) + rng.choice(ends[:rng.choice([1, 3, 7])]))
        docs.append((i, "".join(parts), rng.choice(["en", "en", "fr", None, "und"])))
    return docs + [(0, None, "xx"), (1, "", "yy"), (None, " . ,", "en"), (3, "only one piece of it", "zz")] + docs[:9] * 3


@pytest.mark.parametrize("seed", [1, 2])
def test_random_corpus(spark, seed):
    docs = corpus(seed, 150)
    want = brute(docs)
    assert len(want) > 50 and run(spark, docs) == want
    assert run(spark, docs, top=7, min_count=3, subsumed=20) == brute(docs, 3, 20, 7)


def test_many_blocks_long_texts_and_divided_stripes(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SMALL_BLOCK", 2000)
    monkeypatch.setattr(collocations, "LARGE_BLOCK", 4000)
    docs = corpus(7, 200)
    docs.append((500, ". ".join(t or "" for _, t, _ in docs) * 8 + " tail" * 60000, "en"))
    assert run(spark, docs, stripe=16, row_bytes=5000) == brute(docs)


def test_what_a_block_sends_does_not_follow_the_order_of_its_rows():
    rows = [{"block": 1, "lang": lang or "und", "text": text or ""} for _, text, lang in corpus(3, 40)]
    sent = []
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        block = collocations.Block(pa.Table.from_pylist(rows))
        words = list(block.send_words(4))
        answers = [collocations._answer_words([m], np.zeros(1, np.int64), b, 4, 2)[0] for b, m in words]
        block.read_words(pa.table({"bucket": [b for b, _ in words], "answer": answers}), 4)
        block.pairs(4)
        sent.append((words, list(block.send_pairs())))
    assert sent[0] == sent[1] == sent[2]


def test_empty_table_and_exact_products(spark):
    assert run(spark, []) == []
    big = 3_100_000  # 1000000 * a * a is beyond 64 bits
    merged = spark.createDataFrame([("en", "a b", big, big + 1, big + 2, None, None, None, None), ("en", None, None, None, None, None, None, None, 7)],
                                   "lang string, phrase string, a bigint, l1 bigint, r1 bigint, l2 bigint, r2 bigint, inside bigint, n bigint")
    original, collocations.stripes = collocations.stripes, lambda *_, **__: merged
    try:
        (row,) = collocations.mine(merged).collect()
    finally:
        collocations.stripes = original
    assert row.score == 10**6 * big * big // ((big + 1) * (big + 2)) and row.n == 7


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_matches_sql(spark, sf):
    name = "op12_stripes_collocations"
    folder = f"/root/testdata/sf{sf}"
    assert compare(QUERIES[name](spark, folder).toPandas(), duck(folder).sql(ORACLE[name]).df()) is None
