"""Set-relation Jaccard join against all pairs."""

import random
import re

import pytest

from tabula.llm import jaccard_join
from tabula.llm.components import components
from tabula.llm.queries import QUERIES


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(docs, k, num, den):
    sets = [shingles(t, k) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        met = {}
        for x in s:
            for j in holders[x]:
                if j < i:
                    met[j] = met.get(j, 0) + 1
        for j, n in met.items():
            if n * den >= (len(s) + len(sets[j]) - n) * num:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(docs)):
        groups.setdefault(find(i), []).append(docs[i][0])
    name = {r: min((x for x in g if x is not None), default=None) for r, g in groups.items()}
    return sorted(((docs[i][0], len(sets[i]), name[find(i)]) for i in range(len(docs))), key=str)


def run(spark, docs, k, num, den):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("doc_id", "text", "1 as block", "2 as set_id", "'r' as root")
    return sorted((tuple(r) for r in jaccard_join.similar_groups(d, k=k, num=num, den=den).collect()), key=str)


def near_copies(rng, n_base, copies, words, edits):
    docs = []
    for _ in range(n_base):
        base = [f"w{rng.randrange(400)}" for _ in range(words)]
        for _ in range(copies):
            t = base[:]
            for _ in range(rng.randrange(0, edits + 1)):
                t[rng.randrange(len(t))] = f"w{rng.randrange(400)}"
            docs.append(" ".join(t))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("k,num,den,words,edits,block", [(3, 90, 100, 60, 4, 1024), (5, 80, 100, 50, 4, 8), (1, 70, 100, 12, 4, 5), (2, 100, 100, 10, 1, 1024), (3, 60, 100, 20, 5, 16)])
def test_near_copies(spark, monkeypatch, k, num, den, words, edits, block):
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", block)
    rng = random.Random(words * 7 + k)
    texts = near_copies(rng, 6, 30, words, edits)
    docs = list(enumerate(texts)) + [(500, None), (501, ""), (502, " \n"), (503, "one"), (504, "ONE"), (505, "one two"), (None, "lonely null id here"), (506, texts[3]), (506, texts[3]), (3, texts[4])]
    assert run(spark, docs, k, num, den) == brute(docs, k, num, den)


def test_hot_shingle_does_not_link(spark):
    docs = [(i, "common words in every document " + " ".join(f"x{i}_{j}" for j in range(20))) for i in range(150)]
    assert run(spark, docs, 3, 90, 100) == brute(docs, 3, 90, 100)


def test_empty(spark):
    assert run(spark, [], 3, 90, 100) == []


def test_keep_one(spark):
    a, b = "a b c d e f g h i j", "k l m n o p q r s t"
    rows = [(5, a, "x"), (2, a, "y"), (2, a, "y"), (9, b, "z"), (None, a, "n"), (None, a, "n"), (11, None, "e"), (12, "", "e")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = sorted((tuple(r) for r in jaccard_join.keep_one(d).collect()), key=str)
    assert got == sorted([(2, a, "y"), (9, b, "z"), (None, a, "n"), (None, a, "n"), (11, None, "e"), (12, "", "e")], key=str)


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (7, 7), (-5, 100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: -5, 101: -5, -5: -5}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op7_set_relation_jaccard_join"](spark, sf).collect()), key=str)
    assert got == brute(docs, 3, 90, 100) and any(r[0] != r[2] for r in got)
