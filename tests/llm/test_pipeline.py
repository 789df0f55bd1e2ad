"""The pipeline: stages in order, every stage on all its predecessor kept, and each
against a plain-Python version on planted documents."""

import random
import re

import pytest

import corpus_pipeline as cp
from tabula.llm import decontaminate, jaccard_join, suffix_dedup
from tabula.llm.queries import QUERIES

#: Columns that stages add inside, and others: all must come back as they were.
CLASHING = "doc_id bigint, text string, block int, n_bytes int, spans string, kept string, n_words int, items string, contaminated string, _id int, _copy string, row_key int, _null string, answer double"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def planted(seed):
    """(documents, benchmark): clean ones, exact and near copies, documents that
    share a passage of over 50 words, and documents with a benchmark passage."""
    rng = random.Random(seed)
    docs = [(i, words(rng, rng.randrange(60, 160))) for i in range(60)]
    for i in range(8):  # exact and near copies, also of each other
        base = docs[i][1].split()
        docs += [(100 + 3 * i, docs[i][1]), (101 + 3 * i, " ".join([*base[:-1], "other"])), (102 + 3 * i, " ".join(["first", *base]))]
    passage, items = words(rng, 60), [(1, words(rng, 14)), (2, words(rng, 6)), (3, None)]
    docs += [(200 + i, f"{words(rng, 80)} {passage} {words(rng, 70)}") for i in range(5)]
    docs += [(300, f"{words(rng, 60)} {items[0][1].upper()} {words(rng, 50)}"), (301, f"{words(rng, 40)} {' '.join(items[0][1].split()[:9])} {words(rng, 30)}"),
             (302, items[1][1])]
    return docs + [(400, None), (401, ""), (402, "short"), (7, words(rng, 90)), (None, words(rng, 70)), (9, docs[9][1])], items


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def plain_keep_one(docs):
    rows = [d for d in dict.fromkeys(docs) if d[0] is not None]
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for g, row in zip(group, rows, strict=True):
        best.setdefault(g, []).append(row)
    return sorted([d for d in docs if d[0] is None] + [(i, t) for members in best.values() for i, t in members if i == min(m[0] for m in members)], key=str)


def plain_cut(docs, length):
    last = 2**63
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            first[b[p:p + length]] = min(first.get(b[p:p + length], last), last if i is None else i)
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < (last if i is None else i):
                gone[p:p + length] = b"\1" * length
        out.append((i, None if t is None else bytes(c for c, g in zip(b, gone, strict=True) if not g).decode()))
    return sorted(out, key=str)


def plain_leaks(docs, items, window=10):
    tests = []
    for _, t in items:
        w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
        tests += [w[i:i + window] for i in range(max(len(w) - window + 1, 1))] if w else []
    def hit(t):
        w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
        return any(w[i:i + len(x)] == x for x in tests for i in range(len(w) - len(x) + 1))
    return sorted((d for d in docs if not hit(d[1])), key=str)


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 7, 8, "s", "k", 9, "it", "c", 5, "copy", 6, "n", 0.5) for i, t in docs], CLASHING)


def result(df):
    rows = df.collect()
    assert all(tuple(r)[2:] == (7, 8, "s", "k", 9, "it", "c", 5, "copy", 6, "n", 0.5) for r in rows)  # callers' columns are theirs
    return sorted(((r.doc_id, r.text) for r in rows), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_stages_against_plain_versions(spark, seed):
    docs, items = planted(seed)
    one = plain_keep_one(docs)
    assert result(jaccard_join.keep_one(frame(spark, docs), k=5, num=80, den=100)) == one
    assert {i for i, _ in one} >= set(range(60)) | {None} and not {i for i, _ in one} & set(range(100, 124))
    assert sum(i == 7 for i, _ in one) == 2  # two texts under one id are two documents
    cut = plain_cut(one, cp.REPEAT_BYTES)
    assert result(suffix_dedup.remove_repeats(frame(spark, one), length=cp.REPEAT_BYTES)) == cut
    assert [i for (i, t), (_, u) in zip(one, cut, strict=True) if t != u] == [201, 202, 203, 204]  # only the shared passage goes, all but once
    clean = plain_leaks(cut, items)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert result(decontaminate.remove_contaminated(frame(spark, cut), bench, window=10)) == clean
    assert {i for i, _ in cut} - {i for i, _ in clean} == {300, 302}


def test_language_stage_keeps_what_it_can_tell(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id for r in cp.identify_language(spark, docs, sf).collect()}
    every = docs.select("doc_id", "text").collect()
    letters = {r.doc_id for r in every if sum(c.isalpha() for c in r.text or "") >= 200}
    assert len(letters - kept) <= 0.01 * len(letters) and not kept & {r.doc_id for r in every if not any(c.isalpha() for c in r.text or "")}


def test_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in cp.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, sf).checkpoint()
        assert docs.columns == cp.COLUMNS and 0.6 * before < docs.count() <= before, name
    packed = {r.doc_id for r in cp.STAGES[-1][1](spark, docs, sf).select("doc_id").collect()}
    assert packed == {r.doc_id for r in docs.select("doc_id").collect()}
    ran = QUERIES["pipeline"](spark, sf)
    assert {r.doc_id for r in ran.select("doc_id").collect()} == packed
    assert [n for n, _ in cp.STAGES] == ["language_id", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "packing"]


def test_empty_and_odd_documents(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, block int"
    rows = [(None, None, None, None, None, None, None), (1, "", "en", "s", 0, None, 1), (2, "a plain text of some words", "en", "s", 26, 0.5, 1), (2, "a plain text of some words", "en", "s", 26, 0.5, 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in cp.STAGES:
            docs = stage(spark, docs, sf).checkpoint()
        assert docs.select("doc_id").distinct().count() == (1 if data else 0)
