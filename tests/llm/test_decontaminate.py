"""Decontamination against brute force over all windows."""

import hashlib
import random
import re

import pytest

from tabula.llm import decontaminate
from tabula.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window):
    wins = {}
    for name, text in items:
        w = words(text)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            wins.setdefault(tuple(w[i:i + window]), set()).add(name if name is not None else "")
    sizes = {len(k) for k in wins}
    out = []
    for i, text in docs:
        w = words(text)
        hit, met = set(), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if got := wins.get(tuple(w[at:at + n])):
                    hit.update(range(at, at + n))
                    met |= got
        out.append((i, len(w), len(hit), sorted(met)))
    return out


def run(spark, docs, items, window=10):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id string, text string")
    return [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in decontaminate.contamination(d, b, window=window).collect()]


ITEMS = [("b1", "one two three four five six seven eight nine ten eleven twelve"), ("b2", "short item"), ("b3", "Solo"), ("b3", "Solo"), ("b10", ""),
         ("b11", None), (None, "nameless item here"), ("é", "élan vital Ünder"), ("b1x", "a a a a a a a a a a a a")]
DOCS = [(1, "x ONE, two; three four five six seven eight nine ten eleven twelve thirteen"), (2, None), (3, ""), (4, "... !!"), (5, "a short item, solo"),
        (6, "one two three four five six seven eight nine"), (7, "ten"), (7, "ten"), (None, "solo"), (8, "nameless item here élan vital ünder"),
        (9, "a " * 30), (10, "short"), (11, "item short item short item")]


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, str(r)))


def test_cases(spark):
    assert key(run(spark, DOCS, ITEMS)) == key(brute(DOCS, ITEMS, 10))


def test_longest_match(spark):
    d = spark.createDataFrame(DOCS[:1], "doc_id bigint, text string")
    b = spark.createDataFrame(ITEMS[:1], "item_id string, text string")
    r = decontaminate.contamination(d, b).first()
    assert [tuple(s) for s in r.spans] == [(1, 10, 12), (2, 10, 11), (3, 10, 10)] and r.contaminated


@pytest.mark.parametrize("block", [None, 200])
def test_random_small_alphabet(spark, monkeypatch, block):
    if block:
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    docs = [(i, text(rng.randrange(0, 60))) for i in range(80)] + [(3, "a b"), (3, "a b")]
    items = [(str(i), text(rng.randrange(0, 9))) for i in range(40)]
    assert key(run(spark, docs, items, 5)) == key(brute(docs, items, 5))


def test_empty_tables(spark):
    assert run(spark, [], ITEMS) == []
    assert run(spark, [(1, "a b")], []) == [(1, 2, 0, [])]


def test_removal_keeps_columns(spark):
    d = spark.createDataFrame([(1, "solo", 1), (2, "clean", 2)], "doc_id bigint, text string, spans int")
    b = spark.createDataFrame([("i", "solo")], "item_id string, text string")
    assert [tuple(r) for r in decontaminate.remove_contaminated(d.withColumnRenamed("spans", "extra"), b).collect()] == [(2, "clean", 2)]


def test_query(spark, small_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    want = [(i, n, h, len(m), hashlib.sha256(",".join(m).encode()).hexdigest(), h > 0) for i, n, h, m in brute(docs, items, 10)]
    got = [tuple(r)[:6] for r in QUERIES["op10_suffix_array_decontamination"](spark, small_dir).collect()]
    assert sorted(got) == sorted(want) and any(r[5] for r in got)
