"""Near words, forms and roots against comparing all words in plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tabula.llm import variants
from tabula.llm.queries import QUERIES

LETTERS = "abcdeéÿ×"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edits(word, letters):
    for i in range(len(word) + 1):
        yield word[:i] + word[i + 1:]
        for c in letters:
            yield word[:i] + c + word[i:]
            yield word[:i] + c + word[i + 1:]


def brute(words, factor=10):
    letters = sorted(set("".join(words)))
    near = {w: sorted({e for e in edits(w, letters) if e != w and e in words}) for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= factor * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def run(spark, words, **how):
    return sorted(tuple(r) for r in variants.group_variants(spark.createDataFrame(list(words.items()), "word string, n bigint"), **how).collect())


def vocabulary(seed, n):
    rng = random.Random(seed)
    words = Counter()
    for _ in range(n):
        w = "".join(rng.choice(LETTERS[:rng.choice([2, 3, 8])]) for _ in range(rng.choice([7, 7, 8, 8, 9, 12, 15])))
        words[w] = rng.choice([2, 3, 20, 300, 5000])
        for e in rng.sample([e for e in edits(w, LETTERS) if len(e) >= 7], 4):
            words[e] = rng.choice([2, 25, 40, 400])
    return words


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_vocabulary(spark, seed):
    words = vocabulary(seed, 250)
    want = brute(words)
    assert sum(r[1] is not None and r[2] != r[1] for r in want) > 5  # forms of forms
    assert run(spark, words) == want


def test_small_batches(monkeypatch):
    """In one process, so that the small size holds."""
    words = sorted(w for w in vocabulary(5, 150) if len(w) in (7, 8))
    middle = np.zeros((len(words), 12), np.uint8)
    for i, w in enumerate(words):
        middle[i, :len(w)] = np.frombuffer(w.encode("latin-1"), np.uint8)
    found = variants.SortedList(np.zeros(len(words), np.int64), middle)
    whole = set()
    for size in (1 << 18, 2000):
        monkeypatch.setattr(variants, "STATES", size)
        pairs = [(words[found.order[x]], words[found.order[y]]) for a, b in found.near() for x, y in zip(a, b, strict=True)]
        assert len(pairs) == len(set(pairs))
        whole = whole or {(w, e) for w in words for e in edits(w, LETTERS) if e in set(words) and e != w}
        assert set(pairs) == whole


def test_divided_lists(spark):
    words = vocabulary(4, 200)
    for a in "abcde":  # many words that are alike but for one place
        words.update({"samestart" + a + x + "sameend": 3 for x in LETTERS})
    want = {(w, k) for w, _, _, _, k, _ in brute(words) if k}
    near = variants.near_words(spark.createDataFrame(list(words.items()), "word string, n bigint"), limit=3)
    assert {(r.word, r.n_near) for r in near.collect()} == want
    assert run(spark, words) == brute(words)


def test_very_long_words(spark):
    long = "ab" * 3000
    words = {long: 100, long[:2999] + long[3000:]: 9, long + "a": 2, "x" + long: 2, long[:-1] + "c": 1000, "abababab": 4}
    assert run(spark, words) == brute(words)


def brute_counts(docs, damage):
    counts = Counter()
    for i, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if damage and h % damage == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def count(spark, docs, **how):
    rows = [(i, t, "x", 3, "m") for i, t in docs]
    return {r.word: r.n for r in variants.count_words(spark.createDataFrame(rows, "doc_id bigint, text string, word string, n int, m string"), **how).collect()}


def test_counts(spark):
    rng = random.Random(6)
    words = ["ÉCOLEàs", "Straßes", "letters", "LETTERS", "eightxyz", "a", "ninexyzab", "x×÷éabcd"]
    docs = [(i if i % 7 else None, "".join(rng.choice(words) + rng.choice([" ", "1", "λ", "𝔘", "\n", "Ā"]) for _ in range(rng.randrange(60)))) for i in range(200)]
    docs += [(5, None), (6, ""), *docs[:3] * 2, (900, "longword" * 600_000 + " again again again letters")]
    for damage in (31, 3, None):
        assert count(spark, docs, damage=damage) == brute_counts(docs, damage)
    assert count(spark, []) == {} and run(spark, {}) == []


def test_query_on_documents(spark, small_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op13_sorted_list_variants"](spark, small_dir).collect())
    assert len(got) > 100 and got == brute(brute_counts(docs, 31))
