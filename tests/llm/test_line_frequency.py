"""Line frequency against a plain-Python version, and against SQL on the driver's documents."""

import random
import re
from collections import defaultdict

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck
from tabula.llm import line_frequency
from tabula.llm.queries import ORACLE, QUERIES

SCHEMA = "doc_id bigint, text string, source string, kept string, h int, n int, _k1 int, tags map<string,int>"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DIGITS = str.maketrans("123456789", "000000000")


def brute(docs, max_docs=10, max_share=0.005, min_left=0.5):
    plain = lambda line: " ".join(WORD.findall(line.lower().translate(DIGITS)))
    texts, holders = defaultdict(set), defaultdict(set)
    for _, text, host in docs:
        texts[host].add(text)
        for line in (text or "").split("\n"):
            if plain(line):
                holders[host, plain(line)].add(text)
    out = []
    for i, text, host in docs:
        t = text or ""
        words, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        tri = [tuple(words[j:j + 3]) for j in range(len(words) - 2)]
        inside = {p for j, w in enumerate(tri) if tri.count(w) > 1 for p in range(j, j + 3)}
        gone = [x for x in lines if len(holders[host, plain(x)]) > max(max_docs, int(len(texts[host]) * max_share))]
        n_gone = sum(len(WORD.findall(x)) for x in gone)
        failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
        drop = {plain(x) for x in gone}
        left = None if text is None else "\n".join(x for x in text.split("\n") if plain(x) not in drop or not plain(x))
        out.append((i, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside), failed,
                    len(drop), n_gone, left, not failed and len(words) - n_gone >= min_left * len(words)))
    return sorted(out, key=str)


def run(spark, docs, **how):
    rows = [(i, t, s, "x", 1, 2, 3, {"a": 1}) for i, t, s in docs]
    got = line_frequency.judge(spark.createDataFrame(rows, SCHEMA), **how).collect()
    return sorted((tuple(r) for r in got), key=str)


def test_planted_lines(spark):
    rng = random.Random(5)
    vocabulary = ["The", "the", "of", "a#b", "É", "𝔘x", "on", "1", "2", "<p>", "word"]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    notice, menu = "Copyright 2019 \t ALL rights", " ".join(f"menu{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    docs = []
    for i in range(60):
        parts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 90))) for _ in range(rng.randrange(1, 4))]
        if i % 3:
            parts.insert(1, notice.replace("2019", str(1990 + i % 20)).lower() if i % 2 else notice)
        if i % 2:
            parts += [menu, *[menu] * (i % 7 == 0), line(rng.randrange(0, 6))]
        docs.append((i, "\n".join(parts), "hot" if i % 5 else None))
    docs += [(100, None, "hot"), (101, "", "hot"), (None, " \n\t\n", None), (102, line(300), "hot"), (103, "a b c a b c", "x"), (103, "a b c a b c", "x"), (104, "a\r\na\n a\na", "x")]
    docs += [(200 + i, "one text in many copies\nwith two lines", "hot") for i in range(30)]
    assert run(spark, docs) == brute(docs)
    assert run(spark, docs, max_docs=1, max_share=0.2, min_left=0.9) == brute(docs, 1, 0.2, 0.9)
    assert any(r[7] and not r[-1] and not r[6] for r in brute(docs))  # some documents are depleted


def test_very_long_text_and_empty_table(spark):
    long = "\n".join(f"line {i % 3000} of it " + "x" * (i % 7) for i in range(30000))
    (got,) = run(spark, [(1, long, "s")])
    assert got[1:5] == (150000 - sum(1 for i in range(30000) if i % 7 == 0), len(re.sub(r"\s", "", long)), 0, 30000 - len(set(long.split("\n"))))
    assert run(spark, []) == []


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_matches_sql(spark, sf):
    name = "op11_line_frequency_rules"
    folder = f"/root/testdata/sf{sf}"
    assert compare(QUERIES[name](spark, folder).toPandas(), duck(folder).sql(ORACLE[name]).df()) is None


def test_no_python_in_the_plan(spark, small_dir):
    plan = entry.queries()["op11_line_frequency_rules"](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
