"""Merkle audit against a comparison of all records."""

import hashlib

import pytest
from oracle_check import compare, duck

from tabula.llm import fixity
from tabula.llm.queries import ORACLE, QUERIES


def test_query_matches_sql(spark, small_dir):
    for sf in (small_dir, "/root/testdata/sf0.1"):
        got = QUERIES["op3_merkle_fixity"](spark, sf).toPandas()
        assert compare(got, duck(sf).sql(ORACLE["op3_merkle_fixity"]).df()) is None
    assert len(got) > 0 and set(got.status) == {"corrupt", "missing"}


def store(spark, rows):
    return spark.createDataFrame(rows, "id bigint, record binary").selectExpr("id", "record", "'x' as hash", "1 as node")


ROWS = [(i, b"r%d" % i) for i in [*range(-70, 130), 5000, 10**6, 2**40]] + [(None, b"nul"), (3, b"again"), (3, b"again"), (4, None), (9, b"")]


@pytest.mark.parametrize("change", [{}, {5: b"R"}, {None: b"x", 2**40: b"y"}, {129: None, 3: b"z"}])
def test_locates_changes(spark, change):
    other = [(i, change.get(i, r)) for i, r in ROWS if not (i in change and change[i] is None)]
    got = {r.id: r for r in fixity.audit(store(spark, ROWS), store(spark, other)).collect()}
    assert set(got) == set(change)
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, r in got.items():
        assert r.status == ("missing" if change[i] is None else "corrupt")
        assert r.offset == sum(len(x or b"") for k, x in order[:[k for k, _ in order].index(i)])
        if [k for k, _ in ROWS].count(i) == 1:
            assert r.expected == hashlib.sha256(dict(ROWS)[i]).hexdigest() and r.length == len(dict(ROWS)[i])


def test_roots_and_empty(spark):
    a, b = store(spark, ROWS), store(spark, ROWS[::-1])
    assert fixity.root(fixity.tree(a)) == fixity.root(fixity.tree(b)) != fixity.root(fixity.tree(store(spark, ROWS[1:])))
    none = a.where("false")
    assert fixity.root(fixity.tree(none)) is None and fixity.audit(none, none).count() == 0
    extra = fixity.audit(none, a.where("id = 5")).collect()
    assert [(r.id, r.status, r.offset) for r in extra] == [(5, "extra", None)]


def test_null_fields_of_a_record(spark):
    d = spark.createDataFrame([(1, None, None), (2, "u", "é")], "id bigint, url string, html string")
    got = [bytes(r[0]) for r in d.select(fixity.warc_record("url", "html")).collect()]
    assert b"Content-Length: 0\r\n\r\n\r\n\r\n" in got[0] and b"Content-Length: 2\r\n\r\n" + "é".encode() + b"\r\n\r\n" in got[1]
