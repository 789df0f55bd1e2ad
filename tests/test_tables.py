"""Named tables: a second write replaces the first, old readers still work, failed writes change nothing."""

import uuid

import pytest
from pyspark.sql import functions as F

from tabula.sources import sinks

SCHEMA = "id int, name string, amount decimal(5,2)"


@pytest.fixture
def name(spark):
    n = f"t_{uuid.uuid4().hex[:8]}"
    yield n
    sinks.drop(spark, n)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_create_insert_and_drop(spark, name):
    sinks.create(spark, name, SCHEMA)
    assert rows(sinks.read(spark, name)) == [] and sinks.read(spark, name).schema.simpleString() == "struct<id:int,name:string,amount:decimal(5,2)>"
    with pytest.raises(ValueError):
        sinks.create(spark, name, SCHEMA)
    sinks.insert_rows(spark, name, [(1, "a", None), (2, None, None)])
    sinks.insert(spark, name, spark.range(3, 5).select(F.col("id"), F.lit("9.90").alias("amount")))
    got = [(r.id, r.name, None if r.amount is None else str(r.amount)) for r in sinks.read(spark, name).orderBy("id").collect()]
    assert got == [(1, "a", None), (2, None, None), (3, None, "9.90"), (4, None, "9.90")]
    assert spark.sql(f"SELECT COUNT(*) FROM {name}").first()[0] == 4  # a name of the session's catalog
    sinks.drop(spark, name)
    assert not sinks.exists(spark, name)
    sinks.drop(spark, name)
    with pytest.raises(ValueError):
        sinks.drop(spark, name, if_exists=False)


def test_replace_keeps_old_readers(spark, name):
    first = sinks.replace(spark, spark.range(3), name)
    second = sinks.replace(spark, first.select((F.col("id") + 10).alias("id")), name)  # reads what it replaces
    assert rows(second) == rows(sinks.read(spark, name)) == [(10,), (11,), (12,)]
    assert rows(first) == [(0,), (1,), (2,)]
    other = sinks.replace(spark, spark.createDataFrame([("x", 1.5)], "a string, b double"), name)  # another schema
    assert rows(sinks.read(spark, name)) == [("x", 1.5)] and other.columns == ["a", "b"]
    sinks.create(spark, name, SCHEMA, replace=True)
    assert rows(sinks.read(spark, name)) == []


def test_failed_writes_change_nothing(spark, name):
    sinks.create(spark, name, SCHEMA)
    sinks.insert_rows(spark, name, [(1, "a", None)])
    broken = spark.range(0, 200, numPartitions=8).select(F.col("id").cast("int"), F.when(F.col("id") == 190, F.raise_error(F.lit("no"))).otherwise("b").cast("string").alias("name"))
    before = rows(sinks.read(spark, name))
    for write in (lambda: sinks.insert(spark, name, broken), lambda: sinks.replace(spark, broken, name),
                  lambda: sinks.insert(spark, name, spark.range(1).select(F.lit("99999").alias("amount"))),  # beyond decimal(5,2)
                  lambda: sinks.insert(spark, name, spark.range(1).select(F.lit(1).alias("unknown")))):
        with pytest.raises(Exception):
            write()
        assert rows(sinks.read(spark, name)) == before


def test_versions_expire(spark, name):
    for n in range(1, 6):
        sinks.replace(spark, spark.range(n), name)
    assert len(sinks.versions(spark, name)) == sinks.KEPT_VERSIONS
    sinks.expire(spark, name, keep=0)
    assert len(sinks.versions(spark, name)) == 1 and sinks.read(spark, name).count() == 5
    sinks.drop(spark, name)
    assert sinks.expire(spark, name, keep=0) and sinks.versions(spark, name) == []
