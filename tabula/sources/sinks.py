"""Named tables: create with a schema, insert, replace, copy and drop by name.

A name is a table of the session's catalog; its rows lie in version folders of
the shared folder (``tabula.session.checkpoint_dir``). A replacing write fills
a new folder first and then points the name at it (``ALTER TABLE ... SET
LOCATION``), one catalog entry swapped at the end: a write that fails changes
nothing, and a reader that was planned before keeps its own files. An insert
adds files to the current version; Spark's commit makes them visible at once
or not at all. ``expire`` removes versions that no name points at any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.session import shared_path

#: Versions of a replaced table that stay for readers planned before.
KEPT_VERSIONS = 2


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _folder(spark: SparkSession, name: str) -> str:
    return shared_path(spark, name)


def _new_version(spark: SparkSession, name: str) -> str:
    return f"{_folder(spark, name)}/v-{uuid.uuid4().hex[:12]}"


def _schema(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(_quoted(name))


def create(spark: SparkSession, name: str, schema: str | T.StructType, *, replace: bool = False) -> None:
    """``CREATE TABLE name (schema)``, empty; an existing table is an error
    unless ``replace``, which makes the name point at the new, empty table."""
    wanted = _schema(schema)
    if exists(spark, name) and not replace:
        raise ValueError(f"table {name!r} exists")
    _point(spark, name, spark.createDataFrame([], wanted))


def drop(spark: SparkSession, name: str, *, if_exists: bool = True) -> None:
    """``DROP TABLE [IF EXISTS] name``: the name goes; its files stay until
    ``expire``, for readers planned before."""
    if not if_exists and not exists(spark, name):
        raise ValueError(f"no table {name!r}")
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


def read(spark: SparkSession, name: str) -> DataFrame:
    """The rows of ``name`` as of now."""
    spark.catalog.refreshTable(_quoted(name))
    return spark.table(_quoted(name))


def insert_rows(spark: SparkSession, name: str, rows: Iterable[Sequence]) -> None:
    """``INSERT INTO name VALUES ...``: literal rows in the order of the table's columns."""
    insert(spark, name, spark.createDataFrame(list(rows), spark.table(_quoted(name)).schema))


def insert(spark: SparkSession, name: str, df: DataFrame) -> None:
    """``INSERT INTO name SELECT ...`` by column name: columns ``df`` lacks are
    NULL, columns the table lacks are an error; values are cast as an
    assignment is, so one that does not fit its column fails the insert."""
    table = spark.table(_quoted(name))
    unknown = [c for c in df.columns if c not in table.columns]
    if unknown:
        raise ValueError(f"table {name!r} has no column {', '.join(unknown)}")
    aligned = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema.fields])
    aligned.write.insertInto(_quoted(name))
    spark.catalog.refreshTable(_quoted(name))


def replace(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``name`` holds the rows of ``df`` from now on, and nothing else; returns
    a reader of them. ``df`` may read the former version of ``name``."""
    _point(spark, name, df)
    expire(spark, name)
    return read(spark, name)


def _point(spark: SparkSession, name: str, df: DataFrame) -> None:
    path = _new_version(spark, name)
    df.write.parquet(path)  # fails before anything refers to it
    quoted, location = _quoted(name), path.replace("'", "\\'")
    if exists(spark, name) and _plain(spark.table(quoted).schema) == _plain(df.schema):
        spark.sql(f"ALTER TABLE {quoted} SET LOCATION '{location}'")
    else:  # another schema is another table
        spark.sql(f"DROP TABLE IF EXISTS {quoted}")
        spark.catalog.createTable(quoted, path=path, source="parquet", schema=df.schema)
    spark.catalog.refreshTable(quoted)


def _plain(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def versions(spark: SparkSession, name: str) -> list[str]:
    """Version folders of ``name``, the oldest first."""
    folder, fs = _files(spark, name)
    if not fs.exists(folder):
        return []
    found = sorted((s.getModificationTime(), s.getPath().toString()) for s in fs.listStatus(folder))
    return [path for _, path in found]


def expire(spark: SparkSession, name: str, keep: int = KEPT_VERSIONS) -> list[str]:
    """Removes all but the last ``keep`` version folders of ``name``, never the
    current one; returns those removed."""
    _, fs = _files(spark, name)
    current = None
    if exists(spark, name):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").where("col_name = 'Location'").select("data_type").collect()
        current = rows[0][0].rstrip("/").rsplit("/", 1)[-1]
    old = versions(spark, name)
    gone = [v for v in old[:len(old) - keep if keep else len(old)] if v.rsplit("/", 1)[-1] != current]
    for path in gone:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)
    return gone


def _files(spark: SparkSession, name: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark, name))
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``SELECT ... INTO name``: the named table holds the rows of ``df``; a
    later call replaces them."""
    return replace(spark, df, name)


def snapshot(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Backup copy before a destructive step; the source frame is never changed."""
    return replace(spark, df, f"backup_{name}")
