"""Join operators: membership (IN / NOT IN / EXISTS), anti joins and range lookups.

Joins between data-sized tables are left to Catalyst + AQE: they plan as
sort-merge joins and AQE turns them into broadcast joins at run time only when
the measured shuffle output is small, and splits skewed partitions. Explicit
broadcast is used only for tables whose size is bounded by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy from this fraction of all weight on, so there are at most so many.
HEAVY = 1000
#: Parts among which rows that look for no match are spread.
SPREAD = 4096


def semi_in(df: DataFrame, members: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """``WHERE k IN (SELECT k FROM members)`` as a left-semi join (no duplicates introduced)."""
    return df.join(members, on, "left_semi")


def anti_not_in(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """``WHERE k NOT IN (SELECT k FROM members)`` with SQL's null rules.

    Against an empty subquery every row is kept, NULL keys included. Otherwise
    a NULL in the subquery makes NOT IN unknown for every row (empty result),
    and a NULL key on the left is dropped. The subquery's row count and NULL
    flag are one one-row aggregate; the match test is a plain left-anti join on
    non-null keys, which can shuffle instead of relying on the null-aware
    broadcast anti join.
    """
    right = members.select(key)
    stats = right.agg(F.count(F.lit(1)).alias("__rows"),
                      F.max(F.col(key).isNull().cast("int")).alias("__has_null"))
    kept = df.join(right.filter(F.col(key).isNotNull()), key, "left_anti")
    keep = (F.col("__rows") == 0) | (F.col(key).isNotNull() & (F.col("__has_null") == 0))
    return (kept.crossJoin(F.broadcast(stats))  # one row by construction
            .filter(keep)
            .drop("__rows", "__has_null"))


def anti_exists(df: DataFrame, other: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """``WHERE NOT EXISTS (correlated equality)`` = left-anti join."""
    return df.join(other, on, "left_anti")


def range_lookup(df: DataFrame, ranges: DataFrame, point: str | Column, start: str, end: str) -> DataFrame:
    """Left join each row to the range with ``start <= point <= end``.

    ``ranges`` is meant to be small (for example a campaign calendar): rows
    meet it in a nested-loop join, one comparison per range per row; the planner
    broadcasts it by its known size. Ranges are expected not to
    overlap; an overlapping range would duplicate rows.
    """
    p = F.col(point) if isinstance(point, str) else point
    return df.join(ranges, (p >= ranges[start]) & (p <= ranges[end]), "left")


def range_lookup_by_day(df: DataFrame, ranges: DataFrame, point: str, start: str, end: str, days: int = 32) -> DataFrame:
    """``range_lookup`` for calendars of any size, over dates or timestamps.

    A range is copied to every block of ``days`` days it touches, and rows meet
    the ranges of their own block in an equi-join, so a row is compared with
    the ranges around its day only. ``days`` should be about as long as a
    usual range: shorter blocks copy more, longer ones compare more."""
    def block(c):
        return F.floor(F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date")) / days).cast("int")
    copies = ranges.withColumn("__block", F.explode(F.when(F.col(start) <= F.col(end), F.sequence(block(start), block(end)))))
    rows = df.withColumn("__at", block(point))
    inside = (F.col("__at") == F.col("__block")) & (rows[point] >= copies[start]) & (rows[point] <= copies[end])
    return rows.join(copies, inside, "left").drop("__at", "__block")


def heavy_join(left: DataFrame, right: DataFrame, key: str, payload: Sequence[str], weight: str, row: Sequence[str],
               weights: DataFrame | None = None) -> DataFrame:
    """``left`` with the ``payload`` columns of ``right`` for its ``key``, NULL
    if there is none (a left join; ``right`` has one row per key, none NULL).

    ``weight`` of a right row says how many left rows have its key, for example
    from a partial count. Keys of at least one in ``HEAVY`` of all weight, so at
    most ``HEAVY`` rows, are copied to every task and their left rows never
    travel; all others meet in a shuffle, in which no key is hot. Left rows
    that look for nothing more (found, or a NULL key) are spread by a hash of
    their ``row`` columns. All weight is summed over ``weights`` if given, a
    frame with the weights of ``right`` that is cheaper to make."""
    packed = right.select(F.col(key).alias("__rk"), F.struct(*payload).alias("__p"), F.col(weight).cast("double").alias("__w"))
    total = (right if weights is None else weights).agg(F.sum(F.col(weight).cast("double")).alias("__all"))  # one row
    marked = packed.crossJoin(F.broadcast(total)).withColumn("__heavy", F.col("__w") * HEAVY >= F.col("__all"))
    heavy = marked.filter(F.col("__heavy")).select(F.col("__rk").alias("__hk"), F.col("__p").alias("__hp"), F.lit(True).alias("__met"))
    light = marked.filter(~F.col("__heavy")).select("__rk", F.col("__p").alias("__lp"), F.col("__heavy").cast("int").alias("__none"))  # a literal would be folded away
    met = left.join(F.broadcast(heavy), F.col(key) == F.col("__hk"), "left")
    done = F.col("__met").isNotNull() | F.col(key).isNull()
    met = met.withColumn("__key", F.when(~done, F.col(key))).withColumn(
        "__spread", F.when(done, 1 + F.pmod(F.xxhash64(*row), F.lit(SPREAD))).otherwise(0).cast("int"))
    out = met.join(light, (F.col("__key") == F.col("__rk")) & (F.col("__spread") == F.col("__none")), "left")
    return out.select(*left.columns, *[F.when(F.col("__met").isNotNull(), F.col(f"__hp.{c}")).otherwise(F.col(f"__lp.{c}")).alias(c) for c in payload])
