"""Order-dependent operators that stay correct and balanced under key skew.

A window ``PARTITION BY key ORDER BY ...`` sends every row of a key to one
task. When one key holds a large share of the data that task becomes the
whole job. Running sums, row positions and LAG split each key instead:

1. literal split points of the first order column cut the sequence of every
   key into slices; they are part of the plan, so every branch and every
   recomputation sees the same slices, and building the plan runs no job;
2. one grouped aggregate makes a row per (key, slice), at most one per split
   point and key, and a window over those few rows finds what a slice takes
   over from the slices before;
3. that row joins its slice as a first row of its own, and one window per
   (key, slice) gives the results.

``split_points`` finds points for unknown data in a job of its own, once;
reports whose dates are bounded name them. Without points a key is one slice.

Exact percentiles are found by rank selection: histograms narrow the interval
that holds each rank, in a few passes of grouped aggregates.

All results are exact. The caller must give a total order within the key
(add a unique tiebreak column).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SLICE, _REAL, _VALUE, _LAST = "__slice", "__real", "__value", "__last"

#: Buckets per linear pass of the rank selection, and per octave of the first.
BUCKETS, PER_OCTAVE = 1 << 16, 64
#: A hot key's rows meet the intervals of its ranks in so many parts.
SALTS = 8


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (a NULL key is a group of
    its own, as in PARTITION BY); keeps ``left``'s column order, then the
    right side's other columns."""
    r = right.select(*[F.col(k).alias("__rk_" + k) for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r["__rk_" + k]) for k in keys]
    return left.join(r, cond, how).drop(*["__rk_" + k for k in keys])


def split_points(df: DataFrame, column: str, slices: int) -> list:
    """Values of ``column`` that cut its rows into about ``slices`` even parts,
    from approximate quantiles of numbers or dates (one job, now)."""
    kind = df.schema[column].dataType
    days = isinstance(kind, T.DateType)
    plain = df.select((F.datediff(column, F.lit(dt.date(1970, 1, 1))) if days else F.col(column)).cast("double").alias("v"))
    found = sorted(set(plain.approxQuantile("v", [i / slices for i in range(1, slices)], 0.1 / slices)))
    return [dt.date(1970, 1, 1) + dt.timedelta(days=int(v)) for v in found] if days else found


def month_starts(first: int, last: int) -> list[dt.date]:
    """The first days of all months of the years ``first`` to ``last``."""
    return [dt.date(y, m, 1) for y in range(first, last + 1) for m in range(1, 13)]


def _sliced(df: DataFrame, column: str, splits: Sequence) -> DataFrame:
    """``df`` with the number of split points up to its value of ``column``
    (NULL sorts first)."""
    number = F.lit(0)
    if splits:
        points = sorted(splits)
        number = F.when(F.col(column) >= F.lit(points[-1]), len(points))
        for i in range(len(points) - 1, 0, -1):
            number = number.when(F.col(column) >= F.lit(points[i - 1]), i)
        number = number.otherwise(0)
    return df.withColumn(_SLICE, number)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, splits: Sequence = ()) -> DataFrame:
    """``out`` = sum of ``value`` over rows of the same ``keys`` up to and
    including this row in ``order`` (ROWS frame; ties must not exist)."""
    keys, order = list(keys), list(order)
    rows = _sliced(df, order[0], splits)
    pieces = rows.groupBy(*keys, _SLICE).agg(F.sum(value).alias(_VALUE))
    before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)  # a row per slice
    # NULL while every earlier slice of the key held only NULL values, as SUM is
    carried = pieces.withColumn(_VALUE, F.sum(_VALUE).over(before)).filter(F.col(_VALUE).isNotNull())
    both = rows.withColumn(_VALUE, F.col(value).cast(pieces.schema[_VALUE].dataType)).withColumn(_REAL, F.lit(1)) \
        .unionByName(carried.withColumn(_REAL, F.lit(0)), allowMissingColumns=True)
    upto = Window.partitionBy(*keys, _SLICE).orderBy(_REAL, *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn(out, F.sum(_VALUE).over(upto)).filter(F.col(_REAL) == 1).select(*df.columns, out)


def position(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "pos", splits: Sequence = ()) -> DataFrame:
    """1-based row number within ``keys`` in ``order`` (= ROW_NUMBER())."""
    one = "__one"
    return running_sum(df.withColumn(one, F.lit(1)), keys, order, one, out, splits).drop(one)


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], prefix: str = "previous_",
                  splits: Sequence = ()) -> DataFrame:
    """Adds ``previous_<c>`` = LAG(c) OVER (PARTITION BY keys ORDER BY order)."""
    keys, order = list(keys), list(order)
    rows = _sliced(df, order[0], splits)
    held = list(dict.fromkeys([*order, *columns]))
    last = rows.groupBy(*keys, _SLICE).agg(F.max(F.struct(*held)).alias(_LAST))
    following = Window.partitionBy(*keys).orderBy(_SLICE)  # a row per slice
    carried = last.withColumn(_SLICE, F.lead(_SLICE).over(following)).filter(F.col(_SLICE).isNotNull())
    carried = carried.select(*keys, _SLICE, *[F.col(f"{_LAST}.{c}").alias(c) for c in held if c not in keys], F.lit(0).alias(_REAL))
    both = rows.withColumn(_REAL, F.lit(1)).unionByName(carried, allowMissingColumns=True)
    piece = Window.partitionBy(*keys, _SLICE).orderBy(_REAL, *order)
    lagged = both.select("*", *[F.lag(c).over(piece).alias(prefix + c) for c in columns])
    return lagged.filter(F.col(_REAL) == 1).select(*df.columns, *[prefix + c for c in columns])


def _octave_part(value: Column) -> Column:
    """A whole number that never falls as ``value`` (DOUBLE) grows: its sign
    and the ``PER_OCTAVE``-th part of an octave it lies in; NaN is largest."""
    size = F.floor((2000 + F.least(F.greatest(F.log2(F.abs(value)), F.lit(-1100.0)), F.lit(1100.0))) * PER_OCTAVE)
    return F.when(F.isnan(value), F.lit(1 << 20)).when(value == 0, F.lit(0)).when(value > 0, size).otherwise(-size).cast("int")


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """PERCENTILE_CONT for every ``probs`` entry, grouped by ``keys``.

    Values are counted per (key, value), a partial aggregate, so duplicates
    never travel. The ranks around ``p * (n - 1)`` are then selected by
    histograms: the first counts the values of a key by their part of an
    octave, the next ones divide the interval that holds a rank evenly, each
    with the least and largest value of its buckets. The bucket of a rank
    follows from running counts over the buckets of a key, whose number is
    fixed. Any two DOUBLEs, and any two BIGINTs, are apart or among a few
    thousand values when the last step looks at single values, whatever their
    distribution, so no step sorts or gathers the values of a key.

    NULL values do not count; a key with no other value gets NULL percentiles.
    """
    keys = list(keys)
    kind = df.schema[value].dataType
    passes = 1 if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)) else 2 if isinstance(kind, (T.FloatType, T.DoubleType)) else 3
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__w"))
    number = F.col(value).cast("double")
    rows = counted.select(*keys, F.col(value).alias("__v"), F.when(F.col(value).isNotNull(), F.col("__w")).otherwise(0).alias("__w"),
                          F.coalesce(_octave_part(number), F.lit(-(1 << 20))).alias("__b"),
                          F.pmod(F.xxhash64(value), F.lit(SALTS)).cast("int").alias("__salt"))
    histogram = rows.groupBy(*keys, "__b").agg(F.sum("__w").alias("__w"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    upto = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    histogram = histogram.withColumn("__end", F.sum("__w").over(upto)).withColumn("__n", F.sum("__w").over(whole))
    spot = {name: F.lit(float(p)) * (F.col("__n") - 1) for name, p in probs.items()}
    ranks = F.array_distinct(F.array(*[f(h).cast("bigint") for h in spot.values() for f in (F.floor, F.ceil)]))
    here = F.filter(ranks, lambda r: (r >= F.col("__end") - F.col("__w")) & (r < F.col("__end")))
    found = histogram.select(*keys, "__b", "__lo", "__hi", (F.col("__end") - F.col("__w")).alias("__below"), F.explode(here).alias("__rank"))
    for step in range(passes + 1):
        found = _narrowed(rows, found, keys, single=step == passes)
    picked = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("__rank", "__lo"))).alias("__at"))  # two ranks per percentile
    groups = rows.groupBy(*keys).agg(F.sum("__w").alias("__n"))
    out = join_on_keys(groups, picked, keys, "left")

    def interpolated(h: Column) -> Column:
        low, high = F.col("__at")[F.floor(h).cast("bigint")], F.col("__at")[F.ceil(h).cast("bigint")]
        return F.when(F.col("__n") > 0, low + (h - F.floor(h)) * (high - low))
    return out.select(*keys, *[interpolated(h).alias(name) for name, h in spot.items()])


def _narrowed(rows: DataFrame, found: DataFrame, keys: list[str], single: bool) -> DataFrame:
    """``found`` (the interval __lo to __hi that holds rank __rank, with
    __below values under it) narrowed to one of ``BUCKETS`` even parts, or to
    one of its values."""
    targets = found.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    targets = targets.select(*[F.col(k).alias("__t_" + k) for k in keys], F.col("__b").alias("__tb"), F.col("__salt").alias("__ts"),
                             "__lo", "__hi", "__below", "__rank")
    same = [F.col(k).eqNullSafe(F.col("__t_" + k)) for k in keys]
    inside = (F.col("__v") >= F.col("__lo")) & (F.col("__v") <= F.col("__hi"))
    met = rows.join(targets, [*same, F.col("__b").eqNullSafe(F.col("__tb")), F.col("__salt").eqNullSafe(F.col("__ts")), inside])
    v, lo, hi = (F.col(c).cast("double") for c in ("__v", "__lo", "__hi"))
    part = F.when(hi > lo, F.least(F.floor((v - lo) / (hi - lo) * BUCKETS), F.lit(BUCKETS - 1))).otherwise(0)
    part = F.col("__v") if single else part
    buckets = met.groupBy(*keys, "__b", "__rank", part.alias("__part")).agg(
        F.first("__below").alias("__below"), F.sum("__w").alias("__w"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    upto = Window.partitionBy(*keys, "__b", "__rank").orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.col("__below") + F.sum("__w").over(upto) - F.col("__w")
    buckets = buckets.withColumn("__below", start)
    return buckets.filter((F.col("__rank") >= F.col("__below")) & (F.col("__rank") < F.col("__below") + F.col("__w"))) \
        .select(*keys, "__b", "__lo", "__hi", "__below", "__rank")
