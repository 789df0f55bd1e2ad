"""Aggregate-based operators that replace per-key windows and self joins.

Everything here is a grouped aggregate (partial aggregation before the
shuffle, so a hot key costs one combined row per task) followed, where
needed, by an equi-join whose right side has one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabula.operators.ordered import join_on_keys


def ties_for_max(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Rows whose ``measure`` equals the maximum of their key group.

    ``RANK() OVER (PARTITION BY keys ORDER BY measure DESC) = 1``, ties kept.
    The rank limit is applied in every task before the shuffle (window group
    limit), so a hot key sends only the rows that tie for its best in a task,
    and ``df`` is read once. NULL keys form one group (PARTITION BY); NULL
    measures come last, so a group of only NULLs ties as a whole.
    """
    return _ties(df, keys, F.desc_nulls_last(measure))


def _ties(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("__rank", F.rank().over(best)).filter(F.col("__rank") <= 1).drop("__rank")


def ties_for_min(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    return _ties(df, keys, F.asc_nulls_last(measure))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   columns: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple per key (ROW_NUMBER() ... DESC = 1).

    ``max(struct(order..., payload...))`` is an ordinary partial aggregate;
    ``order`` must end in a unique tiebreak so the pick is deterministic.
    """
    keys = list(keys)
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c).alias("__p_" + c) for c in columns])
    return (df.groupBy(*keys).agg(F.max(packed).alias("__top"))
            .select(*keys, *[F.col("__top." + c).alias(c) for c in order if c not in columns],
                    *[F.col("__top.__p_" + c).alias(c) for c in columns]))


def window_aggregate(df: DataFrame, keys: Sequence[str], agg: Column, out: str) -> DataFrame:
    """``agg OVER (PARTITION BY keys)`` attached to every row.

    Aggregate per key (partial), then equi-join back: the right side has one
    row per key, so AQE can split a hot key's left rows across tasks.
    """
    keys = list(keys)
    per_key = df.groupBy(*keys).agg(agg.alias(out))
    return join_on_keys(df, per_key, keys)  # NULL keys are one group, as in PARTITION BY


def day_number(col: str | Column) -> Column:
    """Days since 1970-01-01 as BIGINT (for sums of dates)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("bigint")


def pair_totals(left: DataFrame, right: DataFrame, key: str, date_col: str) -> DataFrame:
    """For every key: number of (left, right) row pairs, the pairs where both
    dates exist, and the sum of ``right.date - left.date`` over those, without
    forming the pairs: sum over pairs (r - l) = n_l * sum(r) - n_r * sum(l),
    counting and summing non-NULL dates only.
    """
    def side(df, n, nn, total):
        return df.groupBy(key).agg(F.count(F.lit(1)).alias(n), F.count(date_col).alias(nn),
                                   F.sum(day_number(date_col)).alias(total))
    lt, rt = side(left, "n_l", "nn_l", "s_l"), side(right, "n_r", "nn_r", "s_r")
    return lt.join(rt, key).select(
        key, (F.col("n_l") * F.col("n_r")).alias("pairs"),
        (F.col("nn_l") * F.col("nn_r")).alias("dated_pairs"),
        (F.col("nn_l") * F.coalesce(F.col("s_r"), F.lit(0))
         - F.col("nn_r") * F.coalesce(F.col("s_l"), F.lit(0))).alias("diff_sum"))


def band_pairs(left: DataFrame, right: DataFrame, key: str, date_col: str, max_gap: int) -> DataFrame:
    """Pairs (l, r) of the same key with 0 <= r.date - l.date <= max_gap.

    Both sides are first counted per (key, date). Each left date is copied to
    its own and the next block of ``max_gap + 1`` days, then equi-joined on
    (key, block): only dates at most two blocks apart ever meet, so the work
    per key is bounded by the band width, not by the key's row count.
    Returns (key, gap, pairs) where ``pairs`` is the row-pair multiplicity.
    """
    width = max_gap + 1
    lt = left.groupBy(key, date_col).agg(F.count(F.lit(1)).alias("n_l"))
    rt = right.groupBy(key, date_col).agg(F.count(F.lit(1)).alias("n_r"))
    lt = lt.select(key, day_number(date_col).alias("d_l"), "n_l")
    rt = rt.select(key, day_number(date_col).alias("d_r"), "n_r")
    home = F.floor(F.col("d_l") / width).cast("bigint")
    lt = lt.withColumn("block", F.explode(F.array(home, home + 1)))
    rt = rt.withColumn("block", F.floor(F.col("d_r") / width).cast("bigint"))
    gap = F.col("d_r") - F.col("d_l")
    return (lt.join(rt, [key, "block"])
            .filter((gap >= 0) & (gap <= max_gap))
            .select(key, gap.alias("gap"), (F.col("n_l") * F.col("n_r")).alias("pairs")))
