"""One row per key.

All of these are ``row_number() = 1`` windows. Spark limits each group to its best row before the shuffle too
(``WindowGroupLimit`` on both sides of the exchange), so a key that holds a large share of the rows sends one row per
input task and no task ever sorts the whole group. Every ordering needs a tie-break that makes it total. All rows of a task are
sorted for this, so ``top1_by_distance``, whose candidates are many times the keys, first finds the least distance by hashing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "row_in_group"


def top1(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def top1_by_distance(df: DataFrame, key: str, distance: str, tie: Sequence[str]) -> DataFrame:
    """The nearest row of each key; a row without a distance comes before all others.

    Rows are not sorted: one pass hashes the least distance of each key, a second keeps the rows at it, and only these are ordered
    by ``tie``. If ``df`` comes partitioned by ``key``, its rows are neither shuffled nor spilled, else the second pass shuffles them.
    """
    order = [F.col(distance).asc(), *tie]
    far, missing, of = "least_in_group", "missing_in_group", "group_key"
    known = df.filter(F.col(key).isNotNull())
    least = known.groupBy(F.col(key).alias(of)).agg(F.min(distance).alias(far), F.max(F.col(distance).isNull()).alias(missing))
    at_least = F.when(F.col(missing), F.col(distance).isNull()).otherwise(F.col(distance) == F.col(far))
    near = known.join(least.hint("shuffle_hash"), (F.col(key) == F.col(of)) & at_least).select(*df.columns)
    return top1(near, [key], order).unionByName(top1(df.filter(F.col(key).isNull()), [key], order))


def top1_best_metric(df: DataFrame, key: str, metric: str, tie: Sequence[str]) -> DataFrame:
    return top1(df, [key], [F.col(metric).desc_nulls_last(), *tie])


def first_per_period(df: DataFrame, keys: Sequence[str], date_col: str, tie: Sequence[str] = ()) -> DataFrame:
    return top1(df, keys, [F.col(date_col).asc(), *tie])


def latest_per_key(df: DataFrame, keys: Sequence[str], date_col: str, as_of, tie: Sequence[str] = ()) -> DataFrame:
    """The newest row before ``as_of``."""
    cut = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return top1(df.filter(F.col(date_col) < cut), keys, [F.col(date_col).desc(), *tie])


def dedupe_by_id(df: DataFrame, key: str, tie: Sequence[str | Column]) -> DataFrame:
    """One row per id; ``tie`` decides which one, so a rerun keeps the same row."""
    return top1(df, [key], list(tie))
