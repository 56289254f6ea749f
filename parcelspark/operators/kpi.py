"""Training-impact measures: before and after a date, ratios, net changes and sums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.operators.joins import join_dimensions_left


def period_indicator(df: DataFrame, date_col: str, training_date: str, out: str = "period_indicator") -> DataFrame:
    """'After' from the training day on, 'Before' until then, NULL for those never trained."""
    after = F.col(date_col) >= F.col(training_date)
    return df.withColumn(out, F.when(after, "After").when(~after, "Before"))


def before_after_kpi(df: DataFrame, keys: Sequence[str], value: str, period: str = "period_indicator") -> DataFrame:
    """Mean of a measure before and after, and the change."""
    before = F.avg(F.when(F.col(period) == "Before", F.col(value)))
    after = F.avg(F.when(F.col(period) == "After", F.col(value)))
    return df.groupBy(*keys).agg(before.alias("before_avg"), after.alias("after_avg"), (after - before).alias("change"))


def mean_rating_per_coach(df: DataFrame, coach: str, date_col: str, rating: str, out: str = "coach_nps") -> DataFrame:
    return df.groupBy(coach, date_col).agg(F.avg(rating).alias(out))


def ratio_kpi(df: DataFrame, keys: Sequence[str], amount: str, per: Mapping[str, Column]) -> DataFrame:
    """Sum of an amount per unit: ``per`` names aggregates such as ``count_distinct`` of agents or a sum of units."""
    ratios = [(F.sum(amount) / F.nullif(unit.cast("double"), F.lit(0.0))).alias(out) for out, unit in per.items()]
    return df.groupBy(*keys).agg(F.sum(amount).alias(f"total_{amount}"), *ratios)


def net_change(df: DataFrame, keys: Sequence[str], kind: str, joined: str, left: str) -> DataFrame:
    came = F.sum(F.when(F.col(kind) == joined, 1).otherwise(0))
    went = F.sum(F.when(F.col(kind) == left, 1).otherwise(0))
    return df.groupBy(*keys).agg(came.alias("joined"), went.alias("departed"), (came - went).alias("net_change"))


def sum_kpis(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], counts: Mapping[str, Column]) -> DataFrame:
    """Sums of columns and counts of the rows that meet a condition."""
    columns = [F.sum(c).alias(out) for out, c in sums.items()]
    columns += [F.sum(F.when(condition, 1).otherwise(0)).alias(out) for out, condition in counts.items()]
    return df.groupBy(*keys).agg(*columns)


def analysis_table(base: DataFrame, inputs: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One wide row per key from prepared inputs."""
    return join_dimensions_left(base, [(table, keys) for table in inputs])
