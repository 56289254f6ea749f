"""Grouped aggregates. All are sums, maxima or minima, which Spark combines before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.functions.scalars import round_half_up


def max_per_group(df: DataFrame, key: str, array_col: str, out: str) -> DataFrame:
    """Longest array per key; rows with an empty or NULL array do not count."""
    size = F.array_size(F.col(array_col))
    return df.filter(size > 0).groupBy(key).agg(F.max(size).alias(out))


def guarded_percentages(df: DataFrame, keys: Sequence[str], ratios: Mapping[str, tuple[str, str]],
                        maxima: Mapping[str, str] | None = None) -> DataFrame:
    """``100 * sum(part) / sum(whole)`` with two decimals, 0 where the whole sums to 0."""

    def percentage(part: str, whole: str) -> Column:
        total = F.sum(whole)
        share = F.sum(part) / F.nullif(total.cast("double"), F.lit(0.0)) * F.lit(100.0)
        return F.when(total == 0, F.lit(0.0)).otherwise(round_half_up(share, 2))

    columns = [percentage(*pair).alias(out) for out, pair in ratios.items()]
    columns += [F.max(source).alias(out) for out, source in (maxima or {}).items()]
    return df.groupBy(*keys).agg(*columns)


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def concat_agg(df: DataFrame, keys: Sequence[str], col: str, out: str, separator: str = ", ") -> DataFrame:
    """The distinct texts of a group in one, in text order.

    The result is one cell, so it must fit a row: use it for lists of names. Copies are merged before the shuffle.
    """
    unique = df.filter(F.col(col).isNotNull()).select(*keys, col).distinct()
    return unique.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(col)), separator).alias(out))


def argmin_model(df: DataFrame, keys: Sequence[str], metric: str, value: str, out: str,
                 tie: str | None = None) -> DataFrame:
    """``value`` of the row with the smallest metric (NULL metrics aside), first by ``tie`` among equals."""
    order = F.struct(F.col(metric), F.col(tie or value))
    ranked = df.filter(F.col(metric).isNotNull())
    return ranked.groupBy(*keys).agg(F.min_by(F.col(value), order).alias(out), F.min(metric).alias(f"best_{metric}"))


def distinct_ids(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()
