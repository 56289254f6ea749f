"""Ordering, sampling, unions and appends."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.operators.joins import join_not_in
from parcelspark.sources.tables import append_aligned, read_target, tables_like


def sorted_output(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Total order (range-partitioned). For a table that is only read back, ``sortWithinPartitions`` is cheaper."""
    return df.orderBy(*keys)


def bucket_of(key: str | Column, buckets: int) -> Column:
    """A repeatable bucket of a whole-number key, from arithmetic any engine can repeat."""
    c = (F.col(key) if isinstance(key, str) else key).cast("long")
    mixed = F.pmod(c, F.lit(1000003)) * F.lit(7919) + F.lit(104729)
    return F.pmod(F.pmod(mixed, F.lit(1000003)) * F.lit(31337), F.lit(buckets))


def whole_key(df: DataFrame, key: str) -> Column:
    """The key as a whole number: itself, or a hash of a key of another type."""
    return F.col(key) if dict(df.dtypes)[key] in ("bigint", "int") else F.xxhash64(F.col(key))


def sample_fraction(df: DataFrame, fraction: float, key: str) -> DataFrame:
    """A repeatable sample: the same rows on each run and after a lost executor. Text keys are hashed first."""
    return df.filter(bucket_of(whole_key(df, key), 10000) < F.lit(int(round(fraction * 10000))))


def union_all(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def union_matching_tables(spark: SparkSession, pattern: str) -> DataFrame:
    """All rows of all non-empty tables whose name fits the LIKE pattern."""
    names = [r.table_name for r in tables_like(spark, pattern).collect()]
    if not names:
        raise ValueError(f"no table with rows fits {pattern!r}")
    return union_all(*[spark.table(n) for n in names])


def append_new_only(df: DataFrame, target: str, key: str, drop: Sequence[str] | None = None, fill: Sequence[str] = ()) -> DataFrame:
    """Append the rows whose id the target does not have yet, so a second run adds nothing.

    ``drop`` names the columns that may be left out because the target lacks them (all such columns unless given), ``fill`` those
    that may be missing and become NULL; any other difference raises.
    """
    present = read_target(df.sparkSession, target)
    left_out = [c for c in df.columns if c not in present.columns] if drop is None else drop
    append_aligned(join_not_in(df, present, key), target, left_out, fill)
    return read_target(df.sparkSession, target)
