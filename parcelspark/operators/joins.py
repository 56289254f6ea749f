"""Equality joins.

No join carries a broadcast hint: Spark broadcasts a side only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold``, and AQE splits the partitions of a hot key otherwise. The star join, whose many tables
would each be below it and fill the driver together, is merged. Lookup tables must have
unique keys, else rows multiply as in any SQL join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.operators.windows import first_per_period, latest_per_key


def join_star_left(base: DataFrame, tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left-join many tables on one key set: one partitioning serves all of them.

    The joins are merges whatever the sizes: broadcast tables, each small enough by itself, add up on the driver and in every
    executor."""
    return reduce(lambda joined, table: joined.join(table.hint("merge"), list(keys), "left"), tables, base)


def join_inner_using(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys), "inner")


def join_dimensions_left(df: DataFrame, dimensions: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    return reduce(lambda joined, dim: joined.join(dim[0], list(dim[1]), "left"), dimensions, df)


def join_on_expression(df: DataFrame, other: DataFrame, key: str, expression: Column, how: str = "left") -> DataFrame:
    """Join on ``df.key = expression(other)``: the expression becomes a column, so the join is a plain equality."""
    return df.join(other.withColumn(key, expression), [key], how)


def join_anti_left_null(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys), "left_anti")


def join_matched_left(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A left join of which only matches are kept, that is an inner join."""
    return left.join(right, list(keys), "inner")


def join_not_in(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose id is not among the known ones. NULL ids match nothing on either side: a NULL among the known ids
    is ignored, and a row without id is not new."""
    known_ids = known.select(key).filter(F.col(key).isNotNull()).distinct()
    return df.filter(F.col(key).isNotNull()).join(known_ids, key, "left_anti")


def join_full_chain(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    return reduce(lambda joined, table: joined.join(table, list(keys), "full"), tables)


def join_time_trend(df: DataFrame, quarter_trend: DataFrame, state_trend: DataFrame, area: str = "GEOID",
                    state: str = "state_prov_short", date_col: str = "close_dt", how: str = "inner") -> DataFrame:
    """Attach quarter trends of an area and month trends of a state by calendar period.

    ``df`` has ``close_year``, ``close_month`` and ``quarter``; each trend counts once per period, by its first date.
    """
    by_quarter = quarter_trend.withColumns({"close_year": F.year(date_col), "quarter": F.quarter(date_col)})
    by_month = state_trend.withColumns({"close_year": F.year(date_col), "close_month": F.month(date_col)})
    quarter_keys = [area, state, "close_year", "quarter"]
    month_keys = [state, "close_year", "close_month"]
    quarters = first_per_period(by_quarter, quarter_keys, date_col).drop(date_col)
    months = first_per_period(by_month, month_keys, date_col).drop(date_col)
    return df.join(quarters, quarter_keys, how).join(months, month_keys, how)


def backfill_latest(df: DataFrame, trend: DataFrame, key: str, columns: Sequence[str], date_col: str, as_of,
                    tie: Sequence[str] = ()) -> DataFrame:
    """Where the first of ``columns`` is NULL take the newest earlier values of the key for all of them; what is still
    NULL becomes 0."""
    latest = latest_per_key(trend, [key], date_col, as_of, tie)
    fills: Mapping[str, str] = {c: f"{c}_fill" for c in columns}
    latest = latest.select(key, *[F.col(c).alias(f) for c, f in fills.items()])
    gate = F.col(columns[0]).isNull()
    joined = df.join(latest, [key], "left")
    return joined.withColumns({
        c: F.coalesce(F.col(c), F.when(gate, F.col(f)), F.lit(0.0)) for c, f in fills.items()
    }).drop(*fills.values())
