"""Row filters. A row whose test is NULL is dropped, as in SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.functions.flags import all_of, any_of


def _as_of(value: date | datetime | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def filter_denylist(df: DataFrame, col: str, bad: Sequence[str]) -> DataFrame:
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(bad)))


def filter_allowlist_ci(df: DataFrame, col: str, good: Sequence[str]) -> DataFrame:
    return df.filter(F.lower(F.col(col)).isin([g.lower() for g in good]))


def filter_exclude_categories(df: DataFrame, cols: Sequence[str], excluded: Sequence[str]) -> DataFrame:
    return df.filter(all_of([~F.col(c).isin(list(excluded)) for c in cols]))


def filter_flag(df: DataFrame, col: str, value: bool = False) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def filter_bounds(df: DataFrame, bounds: Mapping[str, tuple], inclusive: bool = True) -> DataFrame:
    """Keep rows inside every ``column: (low, high)``; ``None`` leaves that end open."""
    tests = []
    for name, (low, high) in bounds.items():
        c = F.col(name)
        if low is not None:
            tests.append(c >= F.lit(low) if inclusive else c > F.lit(low))
        if high is not None:
            tests.append(c <= F.lit(high) if inclusive else c < F.lit(high))
    return df.filter(all_of(tests)) if tests else df


def filter_any_bound(df: DataFrame, cols: Sequence[str], below: float) -> DataFrame:
    """At least one of the columns is below the bound (the others may be NULL)."""
    return df.filter(any_of([F.col(c) < F.lit(below) for c in cols]))


def filter_null_or_between(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    return df.filter(F.col(col).isNull() | F.col(col).between(low, high))


def filter_recent(df: DataFrame, col: str, months: int, as_of) -> DataFrame:
    return df.filter(F.col(col) >= F.add_months(_as_of(as_of).cast("date"), -months))


def filter_before_now(df: DataFrame, col: str, as_of) -> DataFrame:
    return df.filter(F.col(col) < _as_of(as_of))


def filter_positive_duration(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.filter(F.datediff(F.col(end), F.col(start)) > 0)


def require_complete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.filter(all_of([F.col(c).isNotNull() for c in cols]))


def filter_name_tokens(df: DataFrame, col: str, contains: Sequence[str], without: Sequence[str],
                       flag: str | None = None) -> DataFrame:
    tests = [F.col(col).contains(t) for t in contains] + [~F.col(col).contains(t) for t in without]
    if flag:
        tests.append(F.col(flag))
    return df.filter(all_of(tests))


def filter_codes(df: DataFrame, col: str, codes: Sequence[str], type_col: str, type_code: str) -> DataFrame:
    return df.filter(F.col(col).isin(list(codes)) & (F.col(type_col) == F.lit(type_code)))


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))
