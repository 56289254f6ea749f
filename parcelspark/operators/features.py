"""Column operators: every one adds its columns in a single projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.functions import flags as fl
from parcelspark.functions import scalars as sc


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def flatten_struct(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    return df.withColumns({out: F.col(path) for out, path in paths.items()})


def bool_flags(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    return df.withColumns({out: fl.as_flag(F.col(path)) for out, path in paths.items()})


def keyword_flags(df: DataFrame, col: str, words: Mapping[str, Sequence[str]]) -> DataFrame:
    return df.withColumns({out: fl.has_word(col, w) for out, w in words.items()})


def missing_flag(df: DataFrame, col: str, out: str, none_words: Sequence[str] = ()) -> DataFrame:
    return df.withColumn(out, fl.is_missing(col, none_words))


def keyword_flag_except(df: DataFrame, col: str, out: str, words: Sequence[str], unless: Sequence[str]) -> DataFrame:
    return df.withColumn(out, fl.has_word_except(col, words, unless))


def cross_column_flag(df: DataFrame, out: str, spec: Mapping[str, Sequence[str]]) -> DataFrame:
    return df.withColumn(out, fl.has_word_in_any(dict(spec)))


def default_true_flag(df: DataFrame, col: str, out: str, negatives: Sequence[str]) -> DataFrame:
    return df.withColumn(out, fl.true_unless_word(col, negatives))


def keyword_flag_weak_negation(df: DataFrame, col: str, out: str, word: str, negatives: Sequence[str]) -> DataFrame:
    return df.withColumn(out, fl.has_word_weakly_negated(col, word, negatives))


def other_flag(df: DataFrame, flags: Sequence[str], out: str) -> DataFrame:
    return df.withColumn(out, fl.none_set(flags))


def convert_area_units(df: DataFrame, living: str, living_units: str, lot: str, lot_units: str) -> DataFrame:
    """Living area to whole square feet, lot size to acres, in place."""
    return df.withColumns({living: sc.living_area_sqft(living, living_units), lot: sc.lot_acres(lot, lot_units)})


def cast_rounded_long(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: sc.rounded_long(c) for c in cols})


def safe_year(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, sc.year_or_null(col))


def normalize_text_lower(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.lower(F.col(c)) for c in cols})


def postal_prefix(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, sc.postal_stem(col))


def array_to_text(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: sc.joined_text(c) for c in cols})


def explode_inner(df: DataFrame, col: str, out: str) -> DataFrame:
    """One row per array item; a row with an empty or NULL array is lost."""
    return df.withColumn(out, F.explode(F.col(col)))


def not_null_flag(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(col).isNotNull().cast("int"))


def fill_default(df: DataFrame, cols: Sequence[str], value=0) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in cols})


def fallback_column(df: DataFrame, first: str, second: str, out: str) -> DataFrame:
    """``out`` is the first of the two that is not NULL; both sources go away unless ``out`` is one of them."""
    filled = F.coalesce(F.col(first), F.col(second)).alias(out)
    return df.select(*[c for c in df.columns if c not in (first, second, out)], filled)


def gated_fill(df: DataFrame, cols: Sequence[str], gate: str) -> DataFrame:
    """0 where the value is NULL or the gate flag is 1."""
    return df.withColumns({
        c: F.when(F.col(c).isNull() | F.coalesce(F.col(gate) == 1, F.lit(False)), F.lit(0)).otherwise(F.col(c))
        for c in cols
    })


def merge_flags(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """``out`` is 1 when any flag is 1; the merged flags go away."""
    merged = fl.as_flag(fl.any_of([F.coalesce(F.col(c) == 1, F.lit(False)) for c in cols])).alias(out)
    return df.select(*[c for c in df.columns if c not in cols], merged)


def calendar_parts(df: DataFrame, col: str, year: str = "close_year", month: str = "close_month",
                   quarter: str = "quarter") -> DataFrame:
    c = F.col(col)
    return df.withColumns({year: F.year(c), month: F.month(c), quarter: F.quarter(c)})


def iso_week_parts(df: DataFrame, col: str, year: str = "close_year", week: str = "num_week") -> DataFrame:
    """ISO year and ISO week (1 January may belong to the last week of the year before)."""
    return df.withColumns({year: sc.iso_year(col), week: F.weekofyear(F.col(col))})


def month_start(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, sc.month_start_of(col))


def days_on_market(df: DataFrame, start: str, end: str, out: str = "day_on_market") -> DataFrame:
    return df.withColumn(out, F.datediff(F.col(end), F.col(start)))


def age_at_listing(df: DataFrame, year_added: str, year_built: str, out: str = "building_years_old") -> DataFrame:
    return df.withColumn(out, F.col(year_added) - F.col(year_built))


def stamp_as_of(df: DataFrame, as_of: date, out: str = "close_dt") -> DataFrame:
    return df.withColumn(out, F.lit(as_of).cast("date"))


def scale_round(df: DataFrame, cols: Sequence[str], divisor: float = 1000.0, digits: int = 2) -> DataFrame:
    return df.withColumns({c: sc.round_half_up(F.col(c) / F.lit(divisor), digits) for c in cols})


def coalesce_trend(df: DataFrame, own: str, fill: str) -> DataFrame:
    """Own value, else the backfilled one, else 0; the fill column goes away."""
    return df.withColumn(own, F.coalesce(F.col(own), F.col(fill), F.lit(0.0))).drop(fill)


def point_from_lonlat(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """A point is its two double columns; rows whose latitude is not one are dropped."""
    typed = df.withColumns({lon: F.col(lon).cast("double"), lat: F.col(lat).cast("double")})
    return typed.filter(F.col(lat).between(-90, 90))


def array_count(df: DataFrame, col: str, out: str) -> DataFrame:
    """Array length; NULL for a NULL array."""
    return df.withColumn(out, F.array_size(F.col(col)))


def month_label(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, sc.month_label_of(col))


def base_name(df: DataFrame, col: str, month: str, out: str, suffix: str = "") -> DataFrame:
    """The text before ``_<month>``, plus a suffix."""
    stem = F.substring_index(F.col(col), f"_{month}", 1)
    return df.withColumn(out, F.concat(stem, F.lit(suffix)))


def cast_code_long(df: DataFrame, col: str, strict: bool = False) -> DataFrame:
    """Text code to whole number; a bad code becomes NULL, or an error when ``strict``."""
    c = F.col(col)
    return df.withColumn(col, c.cast("long") if strict else c.try_cast("long"))


def concat_text(df: DataFrame, cols: Sequence[str], out: str, separator: str = "") -> DataFrame:
    """Join texts; NULL when any part is NULL, as ``||`` does."""
    parts = [F.col(cols[0])]
    for c in cols[1:]:
        parts += [F.lit(separator), F.col(c)]
    return df.withColumn(out, F.concat(*parts))
