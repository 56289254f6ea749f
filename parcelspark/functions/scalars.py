"""Scalar column expressions: numbers, units, text and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelspark.functions.flags import as_column

# Unit factors and unit names of the source data.
SQFT_PER_SQM = 10.76391041671
ACRES_PER_SQM = 0.000247105
ACRES_PER_SQFT = 0.0000229568
LIVING_AREA_SQM_UNITS = ["square meters", "sqm", "sm"]
LOT_SQM_UNITS = ["sqm"]
LOT_SQFT_UNITS = ["sqft", "square feet"]


def rounded_long(c: str | Column) -> Column:
    """Nearest whole number, halves away from zero (a bare cast would cut the fraction off)."""
    return F.round(as_column(c).cast("double")).cast("long")


def round_half_up(c: str | Column, digits: int) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d`` on doubles, the same on every engine that has IEEE doubles."""
    scale = float(10 ** digits)
    return F.floor(as_column(c) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def living_area_sqft(area: str, units: str) -> Column:
    in_sqm = F.lower(F.col(units)).isin(LIVING_AREA_SQM_UNITS)
    return F.when(in_sqm, rounded_long(F.col(area).cast("double") * F.lit(SQFT_PER_SQM))).otherwise(rounded_long(area))


def lot_acres(area: str, units: str) -> Column:
    unit, value = F.lower(F.col(units)), F.col(area).cast("double")
    return (
        F.when(unit.isin(LOT_SQM_UNITS), value * F.lit(ACRES_PER_SQM))
        .when(unit.isin(LOT_SQFT_UNITS), value * F.lit(ACRES_PER_SQFT))
        .otherwise(value)
    )


def year_or_null(c: str | Column) -> Column:
    """A four-digit year, or NULL where the text is not one."""
    return F.year(F.try_to_timestamp(as_column(c).cast("string"), F.lit("yyyy")))


def postal_stem(c: str | Column) -> Column:
    code = as_column(c)
    return F.when(F.length(code) > 5, F.split_part(code, F.lit("-"), F.lit(1))).otherwise(code)


def joined_text(c: str | Column, separator: str = ", ") -> Column:
    """Array items as one text; NULL, not '', for an empty array."""
    items = as_column(c)
    return F.when(F.size(items) > 0, F.array_join(items, separator))


def iso_year(c: str | Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), as_column(c)).cast("int")


def month_start_of(c: str | Column) -> Column:
    return F.trunc(as_column(c).cast("date"), "MM")


def month_label_of(c: str | Column) -> Column:
    return F.date_format(as_column(c), "MMM_yyyy")
