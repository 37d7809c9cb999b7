"""Named filters and expressions. Each returns a Column over star columns.

Filters that metric views use take ``col``, which finds a column by its name.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, functions as F

from ratestar.schema import HIGHER, LOWER


# Filters

def active_members() -> Column:
    return F.col("is_active") == F.lit(True)


def eligible_for_measure() -> Column:
    return (F.col("in_denominator") == F.lit(True)) & (F.col("exclusion_applied") == F.lit(False))


Lookup = Callable[[str], Column]


def high_priority_measures(col: Lookup = F.col) -> Column:
    return col("high_priority_flag") == F.lit(True)


def star_rating_measures(col: Lookup = F.col) -> Column:
    return col("star_rating_flag") == F.lit(True)


def in_year(year: int, col: Lookup = F.col) -> Column:
    return col("measurement_year") == F.lit(year)


def in_quarter(year: int, quarter: int, col: Lookup = F.col) -> Column:
    return in_year(year, col) & (col("quarter") == F.lit(quarter))


def at_risk() -> Column:
    """The rate misses its threshold, whichever way is better.

    For aggregated rows that carry direction, rate and threshold.
    """
    rate, threshold = F.col("performance_rate"), F.col("regulatory_threshold")
    direction = F.col("reporting_direction")
    return ((direction == HIGHER) & (rate < threshold)) | ((direction == LOWER) & (rate > threshold))


# Row conditions of the rate. An unknown exclusion flag makes both NULL, so
# such a row is in neither count; do not coalesce it.

def counts_as_eligible() -> Column:
    return F.col("in_denominator") & ~F.col("exclusion_applied")


def counts_as_met() -> Column:
    return F.col("in_numerator") & ~F.col("exclusion_applied")


# The rate

def raw_rate(numerator: Column, denominator: Column) -> Column:
    """Unrounded percentage; NULL for an empty denominator."""
    return numerator * F.lit(Decimal("100.0")) / F.nullif(denominator, F.lit(0))


def rate(numerator: Column, denominator: Column) -> Column:
    return F.round(raw_rate(numerator, denominator), 2)


def gap(threshold: Column, numerator: Column, denominator: Column) -> Column:
    """Threshold minus the unrounded rate: positive means below the threshold."""
    return F.round(threshold - raw_rate(numerator, denominator), 2)


# Expressions

def measurement_quarter(col: Lookup = F.col) -> Column:
    return F.concat(col("measurement_year").cast("string"), F.lit("-Q"), col("quarter").cast("string"))


def member_age(as_of: dt.date | None = None, col: Lookup = F.col) -> Column:
    """Age in whole years of 365.25 days, today unless ``as_of`` is given."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return F.floor(F.datediff(today, col("date_of_birth")) / F.lit(Decimal("365.25"))).cast("int")


def enrollment_month_label() -> Column:
    return F.date_format("snapshot_month", "yyyy-MM")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def zero_padded(number: Column, width: int) -> Column:
    """Digits padded to ``width``; longer numbers stay whole, so keys stay distinct."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))
