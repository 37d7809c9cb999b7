"""Period comparisons, running totals and rolling averages.

For rows that are already aggregated to one per group and period: a window
then holds as many rows as the calendar has periods, not as the data has rows.
``previous``, ``following`` and ``rolling_average`` go row by row, so a missing
period is stepped over; those ending in ``_in_time`` go by distance in time, so
next to a missing period there is nothing to compare with.

Groups that are too long for one task (days of a century, rows that are not
periods at all) are for ``long_running_total`` and ``long_rolling_average``, which
cut them into blocks of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratestar.operators.ranking import numbered

#: Rows of a group in one block.
BLOCK_ROWS = 1 << 16


def _periods(by: Sequence[str], period: Sequence[str]):
    return Window.partitionBy(*by).orderBy(*period)


def previous(df: DataFrame, by: Sequence[str], period: Sequence[str], value: str, name: str) -> DataFrame:
    return df.withColumn(name, F.lag(value).over(_periods(by, period)))


def following(df: DataFrame, by: Sequence[str], period: Sequence[str], value: str, name: str) -> DataFrame:
    return df.withColumn(name, F.lead(value).over(_periods(by, period)))


def change(df: DataFrame, value: str, other: str, name: str, digits: int = 2) -> DataFrame:
    """``value`` minus ``other``, rounded."""
    return df.withColumn(name, F.round(F.col(value) - F.col(other), digits))


def running_total(df: DataFrame, by: Sequence[str], period: Sequence[str], value: str, name: str) -> DataFrame:
    """Sum up to and with the current period (rows of an equal period together)."""
    window = _periods(by, period).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(window))


def rolling_average(df: DataFrame, by: Sequence[str], period: Sequence[str], value: str, name: str,
                    periods: int = 3, digits: int = 0) -> DataFrame:
    """Average of the current row and the rows before it, ``periods`` in all."""
    window = _periods(by, period).rowsBetween(1 - periods, Window.currentRow)
    return df.withColumn(name, F.round(F.avg(value).over(window), digits))


# By distance in time

def quarter_number(year: str = "measurement_year", quarter: str = "quarter") -> Column:
    """Quarters counted on, so that neighbours differ by one."""
    return (F.col(year) * 4 + F.col(quarter)).cast("long")


def month_number(day: str) -> Column:
    return (F.year(day) * 12 + F.month(day)).cast("long")


def _at_distance(by: Sequence[str], number: Column, first: int, last: int):
    return Window.partitionBy(*by).orderBy(number).rangeBetween(first, last)


def previous_in_time(df: DataFrame, by: Sequence[str], number: Column, value: str, name: str, distance: int = 1) -> DataFrame:
    """The value ``distance`` periods earlier (later if negative); NULL if there is no such row.

    ``number`` counts periods, as ``quarter_number`` does.
    """
    return df.withColumn(name, F.first(value).over(_at_distance(by, number, -distance, -distance)))


def rolling_average_in_time(df: DataFrame, by: Sequence[str], number: Column, value: str, name: str,
                            periods: int = 3, digits: int = 0) -> DataFrame:
    """Average of the values in the current period and those before it, ``periods`` in all; missing ones do not count."""
    return df.withColumn(name, F.round(F.avg(value).over(_at_distance(by, number, 1 - periods, 0)), digits))


def with_missing_periods(df: DataFrame, by: Sequence[str], number: Column, name: str) -> DataFrame:
    """All periods from each group's first to its last, numbered ``name``; columns of added ones are NULL but for ``by``.

    A group without any period number is left out.
    """
    rows = df.withColumn(name, number)
    ends = rows.groupBy(*by).agg(F.min(name).alias("_first"), F.max(name).alias("_last")).filter(F.col("_first").isNotNull())
    every = ends.select(*by, F.explode(F.sequence("_first", "_last")).alias(name)).alias("e")
    condition = F.col(f"e.{name}") == F.col(f"r.{name}")
    for c in by:
        condition = condition & F.col(f"e.{c}").eqNullSafe(F.col(f"r.{c}"))
    return every.join(rows.alias("r"), condition, "left").select(
        *[F.col(f"e.{c}") for c in by], f"e.{name}", *[F.col(f"r.{c}") for c in df.columns if c not in by])


# Groups of any length

def _in_blocks(df: DataFrame, by: Sequence[str], period: Sequence[str], block_rows: int) -> DataFrame:
    """Rows with ``_place`` in their group (from 0) and ``_block`` of so many places.

    Rows of an equal period come in the order of a hash of the row.
    """
    rows = numbered(df, by, period[0], False, period[1:]).withColumn("_place", F.col("_place").cast("long") - 1).drop("_total")
    return rows.withColumn("_block", F.expr(f"_place div {block_rows}"))


def long_running_total(df: DataFrame, by: Sequence[str], period: Sequence[str], value: str, name: str,
                       block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Sum up to and with the current row, for groups of any length.

    Each block of a group is summed, the sums of the blocks before it are carried
    over, and only the rows of a block are added up one after the other.
    """
    rows = _in_blocks(df, by, period, block_rows)
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(*by, "_block").agg(F.sum(value).alias("_sum")).withColumn("_carried", F.sum("_sum").over(before)).drop("_sum")
    inside = Window.partitionBy(*by, "_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    condition = F.col("r._block") == F.col("c._block")
    for c in by:
        condition = condition & F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}"))
    joined = rows.withColumn("_inside", F.sum(value).over(inside)).alias("r").join(carried.alias("c"), condition)
    total = F.when(F.col("_inside").isNull(), F.col("_carried")).otherwise(F.col("_inside") + F.coalesce("_carried", F.lit(0)))
    return joined.select(*[F.col(f"r.{c}") for c in df.columns], total.alias(name))


def long_rolling_average(df: DataFrame, by: Sequence[str], period: Sequence[str], value: str, name: str,
                         periods: int = 3, digits: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Average of the current row and the rows before it, ``periods`` in all, for groups of any length.

    The last rows of a block are seen by the next one too.
    """
    block_rows = max(block_rows, periods)
    rows = _in_blocks(df, by, period, block_rows)
    seen_by = F.array(F.col("_block"), F.when(F.col("_place") % block_rows > block_rows - periods, F.col("_block") + 1))
    copies = rows.withColumn("_in", F.explode(F.array_compact(seen_by)))
    window = Window.partitionBy(*by, "_in").orderBy("_place").rowsBetween(1 - periods, Window.currentRow)
    averaged = copies.withColumn(name, F.round(F.avg(value).over(window), digits))
    return averaged.filter("_in = _block").select(*df.columns, name)
