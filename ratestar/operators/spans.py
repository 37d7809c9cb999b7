"""Months of enrollment from spans of days, and cost per member and month.

A span of any length becomes a row for each calendar year it touches, with the months of
that year as twelve bits. The bits of a member and year are combined by OR, in map
tasks first: overlapping spans count a month once, and a member with very many spans is one
row per task. No row is made for a day, or for a month before it is asked for.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ratestar.sources.star import Star

#: Periods of a year: how many months each has.
PERIODS = {"year": 12, "quarter": 3, "month": 1}


def months_of_spans(spans: DataFrame, keys: Sequence[str], start: str, end: str, until: dt.date) -> DataFrame:
    """``keys``, ``year`` and ``months``: a bit for each month (the lowest is January) with a day in any span.

    A span without end lasts up to ``until``, which ends all others too. Spans without
    start, or that end before they start, hold no month.
    """
    last = F.least(F.coalesce(F.col(end), F.lit(until)), F.lit(until))
    valid = spans.select(*keys, F.col(start).alias("_first"), last.alias("_last")).filter("_first <= _last")
    years = valid.select(*keys, "_first", "_last", F.explode(F.sequence(F.year("_first"), F.year("_last"))).alias("year"))
    low = F.when(F.year("_first") == F.col("year"), F.month("_first") - 1).otherwise(F.lit(0))
    high = F.when(F.year("_last") == F.col("year"), F.month("_last")).otherwise(F.lit(12))
    bits = (F.call_function("shiftleft", F.lit(1), high) - F.call_function("shiftleft", F.lit(1), low)).alias("_bits")
    return years.select(*keys, "year", bits).groupBy(*keys, "year").agg(F.bit_or("_bits").alias("months"))


def _periods(months: Column, length: int) -> Column:
    """An array of (period of the year from 1, months in it) for periods with months."""
    ones = (1 << length) - 1
    parts = [F.struct(F.lit(i + 1).alias("period"), F.bit_count(months.bitwiseAND(F.lit(ones << i * length))).alias("months"))
             for i in range(12 // length)]
    return F.filter(F.array(*parts), lambda part: part["months"] > 0)


def member_months(star: Star, until: dt.date, per: str = "year") -> DataFrame:
    """``member_id, year, period, member_months`` of the enrollment spans in the member table; ``per`` is year, quarter or month."""
    spans = star.table("dim_member", ["member_id", "enrollment_start_dt", "enrollment_end_dt"])
    months = months_of_spans(spans, ["member_id"], "enrollment_start_dt", "enrollment_end_dt", until)
    return months.select("member_id", "year", F.explode(_periods(F.col("months"), PERIODS[per])).alias("p")).select(
        "member_id", "year", "p.period", F.col("p.months").cast("long").alias("member_months"))


def cost_per_member_month(star: Star, until: dt.date, by: Sequence[str] = (), per: str = "year") -> DataFrame:
    """Amount paid and months enrolled by period and member attributes, and the one over the other.

    Members without claims count with their months, and claims of members who
    are not enrolled with their amount. Both sides are summed per member and period, put
    together without a join, and meet the member table once per member and period. Months that
    nobody is enrolled in give an empty cost.
    """
    length = PERIODS[per]
    claims = star.table("fact_claims", ["member_id", "service_date", "paid_amount"])
    paid = claims.select("member_id", F.year("service_date").alias("year"), F.expr(f"(month(service_date) - 1) div {length} + 1").cast("int").alias("period"),
                         F.col("paid_amount").alias("paid"), F.lit(1).cast("long").alias("claims")).filter(F.col("year") <= until.year)
    months = member_months(star, until, per)
    rows = months.unionByName(paid, allowMissingColumns=True)
    if by:
        rows = rows.groupBy("member_id", "year", "period").agg(*[F.sum(c).alias(c) for c in ("member_months", "paid", "claims")])
        rows = rows.join(star.table("dim_member", ["member_id", *by]), "member_id", "left")
    sums = rows.groupBy(*by, "year", "period").agg(
        F.coalesce(F.sum("member_months"), F.lit(0)).alias("member_months"), F.coalesce(F.sum("claims"), F.lit(0)).alias("claim_count"),
        F.round(F.sum("paid"), 2).alias("total_paid"))
    return sums.withColumn("cost_per_member_month", F.round(F.coalesce("total_paid", F.lit(0)) / F.nullif("member_months", F.lit(0)), 2))
