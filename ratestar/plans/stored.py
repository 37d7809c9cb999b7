"""Stored aggregates of the metric views, and the queries that show them at work."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratestar.operators.changes import snapshot_diff
from ratestar.operators.rollups import Rollup, RoutedView, StoredRollup
from ratestar.plans.views import CLAIMS, ENROLLMENT, EVENTS, QUALITY
from ratestar.session import scratch_folder
from ratestar.sources.star import FrameStar, Star

RATES = ("denominator", "numerator", "total_events", "exclusion_count")

QUALITY_BY_QUARTER = Rollup(QUALITY, "quality_by_quarter", ("measure_id", "measurement_year", "quarter"), RATES, ("measurement_year",))
QUALITY_BY_COUNTY = Rollup(QUALITY, "quality_by_county", ("measure_id", "measurement_year", "quarter", "county_fips"), RATES, ("measurement_year",))
PEOPLE_BY_COUNTY = Rollup(QUALITY, "people_by_county", ("measurement_year", "county_fips"),
                          ("total_events", "distinct_members", "distinct_providers"), ("measurement_year",))
MEMBERS_BY_CLAIM_TYPE = Rollup(CLAIMS, "members_by_claim_type", ("measurement_year", "claim_type", "revenue_code"),
                               ("claim_count", "paid", "unique_members"), ("measurement_year",))
ENROLLED_BY_COUNTY = Rollup(ENROLLMENT, "enrolled_by_county", ("snapshot_month", "county_fips", "is_active"),
                            ("enrolled_members", "active_member_months", "snapshots"), ("snapshot_month",))


#: Columns that tell events apart or that their stored rates come from.
CHANGING = ("event_id", *QUALITY_BY_QUARTER._inputs())


def stored(star: Star, rollup: Rollup, spark) -> StoredRollup:
    """The rollup in a new folder, which goes when the application ends."""
    return rollup.build(star, scratch_folder(spark, rollup.name))


def without_fact(star: Star, rollup: Rollup) -> FrameStar:
    """The dimension tables alone: nothing can be asked of the fact."""
    return FrameStar({t: star.table(t) for t in rollup.view.joins})


def earlier(star: Star) -> Star:
    """The star some changes ago: a seventh of the events of two years was not there, others had other results or counties, some have gone since."""
    events = star.table(EVENTS, CHANGING)
    recent = F.col("measurement_year").isin(1997, 1998)
    kept = events.filter(~recent | (F.col("event_id") % 7 != 0))
    changed = kept.withColumn("in_numerator", F.when(recent & (F.col("event_id") % 11 == 0), ~F.col("in_numerator")).otherwise(F.col("in_numerator")))
    changed = changed.withColumn("quarter", F.when(recent & (F.col("event_id") % 13 == 0), F.col("quarter") % 4 + 1).otherwise(F.col("quarter")))
    gone = events.filter(recent & (F.col("event_id") % 17 == 0)).withColumn("event_id", -F.col("event_id"))
    return FrameStar({EVENTS: changed.unionByName(gone), **{t: star.table(t) for t in QUALITY.joins}})


def refreshed_rates(star: Star, spark) -> DataFrame:
    """Rates by measure and year from aggregates of the earlier star that took in what has changed since."""
    before = earlier(star)
    kept = stored(before, QUALITY_BY_QUARTER, spark)
    two_years = {"measurement_year": [1997, 1998]}
    # Other years have not changed, and a diff of partitions that have would do.
    changes = snapshot_diff(before.table(EVENTS, CHANGING, two_years), star.table(EVENTS, CHANGING, two_years), ["event_id"])
    kept.refresh(changes, star, batch=1)
    return kept.query(without_fact(star, QUALITY_BY_QUARTER), ["measure_name", "measurement_year"],
                      ["total_events", "denominator", "numerator", "performance_rate", "gap_to_threshold"])


def people_by_region(star: Star, spark) -> DataFrame:
    """Distinct members and providers by region and year, from bitmaps by county."""
    kept = stored(star, PEOPLE_BY_COUNTY, spark)
    return kept.query(without_fact(star, PEOPLE_BY_COUNTY), ["region", "measurement_year"], ["total_events", "distinct_members", "distinct_providers"])


def members_by_claim_type(star: Star, spark) -> DataFrame:
    """Distinct members with claims and cost per member over all years, from bitmaps by year."""
    kept = stored(star, MEMBERS_BY_CLAIM_TYPE, spark)
    return kept.query(without_fact(star, MEMBERS_BY_CLAIM_TYPE), ["claim_type"], ["claim_count", "total_paid", "unique_members", "cost_per_member"])


def enrolled_by_region(star: Star, spark) -> DataFrame:
    kept = stored(star, ENROLLED_BY_COUNTY, spark)
    return kept.query(without_fact(star, ENROLLED_BY_COUNTY), ["region"], ["enrolled_members", "active_member_months", "snapshots"])


def monthly_active_members(star: Star, spark) -> DataFrame:
    kept = stored(star, ENROLLED_BY_COUNTY, spark)
    found = kept.query(without_fact(star, ENROLLED_BY_COUNTY), ["snapshot_month"], ["enrolled_members"], where={"is_active": True})
    return found.withColumnRenamed("enrolled_members", "monthly_active_members")


def routed_rates(star: Star, spark) -> DataFrame:
    """Rates and gaps by measure and quarter from the smallest of two stored aggregates that holds them."""
    routed = RoutedView(QUALITY, tuple(stored(star, rollup, spark) for rollup in (QUALITY_BY_COUNTY, QUALITY_BY_QUARTER)))
    return routed.query(star, ["measure_name", "quarter"], ["denominator", "numerator", "performance_rate", "gap_to_threshold"],
                        where={"measurement_year": 2000, "measure_category": ["Diabetes", "Preventive"]})


def routed_counties(star: Star, spark) -> DataFrame:
    """The same by region, which only the larger one holds."""
    routed = RoutedView(QUALITY, tuple(stored(star, rollup, spark) for rollup in (QUALITY_BY_COUNTY, QUALITY_BY_QUARTER)))
    return routed.query(star, ["measure_category", "region"], ["total_events", "exclusion_count", "performance_rate"], how="inner")
