"""Ready-made questions over the star, each a DataFrame sorted for reading.

"This year" and "this quarter" are arguments, never today's date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ratestar.functions import snippets as s
from ratestar.operators import ranking, trends
from ratestar.plans.views import CLAIMS, ENROLLMENT, QUALITY
from ratestar.schema import BEHAVIORAL, DIABETES, HIGHER
from ratestar.sources.star import Star

PROVIDER = ["provider_name", "provider_type"]


def enrollment_by_county(star: Star, limit: int = 15) -> DataFrame:
    """Counties with the most members. Ties at the limit go by county and state."""
    return (ENROLLMENT.query(star, ["county_name", "state_code"], ["enrolled_members", "active_member_months"],
                             how="inner")
            .orderBy(F.desc("enrolled_members"), "county_name", "state_code").limit(limit))


def quarter_metrics(star: Star, year: int, quarter: int) -> DataFrame:
    """Counts, rate and gap of every measure in one quarter."""
    return QUALITY.query(
        star, ["measure_name", "measure_category", "reporting_direction", "regulatory_threshold"],
        ["denominator", "numerator", "performance_rate", "gap_to_threshold"],
        where={"measurement_year": year, "quarter": quarter}).orderBy("measure_name")


def measures_at_risk(star: Star, year: int) -> DataFrame:
    """Measures that miss their threshold in one year, widest gap first."""
    rates = QUALITY.query(
        star, ["measure_name", "measure_category", "measurement_year", "reporting_direction", "regulatory_threshold"],
        ["performance_rate", "gap_to_threshold", "denominator"], where={"measurement_year": year})
    return rates.filter(s.at_risk()).orderBy(F.abs("gap_to_threshold").desc(), "measure_name")


def years_compared(star: Star, years: list[int] | None = None) -> DataFrame:
    """Rate and counts of every measure, one row per year; all years unless given."""
    return QUALITY.query(
        star, ["measure_name", "measure_category", "measurement_year"],
        ["performance_rate", "denominator", "numerator", "distinct_members"],
        where=None if years is None else {"measurement_year": years}).orderBy("measure_name", "measurement_year")


def diabetes_performance(star: Star, year: int) -> DataFrame:
    return QUALITY.query(
        star, ["measure_name", "reporting_direction", "regulatory_threshold"],
        ["denominator", "numerator", "performance_rate", "gap_to_threshold"],
        where={"measure_category": DIABETES, "measurement_year": year}).orderBy("measure_name")


def behavioral_health_by_quarter(star: Star) -> DataFrame:
    rates = QUALITY.query(
        star, ["measure_name", "measurement_year", "quarter"], ["denominator", "numerator", "performance_rate"],
        where={"measure_category": BEHAVIORAL})
    return (rates.withColumn("measurement_quarter", s.measurement_quarter())
            .orderBy("measure_name", "measurement_year", "quarter"))


def most_compliant_providers(star: Star, year: int, limit: int = 10) -> DataFrame:
    """Providers with the highest rate over the measures where higher is better."""
    rates = QUALITY.query(
        star, PROVIDER, ["denominator", "numerator", "performance_rate"],
        where={"reporting_direction": HIGHER, "measurement_year": year}, how="inner")
    return rates.orderBy(F.desc_nulls_last("performance_rate"), F.desc("denominator"), *PROVIDER).limit(limit)


def enrollment_by_aid_category(star: Star) -> DataFrame:
    """Active members per month and eligibility category."""
    members = ENROLLMENT.query(star, ["snapshot_month", "aid_category"], ["enrolled_members"],
                               where={"is_active": True})
    return (members.withColumnRenamed("enrolled_members", "monthly_active_members")
            .withColumn("enrollment_month_label", s.enrollment_month_label())
            .orderBy("snapshot_month", "aid_category"))


def provider_measure_rates(star: Star, year: int, by_npi: bool = False) -> DataFrame:
    """Rounded and unrounded rate per provider and measure where higher is better.

    Providers of equal name and type are one row unless ``by_npi``.
    """
    provider = ["provider_npi", *PROVIDER] if by_npi else PROVIDER
    return _rates(star, [*provider, "measure_name"],
                  {"measurement_year": year, "reporting_direction": HIGHER})


def _rates(star: Star, dimensions: list[str], where: dict) -> DataFrame:
    rates = QUALITY.query(star, dimensions, ["numerator", "denominator", "performance_rate"], where=where, how="inner")
    return rates.select(*dimensions, "performance_rate",
                        s.raw_rate(F.col("numerator"), F.col("denominator")).alias("raw_rate"))


def ranked_providers(star: Star, year: int, by_npi: bool = False) -> DataFrame:
    """Rank of every provider within each measure, by the unrounded rate."""
    rates = provider_measure_rates(star, year, by_npi)
    ranked = ranking.rank(rates, ["measure_name"], "raw_rate", "provider_rank").drop("raw_rate")
    return ranked.orderBy("measure_name", "provider_rank", *PROVIDER)


def densely_ranked_providers(star: Star, year: int) -> DataFrame:
    rates = provider_measure_rates(star, year)
    ranked = ranking.dense_rank(rates, ["measure_name"], "raw_rate", "provider_rank").drop("raw_rate")
    return ranked.orderBy("measure_name", "provider_rank", *PROVIDER)


def top_providers(star: Star, year: int, n: int = 3) -> DataFrame:
    """The ``n`` best providers of each measure; ties go by name and type."""
    rates = provider_measure_rates(star, year)
    return (ranking.top_n(rates, n, ["measure_name"], "raw_rate", "rn", ties=PROVIDER)
            .drop("raw_rate").orderBy("measure_name", "rn"))


def measure_period_rates(star: Star, period: list[str]) -> DataFrame:
    return QUALITY.query(star, ["measure_name", *period], ["performance_rate"], how="inner")


def quarter_over_quarter(star: Star) -> DataFrame:
    """Change of the rounded rate against the quarter before, per measure."""
    period = ["measurement_year", "quarter"]
    rates = trends.previous(measure_period_rates(star, period), ["measure_name"], period,
                            "performance_rate", "prev_quarter_rate")
    return trends.change(rates, "performance_rate", "prev_quarter_rate", "qoq_change").orderBy("measure_name", *period)


def next_quarter(star: Star) -> DataFrame:
    """Change of the rounded rate up to the quarter after, per measure."""
    period = ["measurement_year", "quarter"]
    rates = trends.following(measure_period_rates(star, period), ["measure_name"], period,
                             "performance_rate", "next_quarter_rate")
    return trends.change(rates, "next_quarter_rate", "performance_rate", "next_change").orderBy("measure_name", *period)


def year_over_year(star: Star) -> DataFrame:
    period = ["measurement_year"]
    rates = trends.previous(measure_period_rates(star, period), ["measure_name"], period,
                            "performance_rate", "prev_year_rate")
    return trends.change(rates, "performance_rate", "prev_year_rate", "yoy_change").orderBy("measure_name", *period)


def provider_rates(star: Star, year: int) -> DataFrame:
    """One rate per provider over all measures, whichever way is better."""
    return _rates(star, PROVIDER, {"measurement_year": year}).withColumnRenamed(
        "performance_rate", "overall_performance_rate")


def provider_tiles(star: Star, year: int, tiles: int, name: str, keep_unrated: bool = True) -> DataFrame:
    """Providers in ``tiles`` equal groups, lowest unrounded rate first.

    Providers without a rate sort first, so into the lowest group, unless
    ``keep_unrated`` is off. Ties go by name and type.
    """
    rates = provider_rates(star, year)
    if not keep_unrated:
        rates = rates.filter(F.col("raw_rate").isNotNull())
    return ranking.ntile(rates, tiles, [], "raw_rate", name, ties=PROVIDER).drop("raw_rate")


def bottom_quartile_providers(star: Star, year: int, keep_unrated: bool = True) -> DataFrame:
    tiles = provider_tiles(star, year, 4, "performance_quartile", keep_unrated)
    return tiles.filter("performance_quartile = 1").orderBy(F.asc_nulls_first("overall_performance_rate"), *PROVIDER)


def provider_deciles(star: Star, year: int) -> DataFrame:
    return provider_tiles(star, year, 10, "performance_decile").orderBy("performance_decile", *PROVIDER)


def monthly_active_members(star: Star) -> DataFrame:
    return (ENROLLMENT.query(star, ["snapshot_month"], ["enrolled_members"], where={"is_active": True})
            .withColumnRenamed("enrolled_members", "monthly_active_members"))


def cumulative_enrollment(star: Star) -> DataFrame:
    """Active members per month, their running sum and a three-month average.

    The running sum counts member-months: a member active in two months counts twice.
    """
    months = monthly_active_members(star)
    total = trends.running_total(months, [], ["snapshot_month"], "monthly_active_members", "cumulative_member_months")
    return trends.rolling_average(total, [], ["snapshot_month"], "monthly_active_members",
                                  "rolling_3mo_avg").orderBy("snapshot_month")


def percent(share: Column) -> Column:
    return F.round(share * 100, 1)


def county_percentiles(star: Star, year: int, category: str = DIABETES) -> DataFrame:
    """Percentile of every county within each measure of a category, by the rounded rate."""
    county = ["county_name", "state_code"]
    rates = QUALITY.query(star, [*county, "measure_name"], ["performance_rate"],
                          where={"measurement_year": year, "measure_category": category}, how="inner")
    shares = ranking.percent_rank(rates, ["measure_name"], "performance_rate", "percentile_rank")
    return (shares.withColumn("percentile_rank", percent(F.col("percentile_rank")))
            .orderBy("measure_name", F.desc("percentile_rank"), *county))


def claims_cost(star: Star) -> DataFrame:
    """Claims and their cost by setting and eligibility category, costliest first."""
    return CLAIMS.query(star, ["claim_type", "aid_category"],
                        ["claim_count", "total_paid", "avg_paid", "unique_members"], how="inner").orderBy(
        F.desc("total_paid"), "claim_type", "aid_category")


def claims_by_condition(star: Star) -> DataFrame:
    """Claims and cost per chronic condition; a member's claims count once for each of the conditions.

    Claims are summed per member before the join and the spread.
    """
    per_member = star.table("fact_claims", ["member_id", "paid_amount"]).groupBy("member_id").agg(
        F.count(F.lit(1)).alias("claims"), F.sum("paid_amount").alias("paid"))
    members = star.table("dim_member", ["member_id", "chronic_condition_flags"])
    return (per_member.join(members, "member_id")
            .select("claims", "paid", F.explode("chronic_condition_flags").alias("condition"))
            .groupBy("condition").agg(
                F.count(F.lit(1)).alias("members"), F.sum("claims").alias("claim_count"),
                F.round(F.sum("paid"), 2).alias("total_paid"))
            .orderBy(F.desc("total_paid"), "condition"))


def claims_by_code(star: Star, codes: str = "dx_codes") -> DataFrame:
    """Claims, members and cost per code; claims without a code are left out."""
    claims = star.table("fact_claims", ["member_id", "paid_amount", codes])
    return (claims.select("member_id", "paid_amount", F.explode(codes).alias("code"))
            .groupBy("code").agg(
                F.count(F.lit(1)).alias("claim_count"), F.countDistinct("member_id").alias("unique_members"),
                F.round(F.sum("paid_amount"), 2).alias("total_paid"))
            .orderBy(F.desc("claim_count"), "code"))


def claims_with_code(star: Star, code: str) -> DataFrame:
    """Claims that carry a diagnosis code, by setting."""
    claims = star.table("fact_claims", ["claim_type", "dx_codes", "paid_amount"])
    return (claims.filter(F.array_contains("dx_codes", code)).groupBy("claim_type").agg(
        F.count(F.lit(1)).alias("claim_count"), F.round(F.sum("paid_amount"), 2).alias("total_paid"))
        .orderBy("claim_type"))


# Number, title and function of every question; arguments beyond the star are
# the year and quarter that count as current, where a question needs them.
CATALOG = {
    "Q-01": ("Members enrolled per county", enrollment_by_county),
    "Q-02": ("Measures in one quarter", quarter_metrics),
    "Q-03": ("Measures likely to miss their threshold", measures_at_risk),
    "Q-04": ("Measures year by year", years_compared),
    "Q-05": ("Diabetes measures in one year", diabetes_performance),
    "Q-06": ("Behavioral-health measures per quarter", behavioral_health_by_quarter),
    "Q-07": ("Providers with the best rates", most_compliant_providers),
    "Q-08": ("Active members per month and eligibility category", enrollment_by_aid_category),
    "Q-09": ("Providers ranked within each measure", ranked_providers),
    "Q-10": ("Change of each measure from quarter to quarter", quarter_over_quarter),
    "Q-11": ("Providers in the lowest quarter", bottom_quartile_providers),
    "Q-12": ("Enrollment added up, with a moving average", cumulative_enrollment),
    "Q-13": ("Percentile of each county for diabetes measures", county_percentiles),
    "Q-14": ("Claims cost per setting and eligibility category", claims_cost),
}
