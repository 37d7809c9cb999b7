"""Every operator as a named query over whole tables, for checks and benchmarks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ratestar.functions import snippets as s
from ratestar.operators import anonymity, checks, masking, ranking, spans, trends, versions
from ratestar.operators.changes import snapshot_diff
from ratestar.plans import questions as q, stored
from ratestar.operators.metric_view import Condition
from ratestar.plans.views import CLAIMS, ENROLLMENT, QUALITY
from ratestar.schema import HIGHER, TABLES
from ratestar.session import scratch_folder
from ratestar.sources import sinks
from ratestar.sources.order_star import OrderStar
from ratestar.sources.star import CatalogStar, FrameStar

YEAR, LAST_YEAR, QUARTER = 2000, 1999, 1
AS_OF = dt.date(2000, 12, 31)
SALT = "ratestar"

QUERIES: dict[str, Callable[[OrderStar], DataFrame]] = {}


def query(name: str):
    def register(build: Callable[[OrderStar], DataFrame]):
        QUERIES[name] = build
        return build
    return register


def _view(name, view, dimensions, measures, where=None, how="left", conditions=()):
    QUERIES[name] = lambda star: view.query(star, dimensions, measures, where, how, conditions)


def _fresh_schema(star: OrderStar) -> str:
    """A new catalog schema in a new folder next to the checkpoints; its files go when the application ends."""
    folder = scratch_folder(star.spark, "schema")
    name = "ratestar_" + folder.rpartition("-")[2]
    sinks.create_schema(star.spark, name, folder)
    return name


# Sources and sinks

@query("s01_typed_scan")
def _(star):
    return star.raw("orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query("s02_inferred_scan")
def _(star):
    customers = star.spark.read.parquet(f"{star.folder}/customer.parquet")
    return customers.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))


@query("s03_full_refresh")
def _(star):
    schema = _fresh_schema(star)
    sinks.full_refresh(star.table("fact_claims"), schema, "fact_claims")
    return CLAIMS.query(CatalogStar(star.spark, schema), ["measurement_year", "claim_type"], ["claim_count", "total_paid"])


@query("s05_typed_append")
def _(star):
    schema = _fresh_schema(star)
    sinks.create_table(star.spark, schema, "fact_enrollment")
    snapshots = star.table("fact_enrollment")
    sinks.append(snapshots.filter(s.active_members()), schema, "fact_enrollment")
    sinks.append(snapshots.filter(~s.active_members()), schema, "fact_enrollment")
    return ENROLLMENT.query(CatalogStar(star.spark, schema), ["plan_id", "is_active"], ["snapshots", "enrolled_members"])


#: Tables that are written to look at them in the catalog.
WRITTEN = ("dim_county", "dim_provider", "dim_member", "fact_enrollment", "fact_claims")


def _written(star: OrderStar) -> CatalogStar:
    schema = _fresh_schema(star)
    for name in WRITTEN:
        sinks.create_table(star.spark, schema, name)
        sinks.append(star.table(name), schema, name)
    return CatalogStar(star.spark, schema)


@query("s04_typed_tables")
def _(star):
    """Columns, types and comments of written tables, as the catalog gives them back, with the values in each."""
    catalog = _written(star)
    found = []
    for name in WRITTEN:
        table = star.spark.table(f"{catalog.database}.{name}")
        counts = table.agg(*[F.count(c).alias(c) for c in table.columns]).unpivot([], table.columns, "column_name", "filled")
        of = {f.name: (f.dataType.simpleString(), f.metadata["comment"], f.name in TABLES[name].partition_by) for f in table.schema}
        pick = lambda i: F.create_map(*[F.lit(x) for c, about in of.items() for x in (c, about[i])])[F.col("column_name")]
        found.append(counts.select(F.lit(name).alias("table_name"), "column_name", pick(0).alias("type"), pick(1).alias("comment"),
                                   pick(2).alias("partitions"), "filled"))
    return reduce(DataFrame.unionByName, found)


@query("s05_numbered_batches")
def _(star):
    """Batches that are appended twice, and one whose first attempt ended before it was noted as done."""
    schema = _fresh_schema(star)
    snapshots = star.table("fact_enrollment")
    active, ended = snapshots.filter(s.active_members()), snapshots.filter(~s.active_members())
    sinks.append_batch(active, schema, "fact_enrollment", 1)
    sinks.append_batch(active, schema, "fact_enrollment", 1)
    sinks.note_batch(star.spark, schema, "fact_enrollment", 2, "begun")
    sinks.append(ended.filter(F.month("snapshot_month") <= 6).dropDuplicates(["member_id", "snapshot_month"]), schema, "fact_enrollment")
    sinks.append_batch(ended, schema, "fact_enrollment", 2)
    sinks.append_batch(ended, schema, "fact_enrollment", 2)
    written = CatalogStar(star.spark, schema).table("fact_enrollment")
    return written.groupBy("is_active", F.year("snapshot_month").alias("year")).agg(
        F.countDistinct("member_id", "snapshot_month").alias("keys"), F.countDistinct("member_id").alias("members"))


@query("s07_schema")
def _(star):
    """The tables of a new schema with their rows, comments and properties, as the catalog gives them back."""
    spark, catalog = star.spark, _written(star)
    # Views of the session are listed with the tables of every schema.
    names = [row["tableName"] for row in spark.sql(f"SHOW TABLES IN {catalog.database}").collect() if not row["isTemporary"]]
    found = []
    for name in names:
        properties = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {catalog.database}.{name}").collect()}
        comment = spark.catalog.getTable(f"{catalog.database}.{name}").description
        found.append(catalog.table(name, TABLES[name].columns.names[:1]).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(comment).alias("comment"), F.lit(properties.get("quality")).alias("quality"), "row_count"))
    return reduce(DataFrame.unionByName, found)


@query("s06_catalog_scan")
def _(star):
    schema = _fresh_schema(star)
    for table in ("dim_county", "dim_member"):
        sinks.full_refresh(star.table(table), schema, table)
    joined = CatalogStar(star.spark, schema).join("dim_member", "dim_county", ["gender"], ["region"])
    return joined.groupBy("region", "gender").agg(F.count(F.lit(1)).alias("members"))


@query("s08_views")
def _(star):
    star.create_views(star.spark)
    return star.spark.sql("SELECT region, COUNT(*) AS counties FROM dim_county GROUP BY region")


@query("s09_measurement_year")
def _(star):
    claims = star.table("fact_claims", ["service_date"]).withColumn("measurement_year", F.year("service_date"))
    return claims.groupBy("measurement_year").agg(
        F.count(F.lit(1)).alias("claims"), F.min("service_date").cast("string").alias("first_day"),
        F.max("service_date").cast("string").alias("last_day"))


@query("s10_member_attributes_on_claims")
def _(star):
    return star.join("fact_claims", "dim_member", ["claim_id", "claim_type"], ["aid_category", "county_fips"], how="left")


@query("s10_member_county_on_events")
def _(star):
    return sinks.with_member_attributes(star, "fact_quality_events", ("county_fips",)).groupBy("county_fips", "quarter").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("member_id").alias("members"))


@query("s10_member_attributes_on_enrollment")
def _(star):
    return sinks.with_member_attributes(star, "fact_enrollment", ("aid_category", "county_fips")).select(
        "member_id", F.col("snapshot_month").cast("string").alias("month"), "aid_category", "county_fips")


def _member_year(star: OrderStar, year: int) -> DataFrame:
    inside = F.year("snapshot_month") == year
    return star.table("fact_enrollment", ["snapshot_month", "member_id", "plan_id", "is_active"]).filter(inside).groupBy(
        "member_id").agg(F.count_if(s.active_members()).alias("active_months"), F.max("plan_id").alias("last_plan"))


@query("s11_snapshot_diff")
def _(star):
    return snapshot_diff(_member_year(star, LAST_YEAR), _member_year(star, YEAR), ["member_id"])


@query("s11_refreshed_rates")
def _(star):
    return stored.refreshed_rates(star, star.spark)


# Projections and filters

@query("p01_projection")
def _(star):
    joined = star.join("fact_claims", "dim_provider", ["claim_id"], ["provider_name", "provider_type"])
    return joined.select("claim_id", F.col("provider_name").alias("provider"), F.col("provider_type").alias("practice"))


@query("p02_all_of_derived_table")
def _(star):
    totals = CLAIMS.query(star, ["claim_type"], ["claim_count", "total_paid"])
    return totals.filter(F.col("claim_count") > 0).select("*")


@query("p03_nested_derived_table")
def _(star):
    per_member = CLAIMS.query(star, ["aid_category", "claim_type"], ["unique_members"])
    return per_member.groupBy("aid_category").agg(F.max("unique_members").alias("most_members"))


@query("p04_ordinals")
def _(star):
    star.create_views(star.spark)
    return star.spark.sql("""
        SELECT aid_category, plan_id, count(*) AS snapshots, count_if(is_active) AS active_snapshots
        FROM fact_enrollment GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2""")


@query("p05_case_without_else")
def _(star):
    events = star.table("fact_quality_events", ["data_source", "in_numerator", "exclusion_applied"])
    return events.groupBy("data_source").agg(F.count(F.when(s.counts_as_met(), 1)).alias("met"))


@query("p06_case_with_else")
def _(star):
    rows = star.table("fact_enrollment", ["plan_id", "is_active"])
    return rows.groupBy("plan_id").agg(
        F.sum(F.when(s.active_members(), 1).otherwise(0)).alias("active"),
        F.sum(F.when(s.active_members(), 0).otherwise(1)).alias("inactive"))


_view("f01_year", QUALITY, ["measure_id"], ["total_events"],
      conditions=[Condition(("measurement_year",), lambda col: s.in_year(YEAR, col))])
_view("f02_year_and_quarter", QUALITY, ["measure_id"], ["total_events"],
      conditions=[Condition(("measurement_year", "quarter"), lambda col: s.in_quarter(YEAR, QUARTER, col))])
_view("f03_category", QUALITY, ["measure_name"], ["total_events"], {"measure_category": "Diabetes"})
_view("f04_direction", QUALITY, ["measure_name"], ["total_events"], {"reporting_direction": HIGHER})


@query("f05_at_risk_after_aggregation")
def _(star):
    rates = QUALITY.query(star, ["measure_id", "reporting_direction", "regulatory_threshold"], ["performance_rate"])
    return rates.filter(s.at_risk())


@query("f06_after_window")
def _(star):
    return q.provider_tiles(star, YEAR, 4, "performance_quartile").filter("performance_quartile = 4")


@query("f07_top_n_filter")
def _(star):
    return q.top_providers(star, YEAR, 1)


@query("f08_active_members")
def _(star):
    rows = star.table("fact_enrollment", ["aid_category", "is_active"]).filter(s.active_members())
    return rows.groupBy("aid_category").agg(F.count(F.lit(1)).alias("snapshots"))


@query("f09_eligible_for_measure")
def _(star):
    events = star.table("fact_quality_events", ["quarter", "in_denominator", "exclusion_applied"])
    return events.filter(s.eligible_for_measure()).groupBy("quarter").agg(F.count(F.lit(1)).alias("events"))


_view("f10_high_priority_measures", QUALITY, ["measure_category"], ["total_events", "performance_rate"],
      conditions=[Condition(("high_priority_flag",), s.high_priority_measures)])
_view("f11_star_rating_measures", QUALITY, ["measure_category"], ["total_events", "performance_rate"],
      conditions=[Condition(("star_rating_flag",), s.star_rating_measures)])
_view("f13_either_of_two_tables", QUALITY, ["measure_category"], ["total_events", "performance_rate"], {"measurement_year": YEAR},
      conditions=[Condition(("star_rating_flag", "gender", "quarter"),
                            lambda col: s.star_rating_measures(col) | ((col("gender") == "F") & (col("quarter") == QUARTER)))])


@query("f12_three_valued_logic")
def _(star):
    events = star.table("fact_quality_events", ["in_denominator", "exclusion_applied"])
    return events.groupBy("exclusion_applied").agg(
        F.count(F.lit(1)).alias("events"), F.count(F.when(s.counts_as_eligible(), 1)).alias("eligible"))


# Joins

def _edge(name, left, right, columns, attribute):
    QUERIES[name] = lambda star: star.join(left, right, columns, [attribute]).groupBy(attribute).agg(
        F.count(F.lit(1)).alias("row_count"))


_edge("j01_member_county", "dim_member", "dim_county", ["member_id"], "region")
_edge("j02_provider_county", "dim_provider", "dim_county", ["provider_npi"], "region")
_view("j03_claims_member", CLAIMS, ["gender"], ["claim_count", "total_paid"], how="inner")
_view("j04_claims_provider", CLAIMS, ["provider_type"], ["claim_count", "total_paid"], how="inner")
_view("j05_enrollment_county", ENROLLMENT, ["region"], ["snapshots"], how="inner")
_view("j06_enrollment_member", ENROLLMENT, ["gender"], ["snapshots"], how="inner")
_view("j07_events_county", QUALITY, ["urban_rural_class"], ["total_events"], how="inner")
_view("j08_events_measure", QUALITY, ["reporting_standard"], ["total_events"], how="inner")
_view("j09_events_member", QUALITY, ["race_ethnicity"], ["total_events"], how="inner")
_view("j10_events_provider", QUALITY, ["provider_type"], ["total_events"], how="inner")
_view("j11_star_join", QUALITY, ["measure_category", "region", "provider_type", "gender"],
      ["total_events", "denominator", "numerator", "performance_rate"])
_view("j12_three_way_join", QUALITY, ["provider_type", "measure_category"], ["numerator", "denominator"], how="inner")

# Aggregates

_view("a01_denominator", QUALITY, ["measure_name"], ["denominator"])
_view("a02_numerator", QUALITY, ["measure_name"], ["numerator"])
_view("a03_total_events", QUALITY, ["data_source"], ["total_events"])
_view("a04_exclusion_count", QUALITY, ["provider_type"], ["exclusion_count"])
_view("a05_performance_rate", QUALITY, ["county_name", "state_code"], ["performance_rate"])
_view("a06_gap_to_threshold", QUALITY, ["measure_id", "measurement_year"], ["gap_to_threshold"])
_view("a07_distinct_members", QUALITY, ["region"], ["distinct_members"])
_view("a08_distinct_providers", QUALITY, ["measure_category"], ["distinct_providers"])
_view("a09_total_paid", CLAIMS, ["measurement_year"], ["total_paid"])
_view("a10_cost_per_member", CLAIMS, ["gender"], ["cost_per_member"])
_view("a11_claim_count", CLAIMS, ["claim_type", "aid_category"], ["claim_count"])
_view("a12_avg_paid", CLAIMS, ["provider_type"], ["avg_paid"])
_view("a13_unique_members", CLAIMS, ["claim_type"], ["unique_members"])
_view("a14_enrolled_members", ENROLLMENT, ["region"], ["enrolled_members"])
_view("a15_active_member_months", ENROLLMENT, ["plan_id"], ["active_member_months"])


@query("a16_monthly_active_members")
def _(star):
    return q.monthly_active_members(star)


_view("a18_five_keys", QUALITY,
      ["measure_name", "measure_category", "measurement_year", "reporting_direction", "regulatory_threshold"],
      ["total_events", "exclusion_count"])

# The metric view as an operator

_view("m02_all_measures", QUALITY, ["measure_id", "measurement_year"],
      ["denominator", "numerator", "total_events", "exclusion_count", "performance_rate", "gap_to_threshold",
       "distinct_members", "distinct_providers"])
_view("m02_all_measures_in_total", QUALITY, [],
      ["denominator", "numerator", "total_events", "exclusion_count", "performance_rate",
       "distinct_members", "distinct_providers"])
_view("m03_filter_before", QUALITY, ["region", "aid_category"], ["denominator", "performance_rate"],
      {"measurement_year": [LAST_YEAR, YEAR], "gender": "F"})


@query("m04_filter_after")
def _(star):
    rates = QUALITY.query(star, ["provider_name", "provider_type"], ["performance_rate", "denominator"])
    return rates.filter((F.col("performance_rate") > 66) & (F.col("denominator") >= 10))


_view("m01_by_quarter_label", QUALITY, ["quarter_label", "measure_category"], ["total_events", "performance_rate"])
_view("m01_by_member_age", QUALITY, ["member_age"], ["total_events", "distinct_members"], {"measurement_year": YEAR})
_view("m02_members_and_providers", QUALITY, ["provider_type", "aid_category"],
      ["denominator", "performance_rate", "distinct_members", "distinct_providers"])
_view("m02_distinct_by_provider_type", QUALITY, ["provider_type"], ["total_events", "distinct_members", "distinct_providers"])


@query("m08_routed_to_stored")
def _(star):
    return stored.routed_rates(star, star.spark)


@query("m08_routed_to_larger")
def _(star):
    return stored.routed_counties(star, star.spark)


@query("a07_people_from_stored")
def _(star):
    return stored.people_by_region(star, star.spark)


@query("a13_members_from_stored")
def _(star):
    return stored.members_by_claim_type(star, star.spark)


@query("a14_enrolled_from_stored")
def _(star):
    return stored.enrolled_by_region(star, star.spark)


@query("a16_monthly_from_stored")
def _(star):
    return stored.monthly_active_members(star, star.spark)


def _cost(star, by, per):
    return spans.cost_per_member_month(star, AS_OF, by, per).withColumn("total_paid", F.col("total_paid").cast("double"))


@query("a10_cost_per_member_month")
def _(star):
    return _cost(star, ["aid_category"], "year").drop("period")


@query("a10_cost_per_member_month_by_quarter")
def _(star):
    return _cost(star, [], "quarter")


def _with_more_definitions(star: OrderStar) -> FrameStar:
    """Each measure also defined anew for 1994 and, some of them, for 1997, with other thresholds."""
    measures = star.table("dim_measure")
    older = measures.withColumn("measurement_year", F.lit(1994)).withColumn("regulatory_threshold", (F.col("regulatory_threshold") - 5).cast("decimal(5,2)"))
    odd = F.substring("measure_id", -1, 1).isin("1", "3", "5")
    newer = measures.filter(odd).withColumn("measurement_year", F.lit(1997)).withColumn("regulatory_threshold", (F.col("regulatory_threshold") + 2).cast("decimal(5,2)"))
    frames = {t: star.table(t) for t in TABLES if t != "dim_measure"}
    return FrameStar(frames | {"dim_measure": measures.unionByName(older).unionByName(newer)}, TABLES | {"dim_measure": versions.VERSIONED_MEASURES})


@query("j08_rates_by_definition")
def _(star):
    return versions.rates_by_definition(_with_more_definitions(star))


@query("j08_events_with_definitions")
def _(star):
    joined = versions.events_with_definitions(_with_more_definitions(star), ["event_id", "quarter"], ["measurement_year", "regulatory_threshold"])
    return joined.groupBy("measurement_year", "definition_measurement_year", "regulatory_threshold").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("event_ids"))


@query("v04_keys_of_definitions")
def _(star):
    return checks.repeated_keys(_with_more_definitions(star), ["dim_measure"])


@query("m06_window_on_view")
def _(star):
    rates = QUALITY.query(star, ["measure_category", "measure_name"], ["performance_rate"])
    return ranking.rank(rates, ["measure_category"], "performance_rate", "category_rank")


@query("m07_one_rate")
def _(star):
    rates = QUALITY.query(star, ["state_code", "quarter"], ["numerator", "denominator", "performance_rate"])
    return rates.withColumn("recomputed", s.rate(F.col("numerator"), F.col("denominator")))


# Windows

@query("w01_rank_by_provider_number")
def _(star):
    return q.ranked_providers(star, YEAR, by_npi=True)


@query("w02_previous_quarter_by_category")
def _(star):
    period = ["measurement_year", "quarter"]
    rates = QUALITY.query(star, ["measure_category", *period], ["performance_rate"])
    return trends.change(
        trends.previous(rates, ["measure_category"], period, "performance_rate", "prev_quarter_rate"),
        "performance_rate", "prev_quarter_rate", "qoq_change")


@query("w03_quartiles_per_measure")
def _(star):
    rates = q.provider_measure_rates(star, YEAR)
    return ranking.ntile(rates, 4, ["measure_name"], "raw_rate", "performance_quartile",
                         ties=q.PROVIDER).drop("raw_rate")


@query("w04_running_and_rolling_by_aid_category")
def _(star):
    months, by, value = q.enrollment_by_aid_category(star), ["aid_category"], "monthly_active_members"
    total = trends.running_total(months, by, ["snapshot_month"], value, "cumulative_member_months")
    return trends.rolling_average(total, by, ["snapshot_month"], value, "rolling_6mo_avg", periods=6, digits=1)


@query("w05_provider_percentile")
def _(star):
    rates = q.provider_rates(star, YEAR).drop("raw_rate")
    shares = ranking.percent_rank(rates, [], "overall_performance_rate", "percentile_rank")
    return shares.withColumn("percentile_rank", q.percent(F.col("percentile_rank")))


@query("w06_dense_rank")
def _(star):
    return q.densely_ranked_providers(star, YEAR)


@query("w07_next_quarter")
def _(star):
    return q.next_quarter(star)


@query("w08_year_over_year")
def _(star):
    return q.year_over_year(star)


@query("w09_deciles")
def _(star):
    return q.provider_deciles(star, YEAR)


@query("w10_top_providers")
def _(star):
    return q.top_providers(star, YEAR)


@query("w11_aggregate_in_window")
def _(star):
    star.create_views(star.spark)
    return star.spark.sql(f"""
        SELECT measure_category, measure_name, rank() OVER (
                   PARTITION BY measure_category
                   ORDER BY count_if(in_numerator AND NOT exclusion_applied) * 100.0
                            / nullif(count_if(in_denominator AND NOT exclusion_applied), 0) DESC) AS category_rank
        FROM fact_quality_events AS events JOIN dim_measure USING (measure_id)
        WHERE events.measurement_year = {YEAR}
        GROUP BY measure_category, measure_name""")


# Sorting and limits

@query("l01_sort_by_one")
def _(star):
    return CLAIMS.query(star, ["claim_type"], ["total_paid"]).orderBy(F.desc("total_paid"), "claim_type")


@query("l02_sort_by_many")
def _(star):
    return QUALITY.query(star, ["measure_name", "measurement_year"], ["numerator"]).orderBy("measure_name", "measurement_year")


@query("l03_mixed_sort")
def _(star):
    return QUALITY.query(star, ["measure_name", "state_code"], ["numerator"]).orderBy("measure_name", F.desc("numerator"), "state_code")


@query("l04_sort_by_expression")
def _(star):
    return QUALITY.query(star, ["measure_name"], ["gap_to_threshold"]).orderBy(
        F.abs("gap_to_threshold").desc(), "measure_name")


@query("l05_top_k")
def _(star):
    return q.enrollment_by_county(star, 5)


# Scalar functions

@query("x01_round")
def _(star):
    paid = star.table("fact_claims", ["claim_type", "paid_amount"]).groupBy("claim_type").agg(F.sum("paid_amount").alias("paid"))
    return paid.select("claim_type", *[F.round("paid", n).alias(f"paid_{n}") for n in (0, 1, 2)])


@query("x02_nullif")
def _(star):
    events = star.table("fact_quality_events", ["quarter", "in_denominator", "in_numerator", "exclusion_applied"])
    counts = events.groupBy("quarter", "in_denominator").agg(
        F.count(F.when(s.counts_as_met(), 1)).alias("met"), F.count(F.when(s.counts_as_eligible(), 1)).alias("eligible"))
    return counts.select("quarter", "in_denominator", s.rate(F.col("met"), F.col("eligible")).alias("performance_rate"))


@query("x03_abs")
def _(star):
    return QUALITY.query(star, ["measure_id"], ["gap_to_threshold"]).select(
        "measure_id", F.abs("gap_to_threshold").alias("distance"))


@query("x04_measurement_quarter")
def _(star):
    events = star.table("fact_quality_events", ["measurement_year", "quarter"])
    return events.groupBy(s.measurement_quarter().alias("measurement_quarter")).agg(F.count(F.lit(1)).alias("events"))


@query("x05_member_age")
def _(star):
    members = star.table("dim_member", ["date_of_birth"])
    return members.groupBy(s.member_age(AS_OF).alias("member_age")).agg(F.count(F.lit(1)).alias("members"))


@query("x06_enrollment_month_label")
def _(star):
    rows = star.table("fact_enrollment", ["snapshot_month"])
    return rows.groupBy(s.enrollment_month_label().alias("month")).agg(F.count(F.lit(1)).alias("snapshots"))


@query("x07_arithmetic")
def _(star):
    counts = QUALITY.query(star, ["data_source", "quarter"], ["exclusion_count", "total_events"])
    share = F.col("exclusion_count") * F.lit(100) / F.col("total_events")
    return counts.select("data_source", "quarter", F.round(share.cast("decimal(38,14)"), 2).alias("excluded_percent"),
                         (F.col("total_events") - F.col("exclusion_count")).alias("kept"))


@query("x08_comparison")
def _(star):
    threshold = F.col("regulatory_threshold")
    rates = QUALITY.query(star, ["measure_id", "regulatory_threshold"], ["performance_rate"])
    return rates.select("measure_id", (F.col("performance_rate") < threshold).alias("below"),
                        (F.col("performance_rate") > threshold).alias("above"), (threshold == 63).alias("is_63"))


@query("x09_current_date")
def _(star):
    # Days on both sides of today, half a year around it.
    members = star.table("dim_member", ["aid_category", "enrollment_start_dt", "enrollment_end_dt"]).withColumn(
        "renewal", F.date_add(F.current_date(), F.dayofyear("enrollment_start_dt") - 183))
    return members.groupBy("aid_category").agg(
        F.count_if(F.col("enrollment_end_dt") < F.current_date()).alias("ended"),
        F.count_if(F.col("enrollment_end_dt").isNull()).alias("open"),
        F.count_if(F.col("renewal") < F.current_date()).alias("overdue"),
        F.count_if(F.col("renewal") == F.current_date()).alias("due"))


@query("x10_array")
def _(star):
    members = star.table("dim_member", ["member_id", "gender", "race_ethnicity"])
    both = F.array("gender", "race_ethnicity")
    return members.select("member_id", F.array_join(both, "/").alias("profile"), F.size(both).alias("parts"))


@query("x11_month_start")
def _(star):
    claims = star.table("fact_claims", ["service_date"])
    return claims.groupBy(s.month_start(F.col("service_date")).cast("string").alias("month")).agg(F.count(F.lit(1)).alias("claims"))


@query("x12_year_and_quarter")
def _(star):
    claims = star.table("fact_claims", ["service_date"])
    return claims.groupBy(F.year("service_date").alias("year"), F.quarter("service_date").alias("service_quarter")).agg(
        F.count(F.lit(1)).alias("claims"))


@query("x13_zero_padded_keys")
def _(star):
    return star.raw("orders").select(
        "o_orderkey", F.concat(F.lit("CLM"), s.zero_padded(F.col("o_orderkey"), 8)).alias("claim_id"),
        s.zero_padded(F.col("o_orderkey") * 100000, 8).alias("wide_key"))


# Periods by distance in time: a quarter of every second year is left out

GAPS = Condition(("measurement_year", "quarter"), lambda col: ~((col("measurement_year") % 2 == 0) & (col("quarter") == 2)))


def _quarters_with_gaps(star, by="measure_name"):
    return QUALITY.query(star, [by, "measurement_year", "quarter"], ["performance_rate"], how="inner", conditions=[GAPS])


@query("w02_previous_quarter_in_time")
def _(star):
    rates = trends.previous_in_time(_quarters_with_gaps(star), ["measure_name"], trends.quarter_number(), "performance_rate", "prev_quarter_rate")
    return trends.change(rates, "performance_rate", "prev_quarter_rate", "qoq_change")


@query("w07_next_quarter_in_time")
def _(star):
    rates = trends.previous_in_time(_quarters_with_gaps(star), ["measure_name"], trends.quarter_number(), "performance_rate", "next_quarter_rate", -1)
    return trends.change(rates, "next_quarter_rate", "performance_rate", "next_change")


@query("w08_quarter_of_last_year")
def _(star):
    rates = trends.previous_in_time(_quarters_with_gaps(star), ["measure_name"], trends.quarter_number(), "performance_rate", "last_year_rate", 4)
    return trends.change(rates, "performance_rate", "last_year_rate", "yoy_change")


@query("w02_all_quarters")
def _(star):
    rates = trends.with_missing_periods(_quarters_with_gaps(star, "measure_category"), ["measure_category"], trends.quarter_number(), "number")
    number = F.col("number")
    filled = rates.withColumns({"measurement_year": F.expr("(number - 1) div 4").cast("int"), "quarter": ((number - 1) % 4 + 1).cast("int")})
    return trends.previous_in_time(filled, ["measure_category"], number, "performance_rate", "prev_quarter_rate").drop("number")


@query("w04_rolling_months_in_time")
def _(star):
    gaps = ENROLLMENT.query(star, ["snapshot_month", "aid_category"], ["enrolled_members"], where={"is_active": True}).filter(F.month("snapshot_month") % 5 != 0)
    return trends.rolling_average_in_time(gaps, ["aid_category"], trends.month_number("snapshot_month"), "enrolled_members", "rolling_3mo_avg", 3, 1)


def _days(star):
    return star.table("fact_claims", ["claim_type", "service_date", "paid_amount"]).groupBy("claim_type", "service_date").agg(
        F.count(F.lit(1)).alias("claims"))


@query("w04_running_total_of_days")
def _(star):
    return trends.long_running_total(_days(star), ["claim_type"], ["service_date"], "claims", "claims_so_far", block_rows=500)


@query("w04_rolling_average_of_days")
def _(star):
    return trends.long_rolling_average(_days(star), ["claim_type"], ["service_date"], "claims", "rolling_30_avg", 30, 2, block_rows=500)


# Array columns

@query("r01_claims_by_condition")
def _(star):
    return q.claims_by_condition(star)


@query("r02_claims_by_diagnosis")
def _(star):
    return q.claims_by_code(star, "dx_codes")


@query("r02_claims_by_procedure")
def _(star):
    return q.claims_by_code(star, "proc_codes")


@query("r02_claims_with_diagnosis")
def _(star):
    return q.claims_with_code(star, "I10")


# Questions

@query("q01_enrollment_by_county")
def _(star):
    return q.enrollment_by_county(star)


@query("q02_quarter_metrics")
def _(star):
    return q.quarter_metrics(star, YEAR, QUARTER)


@query("q03_measures_at_risk")
def _(star):
    return q.measures_at_risk(star, YEAR)


@query("q04_years_compared")
def _(star):
    return q.years_compared(star)


@query("q05_diabetes_performance")
def _(star):
    return q.diabetes_performance(star, YEAR)


@query("q06_behavioral_health_by_quarter")
def _(star):
    return q.behavioral_health_by_quarter(star)


@query("q07_most_compliant_providers")
def _(star):
    return q.most_compliant_providers(star, YEAR)


@query("q08_enrollment_by_aid_category")
def _(star):
    return q.enrollment_by_aid_category(star)


@query("q09_ranked_providers")
def _(star):
    return q.ranked_providers(star, YEAR)


@query("q10_quarter_over_quarter")
def _(star):
    return q.quarter_over_quarter(star)


@query("q11_bottom_quartile_providers")
def _(star):
    return q.bottom_quartile_providers(star, YEAR)


@query("q12_cumulative_enrollment")
def _(star):
    return q.cumulative_enrollment(star)


@query("q13_county_percentiles")
def _(star):
    return q.county_percentiles(star, YEAR)


@query("q14_claims_cost")
def _(star):
    return q.claims_cost(star)


# Data quality and governance

@query("v01_row_counts")
def _(star):
    return checks.row_counts(star)


@query("v02_null_counts")
def _(star):
    return checks.null_counts(star)


@query("v03_orphan_keys")
def _(star):
    return checks.orphan_keys(star)


@query("v04_repeated_keys")
def _(star):
    return checks.repeated_keys(star)


@query("v05_met_but_not_eligible")
def _(star):
    return checks.met_but_not_eligible(star)


@query("g01_sensitive_exposure")
def _(star):
    return masking.exposure(star)


@query("g02_masked_members")
def _(star):
    return masking.masked(star, "dim_member", SALT).select(
        *[c for c in star.table("dim_member").columns if c != "chronic_condition_flags"],
        F.col("chronic_condition_flags").isNull().alias("conditions_hidden"))


@query("g02_masked_claims")
def _(star):
    claims = masking.masked(star, "fact_claims", SALT)
    return claims.select("claim_id", "member_id", "provider_npi", "service_date", "claim_type", "revenue_code",
                         F.col("dx_codes").isNull().alias("dx_hidden"), F.size("proc_codes").alias("proc_count"),
                         "paid_amount", "measurement_year")


@query("g02_masked_for_pii_reader")
def _(star):
    return masking.masked(star, "dim_provider", SALT, cleared=["pii"])


@query("g03_anonymous_members")
def _(star):
    members = anonymity.anonymous_members(star, k=5)
    return members.groupBy("zip_code", "date_of_birth", "gender", "aid_category").agg(F.count(F.lit(1)).alias("members"))
