import dataclasses
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from frames import event, measure, provider, rows_of, star_of
from ratestar.operators.metric_view import Condition, Count, Dimension, Distinct, MetricView, Sum
from ratestar.plans.views import CLAIMS, ENROLLMENT, QUALITY
from ratestar.schema import TABLES, Table
from ratestar.sources.star import FrameStar

COUNTS = ["numerator", "denominator", "exclusion_count", "total_events"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_unknown_exclusion_counts_in_totals_only(spark):
    star = star_of(spark, fact_quality_events=[event(excluded=None, member_id="Z", provider_npi="P9")])
    got = QUALITY.query(star, [], [*COUNTS, "performance_rate", "distinct_members", "distinct_providers"])
    assert rows_of(got) == [(0, 0, 0, 1, None, 1, 1)]


def test_empty_denominator_gives_no_rate_and_no_gap(spark):
    star = star_of(spark, fact_quality_events=[event(excluded=True), event(met=False, eligible=False)],
                   dim_measure=[measure()])
    got = QUALITY.query(star, ["measure_name"], ["denominator", "performance_rate", "gap_to_threshold"])
    assert rows_of(got) == [("One", 0, None, None)]


def test_numerator_does_not_test_eligibility(spark):
    star = star_of(spark, fact_quality_events=[event(eligible=False), event()])
    assert rows_of(QUALITY.query(star, [], COUNTS)) == [(2, 1, 0, 2)]


def test_rate_is_rounded_half_up_and_gap_uses_the_unrounded_rate(spark):
    events = [event(), event(), event(met=False)]
    star = star_of(spark, fact_quality_events=events, dim_measure=[measure(threshold=70)])
    got = QUALITY.query(star, ["measure_id"], ["performance_rate", "gap_to_threshold"])
    assert rows_of(got) == [("M1", Decimal("66.67"), Decimal("3.33"))]
    eighths = [event(met=i < 1) for i in range(800)]
    star = star_of(spark, fact_quality_events=eighths)
    assert rows_of(QUALITY.query(star, [], ["performance_rate"])) == [(Decimal("0.13"),)]


def test_gap_is_negative_above_the_threshold(spark):
    star = star_of(spark, fact_quality_events=[event()], dim_measure=[measure(threshold=25, direction="Lower is Better")])
    assert rows_of(QUALITY.query(star, ["measure_name"], ["gap_to_threshold"])) == [("One", Decimal("-75.00"))]


def test_left_keeps_and_inner_drops_unmatched_rows(spark):
    star = star_of(spark, fact_quality_events=[event(), event(provider_npi=None), event(provider_npi="P7")],
                   dim_provider=[provider()])
    left = QUALITY.query(star, ["provider_name"], ["total_events", "distinct_providers"])
    inner = QUALITY.query(star, ["provider_name"], ["total_events", "distinct_providers"], how="inner")
    assert rows_of(left) == [("Ann", 1, 1), (None, 2, 1)]
    assert rows_of(inner) == [("Ann", 1, 1)]


def test_providers_of_equal_name_merge_unless_grouped_by_number(spark):
    star = star_of(spark, fact_quality_events=[event(), event(provider_npi="P2", met=False)],
                   dim_provider=[provider(), provider("P2")])
    merged = QUALITY.query(star, ["provider_name", "provider_type"], ["performance_rate"])
    apart = QUALITY.query(star, ["provider_npi", "provider_name"], ["performance_rate"])
    assert rows_of(merged) == [("Ann", "PCP", Decimal("50.00"))]
    assert rows_of(apart) == [("P1", "Ann", Decimal("100.00")), ("P2", "Ann", Decimal("0.00"))]


def test_filters_on_fact_and_dimension_columns(spark):
    star = star_of(
        spark, dim_measure=[measure(), measure("M2", "Two", high_priority_flag=False)],
        fact_quality_events=[event(), event("M2"), event(measurement_year=1999), event(quarter=3), event("M9")])
    def total(where):
        return rows_of(QUALITY.query(star, [], ["total_events"], where=where))[0][0]
    assert total({"measurement_year": 2000, "quarter": 1}) == 3
    assert total({"measurement_year": [1999, 2000]}) == 5
    assert total({"high_priority_flag": True}) == 3
    assert total({"measure_name": None}) == 1
    assert total({"quarter": lambda q: q > 1}) == 1


def test_distinct_members_over_several_keys_of_one_group(spark):
    star = star_of(spark, dim_measure=[measure(), measure("M2", "Two")], fact_quality_events=[
        event(member_id="A"), event("M2", member_id="A"), event("M2", member_id="B"), event("M2", member_id="B")])
    got = QUALITY.query(star, ["measure_category"], ["distinct_members", "total_events"])
    assert rows_of(got) == [("Diabetes", 2, 4)]
    got = QUALITY.query(star, ["measure_id", "measure_name"], ["distinct_members"])
    assert rows_of(got) == [("M1", "One", 1), ("M2", "Two", 2)]


def test_no_rows_in_gives_no_groups_and_one_total(spark):
    star = star_of(spark, fact_quality_events=[], dim_measure=[measure()])
    assert rows_of(QUALITY.query(star, ["measure_name"], COUNTS)) == []
    assert rows_of(QUALITY.query(star, [], [*COUNTS, "performance_rate"])) == [(0, 0, 0, 0, None)]


@pytest.mark.parametrize("dimensions, measures, options", [
    (["nothing"], ["numerator"], {}),
    (["measure_id"], ["nothing"], {}),
    (["measure_id"], [], {}),
    (["measure_id", "measure_id"], ["numerator"], {}),
    (["region"], ["gap_to_threshold"], {}),
    (["measure_id"], ["threshold"], {}),
    ("measure_id", ["numerator"], {}),
    (["measure_id"], ["numerator"], {"how": "outer"}),
    (["measure_id"], ["numerator"], {"where": {"nothing": 1}}),
])
def test_bad_queries_are_refused(spark, dimensions, measures, options):
    star = star_of(spark, fact_quality_events=[event()], dim_measure=[measure()])
    with pytest.raises(ValueError):
        QUALITY.query(star, dimensions, measures, **options)


def test_repeated_dimension_key_is_found(spark):
    dims = dict(dim_county=[], dim_provider=[provider()], dim_member=[])
    QUALITY.check_keys(star_of(spark, dim_measure=[measure()], **dims))
    with pytest.raises(ValueError, match="dim_measure"):
        QUALITY.check_keys(star_of(spark, dim_measure=[measure(), measure()], **dims))


def test_view_has_the_documented_size():
    assert sum(d.value is None for d in QUALITY.dimensions) == 22 and len(QUALITY.measures) == 8
    assert all(QUALITY.describe().values())


def test_totals_add_up_over_any_dimension(star):
    whole = QUALITY.query(star, [], COUNTS).first()
    for dimension in ("region", "provider_type", "measure_category", "gender", "quarter"):
        parts = QUALITY.query(star, [dimension], COUNTS).agg(*[F.sum(c).alias(c) for c in COUNTS]).first()
        assert parts == whole, dimension


def test_joins_that_are_not_used_are_left_out(star):
    plan = plan_of(QUALITY.query(star, ["measure_id", "quarter"], ["numerator"]))
    assert "supplier" not in plan and "customer" not in plan and "nation" not in plan and "orders" not in plan
    plan = plan_of(QUALITY.query(star, ["provider_type"], ["numerator"]))
    assert "supplier" in plan and "part.parquet" not in plan and "orders" not in plan


def test_fact_is_aggregated_before_the_join(star):
    lines = plan_of(QUALITY.query(star, ["provider_type"], ["numerator"])).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert any("partial_count" in line for line in lines[join:])


def test_year_filter_reaches_the_scan(star):
    plan = plan_of(QUALITY.query(star, ["quarter"], ["numerator"], where={"measurement_year": 2000}))
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    assert "l_extendedprice" not in plan


def test_enrollment_and_claims_measures(spark):
    star = star_of(
        spark,
        fact_enrollment=[{"member_id": "A", "is_active": True}, {"member_id": "A", "is_active": False},
                         {"member_id": "B", "is_active": False}],
        fact_claims=[{"claim_type": "IP", "member_id": "A", "paid_amount": Decimal("10.01")},
                     {"claim_type": "IP", "member_id": "A", "paid_amount": Decimal("10.02")},
                     {"claim_type": "IP", "member_id": "B", "paid_amount": None},
                     {"claim_type": "OP", "member_id": "B", "paid_amount": None}])
    assert rows_of(ENROLLMENT.query(star, [], ["enrolled_members", "active_member_months", "snapshots"])) == [(2, 1, 3)]
    got = CLAIMS.query(star, ["claim_type"], ["claim_count", "total_paid", "avg_paid", "unique_members", "cost_per_member"])
    assert rows_of(got) == [("IP", 3, Decimal("20.03"), Decimal("10.02"), 2, Decimal("10.02")), ("OP", 1, None, None, 1, None)]


def test_two_distinct_counts_with_a_join(spark):
    star = star_of(
        spark, dim_measure=[measure(), measure("M2", "Two"), measure("M3", "Three", measure_category="Other")],
        fact_quality_events=[event(), event("M2"), event("M2", member_id="B", provider_npi=None),
                             event("M3", member_id="B", provider_npi="P2", met=False), event("M9", member_id="C")])
    asked = ["numerator", "total_events", "distinct_members", "distinct_providers"]
    got = QUALITY.query(star, ["measure_category"], asked)
    assert rows_of(got) == [("Diabetes", 3, 3, 2, 1), ("Other", 0, 1, 1, 1), (None, 1, 1, 1, 1)]
    got = QUALITY.query(star, ["measure_category"], ["distinct_members", "distinct_providers"], how="inner")
    assert rows_of(got) == [("Diabetes", 2, 1), ("Other", 1, 1)]
    assert rows_of(QUALITY.query(star, [], asked, where={"measure_category": "Other"})) == [(0, 1, 1, 1)]


def test_two_distinct_counts_do_not_reduce_to_pairs(star):
    plan = plan_of(QUALITY.query(star, ["provider_type"], ["distinct_members", "distinct_providers"]))
    assert plan.count("Expand") == 1 and "count(distinct" not in plan


def exchanges(plan):
    return plan.count("Exchange hashpartitioning")


def test_distinct_counts_over_small_tables_shuffle_the_fact_once(star, monkeypatch):
    asked = (star, ["region", "measurement_year"], ["distinct_members", "denominator", "distinct_providers"])
    direct = QUALITY.query(*asked)
    monkeypatch.setitem(TABLES, "dim_county", dataclasses.replace(TABLES["dim_county"], reference=False))
    reduced = QUALITY.query(*asked)
    assert "Expand" in plan_of(direct) and "partial_count" in plan_of(direct)
    assert exchanges(plan_of(direct)) == exchanges(plan_of(reduced)) - 1
    assert rows_of(direct) == rows_of(reduced)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_both_ways_agree_on_unmatched_and_empty_values(spark, how, monkeypatch):
    def star():
        return star_of(spark, dim_measure=[measure(), measure("M2", "Two")], fact_quality_events=[
            event(), event("M2", member_id=None), event("M9", provider_npi=None), event(None), event(excluded=None)])
    asked = ["distinct_members", "distinct_providers", "total_events", "numerator", "gap_to_threshold"]
    results = []
    for reference in (True, False):
        monkeypatch.setitem(TABLES, "dim_measure", dataclasses.replace(TABLES["dim_measure"], reference=reference))
        results.append([rows_of(QUALITY.query(star(), dimensions, measures, how=how))
                        for dimensions in (["measure_name"], ["measure_id", "measure_name", "quarter"])
                        for measures in (asked, asked[:1], asked[:1] + asked[2:])])
    assert results[0] == results[1]


def test_building_a_query_starts_no_job(spark, star):
    group = f"build-{id(star)}"
    spark.sparkContext.setJobGroup(group, "no jobs")
    try:
        QUALITY.query(star, ["region", "provider_type", "aid_category", "quarter_label"], ["distinct_members", "numerator"],
                      where={"measure_category": "Diabetes"})
        assert not list(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rows_of_two_growing_tables_are_joined_under_salted_keys(star):
    plan = plan_of(QUALITY.query(star, ["provider_type", "aid_category"], ["numerator", "distinct_members"]))
    assert plan.count("_salt") and "_part" in plan
    assert "_salt" not in plan_of(QUALITY.query(star, ["provider_type"], ["numerator", "distinct_members"]))


def test_salted_copies_are_not_broadcast(star):
    for dimensions, measures in ((["provider_type", "aid_category"], ["denominator", "distinct_members", "distinct_providers"]),
                                 (["measure_category", "region", "provider_type", "gender"], ["total_events", "denominator"])):
        joins = [line for line in plan_of(QUALITY.query(star, dimensions, measures)).splitlines() if "Join" in line and "_part#" in line]
        assert len(joins) == 2 and all("SortMergeJoin" in line for line in joins)


def test_conditions_over_one_and_two_tables(spark):
    star = star_of(spark, dim_measure=[measure(), measure("M2", "Two", high_priority_flag=False)], dim_provider=[provider(), provider("P2", "Bob", "FQHC")],
                   fact_quality_events=[event(), event("M2"), event("M2", provider_npi="P2", quarter=2), event("M1", provider_npi="P2", quarter=3), event(None, quarter=2)])
    either = Condition(("high_priority_flag", "provider_type"), lambda col: col("high_priority_flag") | (col("provider_type") == "FQHC"))
    second = Condition(("quarter",), lambda col: col("quarter") == 2)
    mixed = Condition(("quarter", "high_priority_flag"), lambda col: (col("quarter") == 1) & col("high_priority_flag"))
    assert rows_of(QUALITY.query(star, [], ["total_events"], conditions=[either])) == [(3,)]
    assert rows_of(QUALITY.query(star, ["measure_name"], ["total_events", "distinct_providers"], conditions=[either])) == [("One", 2, 2), ("Two", 1, 1)]
    assert rows_of(QUALITY.query(star, ["quarter"], ["total_events"], conditions=[second])) == [(2, 2)]
    assert rows_of(QUALITY.query(star, ["measure_id"], ["total_events"], conditions=[mixed])) == [("M1", 1)]
    assert rows_of(QUALITY.query(star, ["quarter_label"], ["total_events"], where={"quarter_label": ["2000-Q2", "2000-Q3"]})) == [("2000-Q2", 2), ("2000-Q3", 1)]


def test_a_view_over_tables_of_ones_own(spark):
    schema = T.StructType([T.StructField("shop", T.StringType()), T.StructField("pieces", T.IntegerType())])
    tables = {"sales": Table("sales", "", schema, ()),
              "shops": Table("shops", "", T.StructType([T.StructField("shop", T.StringType()), T.StructField("city", T.StringType())]), (("shop",),))}
    star = FrameStar({"sales": spark.createDataFrame([("a", 2), ("a", 3), ("b", 4), ("c", 1)], schema),
                      "shops": spark.createDataFrame([("a", "X"), ("b", "X")], tables["shops"].columns)}, tables)
    view = MetricView("sold", "sales", ("shops",), (Dimension("city", "shops", "city"),), (Sum("pieces", "pieces"), Count("sales")),
                      tables=tables, keys={"shops": "shop"})
    assert rows_of(view.query(star, ["city"], ["pieces", "sales"])) == [("X", 9, 3), (None, 1, 1)]
    view.check_keys(star)
    star.frames["shops"] = star.frames["shops"].union(star.frames["shops"])
    with pytest.raises(ValueError):
        view.check_keys(star)


def test_a_joined_column_may_share_its_name_with_one_a_measure_reads(spark):
    view = MetricView(
        "collected", "fact_quality_events", ("dim_measure",),
        (Dimension("collection", "dim_measure", "data_source"),),
        (Count("electronic", ("data_source",), lambda: F.col("data_source") == "EHR"), Distinct("members", "member_id")))
    star = star_of(spark, dim_measure=[measure(data_source="Admin")],
                   fact_quality_events=[event(data_source="EHR"), event(data_source="Hybrid")])
    assert rows_of(view.query(star, ["collection"], ["electronic", "members"])) == [("Admin", 1, 1)]
