import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from frames import event, measure, provider, rows_of, star_of
from ratestar.functions import snippets as s
from ratestar.operators import trends
from ratestar.plans import questions as q


def test_previous_uses_the_row_before_when_a_quarter_is_missing(spark):
    rows = [("m", 2000, 1, 50.0), ("m", 2000, 3, 60.0), ("n", 2000, 2, 10.0)]
    df = spark.createDataFrame(rows, "name string, year int, quarter int, rate double")
    before = trends.previous(df, ["name"], ["year", "quarter"], "rate", "before")
    got = trends.change(trends.following(before, ["name"], ["year", "quarter"], "rate", "after"), "rate", "before", "change")
    assert rows_of(got) == [("m", 2000, 1, 50.0, None, 60.0, None), ("m", 2000, 3, 60.0, 50.0, None, 10.0),
                            ("n", 2000, 2, 10.0, None, None, None)]


def test_running_total_and_rolling_average(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (4, 33), (5, 1)], "month int, n int")
    got = trends.rolling_average(trends.running_total(df, [], ["month"], "n", "total"), [], ["month"], "n", "avg")
    assert rows_of(got) == [(1, 10, 10, 10.0), (2, 20, 30, 15.0), (4, 33, 63, 21.0), (5, 1, 64, 18.0)]


def test_last_running_total_is_the_sum(star):
    months = q.cumulative_enrollment(star).collect()
    assert months[-1].cumulative_member_months == sum(m.monthly_active_members for m in months)
    assert months[0].rolling_3mo_avg == months[0].monthly_active_members


def test_rank_uses_the_unrounded_rate(spark):
    # 2/3 and 66.67 percent are equal once rounded
    events = [event(met=i < 2) for i in range(3)]
    events += [event(met=i < 6667, provider_npi="P2") for i in range(10000)]
    star = star_of(spark, fact_quality_events=events, dim_measure=[measure()],
                   dim_provider=[provider(), provider("P2", "Bob")])
    got = [(r.provider_name, r.performance_rate, r.provider_rank) for r in q.ranked_providers(star, 2000).collect()]
    assert got == [("Bob", Decimal("66.67"), 1), ("Ann", Decimal("66.67"), 2)]


def test_rank_ties_gaps_and_lower_is_better_left_out(spark):
    star = star_of(
        spark, dim_measure=[measure(), measure("M2", "Two", direction="Lower is Better")],
        dim_provider=[provider(), provider("P2", "Bob"), provider("P3", "Cy"), provider("P4", "Di")],
        fact_quality_events=[event(), event(provider_npi="P2"), event(met=False, provider_npi="P3"), event("M2"),
                             event(excluded=True, provider_npi="P4")])
    ranked = {r.provider_name: r.provider_rank for r in q.ranked_providers(star, 2000).collect()}
    dense = {r.provider_name: r.provider_rank for r in q.densely_ranked_providers(star, 2000).collect()}
    assert ranked == {"Ann": 1, "Bob": 1, "Cy": 3, "Di": 4}
    assert dense == {"Ann": 1, "Bob": 1, "Cy": 2, "Di": 3}


def test_unrated_providers_fall_into_the_bottom_quartile(spark):
    providers = [provider(f"P{i}", f"N{i}") for i in range(8)]
    events = [event(met=j < i, provider_npi=f"P{i}") for i in range(1, 8) for j in range(8)]
    events.append(event(excluded=True, provider_npi="P0"))
    star = star_of(spark, fact_quality_events=events, dim_provider=providers)
    assert [r.provider_name for r in q.bottom_quartile_providers(star, 2000).collect()] == ["N0", "N1"]
    assert [r.provider_name for r in q.bottom_quartile_providers(star, 2000, keep_unrated=False).collect()] == ["N1", "N2"]


def test_quartile_sizes_differ_by_one_at_most(star):
    sizes = [r["count"] for r in q.provider_tiles(star, 2000, 4, "tile").groupBy("tile").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1


def test_single_county_has_percentile_zero(spark):
    star = star_of(spark, fact_quality_events=[event()], dim_measure=[measure()],
                   dim_county=[{"county_fips": "C1", "county_name": "Kings", "state_code": "CA"}])
    assert q.county_percentiles(star, 2000).first().percentile_rank == 0.0


def test_counties_of_one_name_stay_apart_by_state(spark):
    star = star_of(
        spark, fact_enrollment=[{"member_id": "A", "county_fips": "C1", "is_active": True},
                                {"member_id": "B", "county_fips": "C2", "is_active": False}],
        dim_county=[{"county_fips": "C1", "county_name": "Kings", "state_code": "CA"},
                    {"county_fips": "C2", "county_name": "Kings", "state_code": "NY"}])
    got = [tuple(r) for r in q.enrollment_by_county(star).collect()]
    assert got == [("Kings", "CA", 1, 1), ("Kings", "NY", 1, 0)]


def test_at_risk_both_ways(spark):
    star = star_of(
        spark, fact_quality_events=[event(), event(met=False), event("M2"), event("M2", met=False)],
        dim_measure=[measure(threshold=60), measure("M2", "Two", 20, "Lower is Better"), measure("M3", "Three")])
    got = [(r.measure_name, r.gap_to_threshold) for r in q.measures_at_risk(star, 2000).collect()]
    assert got == [("Two", Decimal("-30.00")), ("One", Decimal("10.00"))]


def test_conditions_and_codes_that_are_empty_or_missing(spark):
    star = star_of(
        spark, dim_member=[{"member_id": "A", "chronic_condition_flags": ["X", "Y"]},
                           {"member_id": "B", "chronic_condition_flags": []}, {"member_id": "C"}],
        fact_claims=[{"member_id": m, "paid_amount": Decimal(1), "dx_codes": codes, "claim_type": "IP"}
                     for m, codes in (("A", ["d"]), ("A", ["d", "e"]), ("B", []), ("C", None))])
    assert rows_of(q.claims_by_condition(star)) == [("X", 1, 2, Decimal("2.00")), ("Y", 1, 2, Decimal("2.00"))]
    assert rows_of(q.claims_by_code(star)) == [("d", 2, 1, Decimal("2.00")), ("e", 1, 1, Decimal("1.00"))]
    assert rows_of(q.claims_with_code(star, "e")) == [("IP", 1, Decimal("1.00"))]


def test_expressions(spark):
    row = spark.createDataFrame(
        [(2025, 3, dt.date(1980, 7, 1), dt.date(2025, 3, 1), 1234567890)],
        "measurement_year int, quarter int, date_of_birth date, snapshot_month date, number long").select(
        s.measurement_quarter(), s.member_age(dt.date(2025, 7, 1)), s.enrollment_month_label(),
        s.month_start(F.lit(dt.date(2025, 3, 31))), s.zero_padded(F.col("number"), 7),
        s.zero_padded(F.lit(12), 7)).first()
    assert tuple(row) == ("2025-Q3", 44, "2025-03", dt.date(2025, 3, 1), "1234567890", "0000012")


def test_age_defaults_to_today(spark):
    df = spark.createDataFrame([(dt.date.today() - dt.timedelta(days=3660),)], "date_of_birth date")
    assert df.select(s.member_age()).first()[0] == 10


@pytest.mark.parametrize("flags, expected", [((True, False), True), ((True, True), False), ((True, None), False)])
def test_eligible_filter(spark, flags, expected):
    df = spark.createDataFrame([flags], "in_denominator boolean, exclusion_applied boolean")
    assert (df.filter(s.eligible_for_measure()).count() == 1) is expected


def test_catalog_answers_every_question(star):
    arguments = {"Q-02": (2000, 1), **{n: (2000,) for n in ("Q-03", "Q-05", "Q-07", "Q-09", "Q-11", "Q-13")}}
    assert list(q.CATALOG) == [f"Q-{i:02d}" for i in range(1, 15)]
    for number, (title, ask) in q.CATALOG.items():
        assert title and not ask(star, *arguments.get(number, ())).isEmpty(), number


def test_years_can_be_chosen(star):
    years = {r.measurement_year for r in q.years_compared(star, [1999, 2000]).collect()}
    assert years == {1999, 2000}
