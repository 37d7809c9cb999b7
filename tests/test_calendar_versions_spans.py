"""Periods by distance in time, long groups, definitions by year, months of enrollment, anonymity, top-n, batches."""

import datetime as dt
import random
from collections import Counter
from itertools import product

import pytest
from pyspark.sql import Window, functions as F

from frames import event, frame, measure, rows_of, star_of
from ratestar.operators import anonymity, checks, ranking, spans, trends, versions
from ratestar.plans.views import QUALITY
from ratestar.schema import TABLES
from ratestar.sources import sinks
from ratestar.sources.star import FrameStar

# The calendar


def test_a_missing_quarter_gives_no_change(spark):
    df = spark.createDataFrame([("a", 2000, 1, 1.0), ("a", 2000, 2, 2.0), ("a", 2000, 4, 4.0), ("a", 2001, 1, 8.0), (None, 2000, 4, 1.0), (None, 2001, 1, 3.0)],
                               "g string, measurement_year int, quarter int, v double")
    got = trends.previous_in_time(df, ["g"], trends.quarter_number(), "v", "before")
    assert {(r.g, r.measurement_year, r.quarter): r.before for r in got.collect()} == {
        ("a", 2000, 1): None, ("a", 2000, 2): 1.0, ("a", 2000, 4): None, ("a", 2001, 1): 4.0, (None, 2000, 4): None, (None, 2001, 1): 1.0}
    ahead = trends.previous_in_time(df, ["g"], trends.quarter_number(), "v", "after", -1)
    assert {(r.measurement_year, r.quarter): r.after for r in ahead.collect() if r.g} == {(2000, 1): 2.0, (2000, 2): None, (2000, 4): 8.0, (2001, 1): None}
    rolled = trends.rolling_average_in_time(df, ["g"], trends.quarter_number(), "v", "avg", 3, 1)
    assert {(r.measurement_year, r.quarter): r.avg for r in rolled.collect() if r.g} == {(2000, 1): 1.0, (2000, 2): 1.5, (2000, 4): 3.0, (2001, 1): 6.0}
    filled = trends.with_missing_periods(df, ["g"], trends.quarter_number(), "number")
    assert rows_of(filled.select("g", "number", "v")) == rows_of(spark.createDataFrame(
        [("a", 8001, 1.0), ("a", 8002, 2.0), ("a", 8003, None), ("a", 8004, 4.0), ("a", 8005, 8.0), (None, 8004, 1.0), (None, 8005, 3.0)], "g string, number long, v double"))


@pytest.mark.parametrize("block_rows, periods", [(3, 2), (7, 7), (1000, 30)])
def test_long_groups_equal_plain_windows(spark, block_rows, periods):
    rng = random.Random(block_rows)
    rows = [(rng.choice(["a", "b", None]), day // 30, day % 30, rng.choice([None, 1, 5, 7])) for day in range(200)]
    rows = list({r[:3]: r for r in rows}.values()) + [("nulls", 1, d, None) for d in range(5)]
    df = spark.createDataFrame(rows, "g string, month int, day int, v int").repartition(5)
    window = Window.partitionBy("g").orderBy("month", "day")
    total = trends.long_running_total(df, ["g"], ["month", "day"], "v", "x", block_rows)
    assert rows_of(total) == rows_of(df.withColumn("x", F.sum("v").over(window.rowsBetween(Window.unboundedPreceding, 0))))
    rolled = trends.long_rolling_average(df, ["g"], ["month", "day"], "v", "x", periods, 2, block_rows)
    assert rows_of(rolled) == rows_of(df.withColumn("x", F.round(F.avg("v").over(window.rowsBetween(1 - periods, 0)), 2)))


@pytest.fixture
def whole_shuffles(spark):
    """Small partitions are not put together, as with larger data."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def test_a_long_group_is_spread(spark, whole_shuffles):
    days = spark.range(300_000).select(F.lit("one").alias("g"), F.col("id").alias("day"), (F.col("id") % 7).alias("v"))
    for found in (trends.long_running_total(days, ["g"], ["day"], "v", "x", 1000), trends.long_rolling_average(days, ["g"], ["day"], "v", "x", 30, 2, 1000)):
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 300_000 and max(sizes) <= 2 * 300_000 / 8


# Top-n and ranks


@pytest.mark.parametrize("by", [["g"], []])
def test_top_n_of_a_hot_group_without_a_sort_of_all(spark, monkeypatch, by):
    df = spark.range(40_000).select(F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
                                    F.when(F.col("id") % 50 != 0, F.col("id") * 7919 % 10007).alias("k"), "id")
    want = rows_of(ranking.row_number(df, by, "k", "rn", ties=["id"]).filter("rn <= 5000"))
    monkeypatch.setattr(ranking, "cut_lineage", lambda df: 1 / 0)
    assert rows_of(ranking.top_n(df, 5000, by, "k", "rn", ties=["id"])) == want
    few = ranking.top_n(df, 50, by, "k", "rn", ties=["id"])
    assert "WindowGroupLimit" in few._jdf.queryExecution().executedPlan().toString()
    assert rows_of(few) == [r for r in want if r[-1] <= 50]
    monkeypatch.setattr(ranking, "TOP_ROWS", 10)
    with pytest.raises(ZeroDivisionError):  # large n: all rows are numbered
        ranking.top_n(df, 5000, by, "k", "rn", ties=["id"])


def test_ranks_work_out_their_input_once(spark, star):
    rates = QUALITY.query(star, ["county_name", "measure_name"], ["performance_rate"], how="inner")
    for found in (ranking.rank(rates, ["measure_name"], "performance_rate", "r"), ranking.percent_rank(rates, ["measure_name"], "performance_rate", "r"),
                  ranking.dense_rank(rates, ["measure_name"], "performance_rate", "r")):
        assert "parquet" not in found._jdf.queryExecution().executedPlan().toString().lower()


# Definitions


def two_definitions(spark, **more):
    events = [event(event_id=i, measurement_year=1990 + i % 12, measure=f"M{i % 3}") for i in range(120)]
    defined = [measure(f"M{m}", f"Measure {m}", threshold=50 + year % 10, measurement_year=year) for m in range(2) for year in (1993, 1998)]
    events_star = star_of(spark, fact_quality_events=events, dim_measure=defined + list(more.get("extra", [])), dim_county=[], dim_provider=[], dim_member=[])
    return FrameStar(events_star.frames, TABLES | {"dim_measure": versions.VERSIONED_MEASURES}), events


def test_two_definitions_multiply_no_event(spark):
    star, events = two_definitions(spark)
    got = {r["event_id"]: r["definition_measurement_year"] for r in versions.events_with_definitions(star, ["event_id"], ["measurement_year"]).collect()}
    want = {}
    for e in events:
        known = [y for y in (1993, 1998) if y <= e["measurement_year"] and e["measure_id"] != "M2"]
        want[e["event_id"]] = max(known, default=None)
    assert got == want
    rates = versions.rates_by_definition(star).collect()
    assert len(rates) == 12 and all(r["regulatory_threshold"] == (None if r["definition_measurement_year"] is None else 50 + r["definition_measurement_year"] % 10) for r in rates)
    keys = checks.repeated_keys(star, ["dim_measure"]).collect()
    assert [tuple(r) for r in keys] == [("dim_measure", "measure_id, measurement_year", 4, 0, 0)]
    twice, _ = two_definitions(spark, extra=[measure("M0", measurement_year=1998)])
    assert checks.repeated_keys(twice, ["dim_measure"]).first()["repeated_keys"] == 1


# Months of enrollment


def test_months_of_spans(spark):
    rng, until = random.Random(3), dt.date(2003, 5, 17)
    day = lambda: dt.date(2000, 1, 1) + dt.timedelta(rng.randrange(1500))
    rows = [(f"m{rng.randrange(20)}", day(), rng.choice([None, day(), day()])) for _ in range(120)] + [("m0", day(), day()) for _ in range(500)] + [
        ("none", None, None), ("back", dt.date(2002, 1, 2), dt.date(2002, 1, 1)), ("late", dt.date(2004, 1, 1), None), ("same", dt.date(2002, 2, 28), dt.date(2002, 2, 28))]
    want = {}
    for key, first, last in rows:
        last = min(last or until, until)
        while first is not None and first <= last:
            want.setdefault((key, first.year), set()).add(first.month)
            first += dt.timedelta(1)
    got = spans.months_of_spans(spark.createDataFrame(rows, "k string, a date, b date"), ["k"], "a", "b", until).collect()
    assert {(r.k, r.year): {i + 1 for i in range(12) if r.months >> i & 1} for r in got} == want


def test_cost_per_member_month(spark):
    members = [{"member_id": "A", "aid_category": "x", "enrollment_start_dt": dt.date(2000, 3, 5), "enrollment_end_dt": dt.date(2001, 1, 1)},
               {"member_id": "B", "aid_category": "x", "enrollment_start_dt": dt.date(2000, 12, 31)}, {"member_id": "C", "aid_category": "y", "enrollment_start_dt": dt.date(2002, 1, 1)}]
    claims = [{"member_id": m, "service_date": d, "paid_amount": p} for m, d, p in [
        ("A", dt.date(2000, 4, 1), 100), ("A", dt.date(2000, 4, 2), 10), ("B", dt.date(2001, 7, 1), None), ("C", dt.date(2001, 2, 1), 7), ("?", dt.date(2000, 1, 1), 5)]]
    from decimal import Decimal

    star = star_of(spark, dim_member=members, fact_claims=[c | {"paid_amount": None if c["paid_amount"] is None else Decimal(c["paid_amount"])} for c in claims])
    got = {(r.aid_category, r.year): (r.member_months, r.claim_count, r.total_paid, r.cost_per_member_month) for r in
           spans.cost_per_member_month(star, dt.date(2001, 12, 31), ["aid_category"]).collect()}
    assert got == {("x", 2000): (11, 2, 110, 10), ("x", 2001): (13, 1, None, 0), ("y", 2001): (0, 1, 7, None), (None, 2000): (0, 1, 5, None)}
    quarters = {(r.year, r.period): r.member_months for r in spans.cost_per_member_month(star, dt.date(2001, 12, 31), per="quarter").collect()}
    assert quarters[2000, 1] == 1 and quarters[2000, 4] == 4 and quarters[2001, 1] == 4 and quarters[2001, 3] == 3


# Anonymity


def test_each_group_has_k_rows_and_no_other_point_loses_less(spark):
    rng = random.Random(4)
    rows = [(f"{rng.choice([10, 10, 10, 27, 99])}{rng.randrange(30):03d}", dt.date(1950 + rng.randrange(50), rng.randrange(1, 13), 1), rng.choice(["F", "F", "M", None]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "zip_code string, date_of_birth date, gender string, id int")
    ladders = [[lambda z: z, lambda z: z[:3], lambda z: z[:2], lambda z: z[:1], lambda z: None],
               [lambda d: d.strftime("%Y-%m"), lambda d: str(d.year), lambda d: f"{d.year // 10 * 10}s", lambda d: None], [lambda g: g, lambda g: None]]
    for k, most in ((2, 0.0), (5, 0.1), (20, 0.5)):
        best = []
        for point in product(*map(lambda ladder: range(len(ladder)), ladders)):
            groups = Counter(tuple(ladder[level](v) for ladder, level, v in zip(ladders, point, row)) for row in rows)
            kept = sum(n for n in groups.values() if n >= k)
            share = sum(level / (len(ladder) - 1) for level, ladder in zip(point, ladders)) / 3
            if len(rows) - kept <= most * len(rows):
                best.append(((len(rows) - kept + kept * share) / len(rows), point, {g: n for g, n in groups.items() if n >= k}))
        loss, point, groups = min(best, key=lambda x: x[:2])
        got = Counter((r.zip_code, r.date_of_birth, r.gender) for r in anonymity.anonymous(df, anonymity.MEMBER_LADDERS, k, most).collect())
        assert got == groups and min(got.values()) >= k
        judged = anonymity.judge(df, anonymity.MEMBER_LADDERS, k)
        assert len(judged) == 40 and abs(min(p.loss for p in judged if p.suppressed <= most * 400) - loss) < 1e-9
    with pytest.raises(ValueError):
        anonymity.anonymous(df, anonymity.MEMBER_LADDERS, 401, 0.1)
    assert anonymity.anonymous(df.limit(0), anonymity.MEMBER_LADDERS, 5).count() == 0


# Batches


@pytest.fixture
def database(spark, tmp_path):
    name = "batches_" + tmp_path.name.replace("-", "_")
    sinks.create_schema(spark, name, str(tmp_path / "tables"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def snapshots(spark, month, members):
    return frame(spark, "fact_enrollment", [{"snapshot_month": dt.date(2000, month, 1), "member_id": m, "aid_category": "x", "is_active": True} for m in members])


def test_a_batch_is_added_once(spark, database, monkeypatch):
    table = f"{database}.fact_enrollment"
    assert sinks.append_batch(snapshots(spark, 1, "AB"), database, "fact_enrollment", 1)
    assert not sinks.append_batch(snapshots(spark, 1, "AB"), database, "fact_enrollment", 1)
    assert spark.table(table).count() == 2
    second = snapshots(spark, 2, "ABC").unionAll(snapshots(spark, 3, "AA"))
    inner = sinks.append

    def half(df, *where):
        inner(df.filter("member_id = 'A'").limit(2), *where)
        raise RuntimeError("cut off")

    with monkeypatch.context() as patch:
        patch.setattr(sinks, "append", half)
        with pytest.raises(RuntimeError):
            sinks.append_batch(second, database, "fact_enrollment", 2)
    assert sinks.batch_state(spark, database, "fact_enrollment", 2) == "begun" and 2 < spark.table(table).count() < 7
    assert sinks.append_batch(second, database, "fact_enrollment", 2)
    assert rows_of(spark.table(table).select("snapshot_month", "member_id")) == rows_of(
        snapshots(spark, 1, "AB").unionAll(second).select("snapshot_month", "member_id"))
    assert not sinks.append_batch(second, database, "fact_enrollment", 2) and spark.table(table).count() == 7


def test_a_retry_reads_its_own_partitions(spark, database, monkeypatch):
    for month in (1, 2, 3):
        sinks.append_batch(snapshots(spark, month, "AB"), database, "fact_enrollment", month)
    sinks.note_batch(spark, database, "fact_enrollment", 4, "begun")
    seen = []
    monkeypatch.setattr(sinks, "cut_lineage", lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    sinks.append_batch(snapshots(spark, 2, "ABC"), database, "fact_enrollment", 4)
    assert "PartitionFilters" in seen[0] and "2000-02-01" in seen[0]
    assert spark.table(f"{database}.fact_enrollment").count() == 7


def test_a_definition_cut_between_drop_and_rename_is_finished(spark, database):
    sinks.create_table(spark, database, "dim_county")
    sinks._create(spark, database, "dim_county__fresh", TABLES["dim_county"])
    spark.sql(f"DROP TABLE {database}.dim_county")
    sinks.create_table(spark, database, "dim_county", replace=False)
    assert spark.catalog.tableExists(f"{database}.dim_county") and not spark.catalog.tableExists(f"{database}.dim_county__fresh")


def test_claims_without_suppliers(spark, tmp_path):
    from conftest import SF_DIR
    from ratestar.sources.order_star import OrderStar

    for name in ("orders", "supplier"):
        rows = OrderStar(spark, SF_DIR).raw(name)
        (rows.limit(0) if name == "supplier" else rows.limit(10)).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert [r["provider_npi"] for r in OrderStar(spark, str(tmp_path)).table("fact_claims", ["provider_npi"]).collect()] == [None] * 10


def test_claims_are_summed_once_per_member_and_period(star):
    plan = spans.cost_per_member_month(star, dt.date(2000, 12, 31), ["aid_category"])._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning(member_id" in line and "period" in line for line in plan.splitlines()) == 1
