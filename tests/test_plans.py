"""What the plans of all registered queries must not hold, and what some must."""

import pytest

from conftest import SF_DIR
from ratestar.operators import ranking
from ratestar.plans import questions as q
from ratestar.plans.registry import QUERIES
from ratestar.sources.order_star import OrderStar

#: Queries that write first; what they return then reads what was written.
WRITES = {"s03_full_refresh", "s04_typed_tables", "s05_typed_append", "s05_numbered_batches", "s06_catalog_scan", "s07_schema"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_pairs_no_python_no_global_window(star, name, monkeypatch):
    monkeypatch.setattr(ranking, "cut_lineage", lambda df: df)  # the plan before the cut and after it
    plan = plan_of(QUERIES[name](star))
    for bad in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
        assert bad not in plan, bad
    # One task for all rows only after aggregation: totals, sort blocks, months.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            below = next(x for x in lines[i + 1:] if "Project" not in x)
            assert "HashAggregate" in below or "WindowGroupLimit" in below, below


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("question", [
    lambda s: q.years_compared(s), lambda s: q.ranked_providers(s, 2000), lambda s: q.claims_cost(s),
    lambda s: q.bottom_quartile_providers(s, 2000)])
def test_answers_do_not_depend_on_broadcasts(spark, star, no_broadcast, question):
    shuffled = question(star)
    got = rows(shuffled)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    assert got == rows(question(star))


def test_line_items_are_shuffled_by_order_and_part_only(spark, no_broadcast):
    star = OrderStar(spark, SF_DIR)
    plan = plan_of(star.table("fact_quality_events", ["measure_id", "county_fips"]))
    assert plan.count("SortMergeJoin") == 3
    shuffles = [line for line in plan.splitlines() if "hashpartitioning(" in line]
    assert sum("o_custkey" in line or "c_custkey" in line for line in shuffles) == 2


def test_a_hot_key_of_a_row_level_join_is_split(spark, no_broadcast):
    from pyspark.sql import functions as F

    from ratestar.sources.star import FrameStar

    i = F.col("id")
    claims = spark.range(0, 300_000, 1, 8).select(
        i.cast("string").alias("claim_id"), F.when(i % 3 == 0, "hot").otherwise(i.cast("string")).alias("member_id"))
    members = spark.range(-1, 300_000).select(
        F.when(i < 0, "hot").otherwise(i.cast("string")).alias("member_id"), (i % 2).cast("string").alias("gender"))
    star = FrameStar({"fact_claims": claims, "dim_member": members})
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB"}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        for how in ("inner", "left"):
            joined = star.join("fact_claims", "dim_member", ["claim_id"], ["gender"], how=how).groupBy("gender").agg(
                F.count("*").alias("n"), F.max("claim_id"))
            assert sum(r.n for r in joined.collect()) == 300_000
            assert "skew=true" in plan_of(joined)
    finally:
        for key in small:
            spark.conf.unset(key)
