"""The spread-out ranks equal Spark's own window functions."""

import random

import pytest
from pyspark.sql import Window, functions as F

from frames import rows_of
from ratestar.operators import ranking


@pytest.fixture(scope="module")
def rates(spark):
    """Ties, missing rates, one group with a third of the rows and one with a single row."""
    rng = random.Random(7)
    rows = []
    for i in range(6000):
        group = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        value = None if rng.random() < 0.05 else 100.0 if rng.random() < 0.3 else round(rng.random() * 100, 1)
        rows.append((group, f"name{i:05d}", value))
    rows.append(("single", "only", 5.0))
    return spark.createDataFrame(rows, "grp string, name string, rate double").repartition(8)


BY = [[], ["grp"]]


def window(by, descending):
    order = F.col("rate").desc_nulls_last() if descending else F.col("rate").asc_nulls_first()
    return Window.partitionBy(*by).orderBy(order)


@pytest.mark.parametrize("by", BY)
@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("ours, theirs", [
    (ranking.rank, F.rank), (ranking.dense_rank, F.dense_rank), (ranking.percent_rank, F.percent_rank)])
def test_rank_family(rates, by, descending, ours, theirs):
    got = ours(rates, by, "rate", "r", descending=descending).select("grp", "name", "rate", "r")
    assert rows_of(got) == rows_of(rates.withColumn("r", theirs().over(window(by, descending))))


@pytest.mark.parametrize("by", BY)
@pytest.mark.parametrize("tiles", [1, 3, 4, 10])
def test_ntile(rates, by, tiles):
    got = ranking.ntile(rates, tiles, by, "rate", "t", ties=["name"]).select("grp", "name", "rate", "t")
    exact = Window.partitionBy(*by).orderBy(F.col("rate").asc_nulls_first(), "name")
    assert rows_of(got) == rows_of(rates.withColumn("t", F.ntile(tiles).over(exact)))


def test_ntile_with_fewer_rows_than_tiles(rates):
    few = rates.orderBy("name").limit(3)
    got = ranking.ntile(few, 10, [], "name", "t")
    assert [r.t for r in got.orderBy("name").collect()] == [1, 2, 3]


@pytest.mark.parametrize("by", BY)
def test_row_number_and_top_n(rates, by):
    exact = Window.partitionBy(*by).orderBy(F.col("rate").desc_nulls_last(), "name")
    expected = rates.withColumn("n", F.row_number().over(exact))
    got = ranking.row_number(rates, by, "rate", "n", ties=["name"]).select("grp", "name", "rate", "n")
    assert rows_of(got) == rows_of(expected)
    top = ranking.top_n(rates, 5, by, "rate", "n", ties=["name"]).select("grp", "name", "rate", "n")
    assert rows_of(top) == rows_of(expected.filter("n <= 5"))


def test_no_rows(rates):
    none = rates.filter("false")
    assert ranking.rank(none, ["grp"], "rate", "r").count() == 0
    assert ranking.ntile(none, 4, [], "rate", "t").count() == 0


def test_no_task_takes_a_whole_group(rates):
    for df in (ranking.rank(rates, [], "rate", "r"), ranking.ntile(rates, 4, ["grp"], "rate", "n")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window [" in line]
        assert windows and all("sum(_n" in line or "_block" in line for line in windows)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    # The first rows of a group: map tasks send no more than those, of each part and then of all parts.
    plan = ranking.top_n(rates, 3, ["grp"], "rate", "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 3 and "CartesianProduct" not in plan


def test_a_value_that_most_rows_share_is_spread(spark):
    """60 % of the rows have one rate: no task of the result holds over twice the average."""
    n, i = 200_000, F.col("id")
    df = spark.range(0, n, 1, 8).select(
        F.when(i % 2 == 0, "a").otherwise("b").alias("grp"), i.alias("name"),
        F.when(i % 5 < 3, 100.0).otherwise((i % 9973).cast("double")).alias("rate"))
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        for ranked in (ranking.rank(df, ["grp"], "rate", "r"), ranking.dense_rank(df, ["grp"], "rate", "r")):
            sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == n and max(sizes) < 2 * n / 8
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_top_n_beyond_the_limit_of_window_groups(spark):
    i = F.col("id")
    df = spark.range(0, 30_000, 1, 8).select(F.when(i % 3 < 2, "hot").otherwise("cold").alias("grp"), i.alias("name"), (i * 7919 % 30_011).alias("rate"))
    got = ranking.top_n(df, 5_000, ["grp"], "rate", "n", ties=["name"])
    exact = df.withColumn("n", F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("rate"), "name"))).filter("n <= 5000")
    assert got.count() == 10_000 and got.select(*exact.columns).exceptAll(exact).count() == 0
