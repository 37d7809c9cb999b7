import dataclasses
import datetime as dt
import os
import subprocess
import sys
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from frames import event, frame, measure, rows_of, star_of
from ratestar.plans.views import CLAIMS
from ratestar.schema import EDGES, TABLES, edge_between
from ratestar.sources import sinks
from ratestar.sources.star import CatalogStar, ParquetStar


@pytest.fixture
def database(spark, tmp_path):
    name = "db_" + tmp_path.name.replace("-", "_")
    sinks.create_schema(spark, name, str(tmp_path / "tables"))
    sinks.create_schema(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_all_tables_have_the_declared_types(star):
    for name, table in TABLES.items():
        got = [(f.name, f.dataType) for f in star.table(name).schema]
        assert got == [(f.name, f.dataType) for f in table.columns], name


def test_only_wanted_columns_are_read(star):
    plan = star.table("fact_quality_events", ["event_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "l_quantity" not in plan


def test_leaving_out_joins_keeps_the_number_of_events(star):
    narrow = star.table("fact_quality_events", ["event_id"]).count()
    assert star.table("fact_quality_events").count() == narrow


def test_year_range_equals_the_year_filter(star):
    by_range = star.table("fact_quality_events", ["event_id"], {"measurement_year": 2000}).count()
    by_list = star.table("fact_quality_events", ["event_id"], {"measurement_year": [2000]}).count()
    assert by_range == by_list > 0


def test_unknown_names_are_refused(star):
    with pytest.raises(ValueError):
        star.table("fact_nothing")
    with pytest.raises(ValueError):
        star.table("dim_county", ["nothing"])
    with pytest.raises(ValueError):
        edge_between("dim_county", "fact_claims")


def test_edges_name_columns_of_both_tables():
    assert len(EDGES) == 10
    for edge in EDGES.values():
        assert edge.key in TABLES[edge.left].columns.names and (edge.key,) in TABLES[edge.right].keys


def test_typed_table_keeps_comments_and_properties(spark, database):
    sinks.create_table(spark, database, "fact_claims")
    described = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {database}.fact_claims").collect()}
    assert described["paid_amount"] == "Amount paid"
    details = spark.sql(f"DESCRIBE EXTENDED {database}.fact_claims").collect()
    assert any("quality=gold" in (r.data_type or "") for r in details)
    assert any(r.col_name == "Comment" and r.data_type == "One claim." for r in details)


def test_append_adds_rows_by_name_and_casts(spark, database):
    sinks.create_table(spark, database, "dim_county")
    rows = frame(spark, "dim_county", [{"county_fips": "1", "county_name": "Kings", "state_code": "CA"}])
    sinks.append(rows, database, "dim_county")
    sinks.append(rows.select(*reversed(rows.columns)), database, "dim_county")
    assert spark.table(f"{database}.dim_county").count() == 2
    sinks.create_table(spark, database, "dim_county")
    assert spark.table(f"{database}.dim_county").count() == 0


def test_a_definition_that_fails_leaves_the_old_table(spark, database, monkeypatch):
    rows = frame(spark, "dim_county", [{"county_fips": "1", "county_name": "Kings", "state_code": "CA"}])
    sinks.full_refresh(rows, database, "dim_county")
    monkeypatch.setitem(TABLES, "dim_county", dataclasses.replace(TABLES["dim_county"], partition_by=("nowhere",)))
    with pytest.raises(Exception):
        sinks.create_table(spark, database, "dim_county")
    assert spark.table(f"{database}.dim_county").count() == 1


def test_scratch_folders_go_with_the_application(tmp_path):
    script = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from ratestar.session import build_session, scratch_folder
spark = build_session("local[1]", spark_ui_enabled="false", spark_checkpoint_dir={str(tmp_path)!r})
spark.range(5).write.parquet(scratch_folder(spark, "x") + "/rows")
spark.stop()
"""
    subprocess.run([sys.executable, "-c", script], check=True, timeout=120, capture_output=True)
    assert not [p for p in tmp_path.rglob("*.parquet")]


def test_members_give_their_attributes_to_facts_at_load(spark):
    star = star_of(spark, dim_member=[{"member_id": "A", "county_fips": "9", "aid_category": "X"}],
                   fact_quality_events=[event(county_fips="old"), event(member_id="B", county_fips="old")])
    rows = sinks.with_member_attributes(star, "fact_quality_events", ("county_fips",))
    assert rows.columns == TABLES["fact_quality_events"].columns.names
    assert rows_of(rows.select("member_id", "county_fips")) == [("A", "9"), ("B", None)]


def test_append_refuses_amounts_that_do_not_fit(spark, database):
    sinks.create_table(spark, database, "dim_measure")
    wide = frame(spark, "dim_measure", [measure()]).withColumn("regulatory_threshold", F.lit(Decimal("1000.0")))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|OVERFLOW"):
        sinks.append(wide, database, "dim_measure")


def test_writes_refuse_empty_required_columns(spark, database):
    rows = frame(spark, "dim_county", [{"county_fips": "1", "county_name": None, "state_code": "CA"}])
    with pytest.raises(Exception, match="dim_county.county_name is required"):
        sinks.append(rows, database, "dim_county")


def test_null_check_looks_into_files(spark, tmp_path):
    from ratestar.operators.checks import null_counts

    frame(spark, "dim_county", [{"county_fips": "1", "county_name": None, "state_code": "CA"}]).write.parquet(
        str(tmp_path / "dim_county"))
    assert ("dim_county", "county_name", 1) in rows_of(null_counts(ParquetStar(spark, str(tmp_path)), ["dim_county"]))


def test_full_refresh_drops_periods_that_are_gone(spark, database):
    def month(day):
        return frame(spark, "fact_enrollment", [{"snapshot_month": day, "member_id": "A", "aid_category": "SSI", "is_active": True}])
    sinks.full_refresh(month(dt.date(2024, 1, 1)), database, "fact_enrollment")
    sinks.full_refresh(month(dt.date(2024, 2, 1)), database, "fact_enrollment")
    sinks.append(month(dt.date(2024, 3, 1)), database, "fact_enrollment")
    months = spark.table(f"{database}.fact_enrollment").select("snapshot_month")
    assert rows_of(months) == [(dt.date(2024, 2, 1),), (dt.date(2024, 3, 1),)]


def test_full_refresh_replaces_and_round_trips(spark, star, database):
    claims = star.table("fact_claims")
    sinks.full_refresh(claims, database, "fact_claims")
    sinks.full_refresh(claims, database, "fact_claims")
    details = spark.sql(f"DESCRIBE EXTENDED {database}.fact_claims").collect()
    assert any("quality=gold" in (r.data_type or "") for r in details)
    assert any(r.col_name == "paid_amount" and r.comment == "Amount paid" for r in details)
    stored = CatalogStar(spark, database)
    asked = (["measurement_year", "claim_type"], ["claim_count", "total_paid", "avg_paid", "unique_members"])
    assert rows_of(CLAIMS.query(stored, *asked)) == rows_of(CLAIMS.query(star, *asked))
    plan = CLAIMS.query(stored, ["claim_type"], ["claim_count"], {"measurement_year": 2000})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(measurement_year" in text


def test_whole_star_is_loaded_and_answers_alike(spark, star, tmp_path):
    from ratestar.plans.questions import measures_at_risk

    name = "db_whole_star"
    sinks.create_schema(spark, name, str(tmp_path / "whole"))
    sinks.load_star(star, spark, name)
    stored = CatalogStar(spark, name)
    assert rows_of(measures_at_risk(stored, 2000)) == rows_of(measures_at_risk(star, 2000))
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_parquet_star_reads_with_the_declared_schema(spark, tmp_path):
    frame(spark, "dim_county", [{"county_fips": "1", "county_name": "Kings", "state_code": "CA"}]).write.parquet(
        str(tmp_path / "dim_county"))
    got = ParquetStar(spark, str(tmp_path)).table("dim_county", ["county_name"], {"state_code": "CA"})
    assert rows_of(got) == [("Kings",)]


def test_views_answer_sql_and_can_be_dropped(spark, star):
    star.create_views(spark)
    star.create_views(spark)
    assert spark.sql("SELECT COUNT(*) FROM dim_county").first()[0] == 25
    star.drop_views(spark)
    assert not spark.catalog.tableExists("dim_county")


def test_join_of_an_edge(spark):
    star = star_of(spark, fact_quality_events=[event(), event(county_fips=None), event(county_fips="C9")],
                   dim_county=[{"county_fips": "C1", "county_name": "Kings", "state_code": "CA"}])
    asked = ("fact_quality_events", "dim_county", ["measure_id"], ["county_name"])
    assert rows_of(star.join(*asked)) == [("C1", "M1", "Kings")]
    assert star.join(*asked, how="left").count() == 3
