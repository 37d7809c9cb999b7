"""Stored aggregates: building, taking in changes, exact distinct counts, and which questions they answer."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from frames import frame, rows_of
from ratestar.operators.changes import snapshot_diff
from ratestar.operators.metric_view import Condition
from ratestar.operators.rollups import Rollup, RoutedView
from ratestar.plans.stored import PEOPLE_BY_COUNTY, QUALITY_BY_COUNTY, QUALITY_BY_QUARTER, without_fact
from ratestar.plans.views import CLAIMS, QUALITY
from ratestar.sources.star import FrameStar

CLAIMS_BY_TYPE = Rollup(CLAIMS, "claims_by_type", ("measurement_year", "claim_type"), ("claim_count", "paid", "paid_claims", "unique_members"), ("measurement_year",))
ASKED = ["claim_count", "total_paid", "avg_paid", "unique_members", "cost_per_member"]


def claims(spark, rows):
    return FrameStar({"fact_claims": frame(spark, "fact_claims", rows), "dim_member": frame(spark, "dim_member", [
        {"member_id": f"M{i}", "gender": "FM"[i % 2]} for i in range(40)]), "dim_provider": frame(spark, "dim_provider", [])})


def claim(rng, number):
    return {"claim_id": f"C{number}", "member_id": f"M{rng.randrange(40)}", "provider_npi": None, "service_date": dt.date(2000, 1, 1), "claim_type": rng.choice("ABC"),
            "paid_amount": rng.choice([None, Decimal(rng.randrange(10000)) / 100]), "measurement_year": rng.randrange(1999, 2003)}


def files(folder):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet")}


def test_refreshed_equals_rebuilt(spark, tmp_path):
    rng = random.Random(1)
    before = [claim(rng, i) for i in range(300)]
    changed = [r | {"paid_amount": Decimal("1.50"), "claim_type": "D"} if r["measurement_year"] == 2000 and rng.random() < 0.5 else r for r in before]
    after = [r for r in changed if r["measurement_year"] != 2001] + [claim(rng, 300 + i) | {"measurement_year": 2000, "member_id": f"N{i}"} for i in range(30)]
    old, new = claims(spark, before), claims(spark, after)
    stored = CLAIMS_BY_TYPE.build(old, str(tmp_path / "stored"))
    assert rows_of(stored.query(old, ["claim_type"], ASKED)) == rows_of(CLAIMS.query(old, ["claim_type"], ASKED))
    untouched = {k: v for k, v in files(tmp_path / "stored").items() if "1999" in k or "2002" in k}
    changes = snapshot_diff(old.table("fact_claims"), new.table("fact_claims"), ["claim_id"])
    stored.refresh(changes, new, batch=1)
    for dimensions in (["claim_type"], ["measurement_year", "claim_type"]):
        want = rows_of(CLAIMS.query(new, dimensions, ASKED))
        assert rows_of(stored.query(new, dimensions, ASKED)) == want
    assert untouched and {k: files(tmp_path / "stored").get(k) for k in untouched} == untouched
    # Called again, as after a cut, it changes nothing.
    stored.refresh(changes, new, batch=1)
    assert rows_of(stored.query(new, ["claim_type"], ASKED)) == rows_of(CLAIMS.query(new, ["claim_type"], ASKED))
    numbers = [r["_number"] for r in stored.table("numbers-member_id").collect()]
    assert sorted(numbers) == list(range(len(numbers))) and len(numbers) > 40
    # A second batch that takes the first one back.
    stored.refresh(snapshot_diff(new.table("fact_claims"), old.table("fact_claims"), ["claim_id"]), old, batch=2)
    assert rows_of(stored.query(old, ["measurement_year", "claim_type"], ASKED)) == rows_of(CLAIMS.query(old, ["measurement_year", "claim_type"], ASKED))


def test_a_cut_between_sums_and_bitmaps_is_mended(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    before = [claim(rng, i) for i in range(60)]
    after = [r for r in before if r["claim_type"] != "A"] + [claim(rng, 100 + i) for i in range(20)]
    old, new = claims(spark, before), claims(spark, after)
    stored = CLAIMS_BY_TYPE.build(old, str(tmp_path / "stored"))
    changes = snapshot_diff(old.table("fact_claims"), new.table("fact_claims"), ["claim_id"])
    with monkeypatch.context() as patch:
        patch.setattr(type(stored), "_number", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            stored.refresh(changes, new, batch=1)
    stored.refresh(changes, new, batch=1)
    assert rows_of(stored.query(new, ["claim_type"], ASKED)) == rows_of(CLAIMS.query(new, ["claim_type"], ASKED))


@pytest.fixture(scope="module")
def routed(spark, star, tmp_path_factory):
    folder = tmp_path_factory.mktemp("rollups")
    return RoutedView(QUALITY, tuple(r.build(star, str(folder / r.name)) for r in (QUALITY_BY_COUNTY, QUALITY_BY_QUARTER, PEOPLE_BY_COUNTY)))


QUESTIONS = [
    ("quality_by_quarter", dict(dimensions=["measure_name"], measures=["performance_rate", "gap_to_threshold"], where={"measurement_year": 2000})),
    ("quality_by_quarter", dict(dimensions=["quarter_label"], measures=["total_events"], where={"measure_category": "Diabetes"}, how="inner")),
    ("quality_by_quarter", dict(dimensions=[], measures=["denominator", "performance_rate"])),
    ("quality_by_county", dict(dimensions=["region", "measure_category"], measures=["exclusion_count"], conditions=[
        Condition(("region", "quarter"), lambda col: (col("region") < "B") | (col("quarter") == 1))])),
    ("people_by_county", dict(dimensions=["region"], measures=["distinct_members", "total_events"])),
    ("people_by_county", dict(dimensions=["urban_rural_class", "measurement_year"], measures=["distinct_providers"], where={"state_code": lambda c: c > "S3"})),
]


@pytest.mark.parametrize("name, question", QUESTIONS)
def test_routed_answers(routed, star, name, question):
    found = routed.route(question["dimensions"], question["measures"], question.get("where"), question.get("conditions", ()))
    assert found.rollup.name == name
    got = routed.query(without_fact(star, found.rollup), **question)
    assert f"/{name}/" in got._jdf.queryExecution().executedPlan().toString() and "lineitem" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows_of(got) == rows_of(QUALITY.query(star, **question))


@pytest.mark.parametrize("question", [
    dict(dimensions=["measure_name", "provider_type"], measures=["performance_rate"]), dict(dimensions=["measure_name"], measures=["distinct_members"]),
    dict(dimensions=["quarter"], measures=["total_events"], where={"data_source": "EHR"}), dict(dimensions=["aid_category"], measures=["total_events"])])
def test_other_questions_go_to_the_fact(routed, star, question):
    assert routed.route(question["dimensions"], question["measures"], question.get("where")) is None
    assert rows_of(routed.query(star, **question)) == rows_of(QUALITY.query(star, **question))
    with pytest.raises(ValueError):
        routed.stored[0].query(star, **question)


def test_regions_need_the_bitmaps_only_once_each(routed, star):
    found = routed.query(star, ["region"], ["distinct_members"])
    by_county = QUALITY.query(star, ["region", "county_fips"], ["distinct_members"])
    added = by_county.groupBy("region").agg(F.sum("distinct_members").alias("n"))
    joined = found.join(added, "region").collect()
    assert joined and all(r["distinct_members"] <= r["n"] for r in joined)


def test_changes_are_looked_for_in_the_columns_that_rates_come_from(star):
    from ratestar.plans import stored

    assert set(stored.earlier(star).table("fact_quality_events").columns) == set(stored.CHANGING)
    assert {"event_id", "in_numerator", "measure_id"} < set(stored.CHANGING) and "member_id" not in stored.CHANGING
