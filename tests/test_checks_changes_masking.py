import datetime as dt
from decimal import Decimal

import pytest

from frames import event, measure, provider, rows_of, star_of
from ratestar.operators import checks, masking
from ratestar.operators.changes import snapshot_diff
from ratestar.plans import oracles
from ratestar.schema import TABLES

EMPTY = {name: [] for name in TABLES}


def test_row_counts(spark):
    star = star_of(spark, **{**EMPTY, "dim_provider": [provider(), provider("P2")]})
    counts = dict(rows_of(checks.row_counts(star)))
    assert len(counts) == 7 and counts["dim_provider"] == 2 and counts["fact_claims"] == 0


def test_null_counts(spark):
    star = star_of(spark, **{**EMPTY, "dim_provider": [provider(), provider(None, None)]})
    counts = {(t, c): n for t, c, n in rows_of(checks.null_counts(star))}
    assert counts["dim_provider", "provider_npi"] == counts["dim_provider", "provider_name"] == 1
    assert counts["dim_provider", "provider_type"] == 0
    assert ("dim_provider", "county_fips") not in counts


def test_orphan_keys(spark):
    star = star_of(spark, **{**EMPTY, "dim_measure": [measure()], "fact_quality_events": [
        event(provider_npi=None), event("M2"), event("M2"), event("M3")]})
    found = {e: rest for e, *rest in rows_of(checks.orphan_keys(star))}
    assert found["J8"] == [0, 2, 3]
    assert found["J10"] == [1, 1, 3]
    assert found["J9"] == [0, 1, 4]


def test_repeated_keys(spark):
    star = star_of(spark, **{**EMPTY, "dim_measure": [measure(), measure(), measure("M2")]})
    found = {(t, k): rest for t, k, *rest in rows_of(checks.repeated_keys(star))}
    assert found["dim_measure", "measure_id"] == [2, 1, 1]
    assert found["fact_claims", "claim_id"] == [0, 0, 0]
    assert len(found) == 8


def test_met_but_not_eligible(spark):
    star = star_of(spark, fact_quality_events=[event(), event(eligible=False), event(excluded=None)])
    assert rows_of(checks.met_but_not_eligible(star)) == [("M1", 3, 1, 1)]


def changes(spark, old, new):
    schema = "id int, name string, tags array<string>"
    got = snapshot_diff(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), ["id"])
    return sorted((r.id, r._change_type, r.name, r.copies) for r in got.collect())


def test_snapshot_diff(spark):
    old = [(1, "same", ["a"]), (2, "old", None), (3, "gone", []), (5, "tags", ["a"]), (6, None, None)]
    new = [(1, "same", ["a"]), (2, "new", None), (4, "come", []), (5, "tags", ["a", "b"]), (6, None, None)]
    assert changes(spark, old, new) == [
        (2, "update_postimage", "new", 1), (2, "update_preimage", "old", 1), (3, "delete", "gone", 1),
        (4, "insert", "come", 1), (5, "update_postimage", "tags", 1), (5, "update_preimage", "tags", 1)]
    assert changes(spark, old, old) == []


def test_value_that_becomes_empty_is_an_update(spark):
    assert changes(spark, [(1, "x", None)], [(1, "x", [])]) == [
        (1, "update_postimage", "x", 1), (1, "update_preimage", "x", 1)]


def test_repeated_rows_are_counted_not_paired(spark):
    old = [(1, "x", None)] * 3 + [(2, "y", None)] * 2
    new = [(1, "x", None)] + [(2, "z", None)] * 4
    assert changes(spark, old, new) == [
        (1, "delete", "x", 2), (2, "update_postimage", "z", 4), (2, "update_preimage", "y", 2)]


def test_different_columns_are_refused(spark):
    with pytest.raises(ValueError):
        snapshot_diff(spark.range(1), spark.range(1).withColumnRenamed("id", "other"), ["id"])


def test_later_tags_replace_earlier_ones_of_the_same_key():
    state = masking.final_tags()
    assert state["dim_county", None] == {"domain": "quality", "data_classification": "public", "contains_phi": "false",
                                         "contains_pii": "false", "phi": "false"}
    assert state["dim_member", "date_of_birth"] == {"pii": "ssn", "phi": "date_of_birth"}
    assert state["fact_claims", "paid_amount"] == {"pii": "true", "phi": "financial"}
    tagged = [(t, c, tags.get("phi"), tags.get("pii")) for (t, c), tags in state.items() if c is not None]
    assert sorted(tagged, key=str) == sorted(oracles.TAGGED, key=str)


def test_tag_rollup(spark):
    counts = {(t, v): (tables, columns) for t, v, tables, columns in rows_of(masking.tag_rollup(spark))}
    assert counts["domain", "quality"] == (6, 0)
    assert counts["phi", "member_id"] == (4, 4)
    assert counts["phi", "false"] == (3, 0)


def test_tags_in_the_schema(spark):
    from frames import frame

    df = masking.tag_columns(frame(spark, "dim_member", []), "dim_member")
    assert df.schema["zip_code"].metadata["tags"] == {"pii": "address", "phi": "zip_code"}
    assert "tags" not in df.schema["aid_category"].metadata


MEMBER = {"member_id": "A", "date_of_birth": dt.date(1980, 7, 9), "gender": "F", "zip_code": "12345",
          "aid_category": "SSI", "chronic_condition_flags": ["X"], "enrollment_start_dt": dt.date(2020, 2, 3)}


def test_masking(spark):
    star = star_of(spark, dim_member=[MEMBER], fact_claims=[
        {"claim_id": "1", "member_id": "A", "service_date": dt.date(2024, 5, 6), "paid_amount": Decimal("9.99"),
         "dx_codes": ["d"]}])
    row = masking.masked(star, "dim_member", "salt").first()
    assert len(row.member_id) == 64 and row.date_of_birth == dt.date(1980, 1, 1) and row.zip_code == "123"
    assert row.gender is None and row.chronic_condition_flags is None
    assert row.aid_category == "SSI" and row.enrollment_start_dt == dt.date(2020, 2, 3)
    claim = masking.masked(star, "fact_claims", "salt").first()
    assert claim.member_id == row.member_id and claim.paid_amount is None and claim.dx_codes is None
    assert claim.service_date == dt.date(2024, 1, 1)
    assert masking.masked(star, "dim_member", "other").first().member_id != row.member_id


def test_clearance(spark):
    star = star_of(spark, dim_member=[MEMBER])
    seen = masking.masked(star, "dim_member", "s", cleared=["phi", "pii"]).first()
    assert seen.asDict() == star.table("dim_member").first().asDict()
    partly = masking.masked(star, "dim_member", "s", cleared=["phi"]).first()
    assert partly.chronic_condition_flags == ["X"] and partly.gender is None


def test_masked_keeps_the_schema(star):
    for name, table in TABLES.items():
        got = [(f.name, f.dataType) for f in masking.masked(star, name, "s").schema]
        assert got == [(f.name, f.dataType) for f in table.columns], name
