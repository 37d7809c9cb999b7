"""Every registered query gives the rows of its SQL twin."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, differences
from conftest import SF_DIR
from ratestar.plans import registry

QUERIES = {name: query for name, query in entry_points.queries().items() if name in registry.QUERIES}
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    found = differences(con, df, ORACLES[name])
    assert not found, "\n".join(found[:5])


def test_views_of_the_session_are_no_tables_of_a_schema(spark, con):
    spark.range(1).createOrReplaceTempView("a_view_of_the_session")
    try:
        assert not differences(con, QUERIES["s07_schema"](spark, SF_DIR), ORACLES["s07_schema"])
    finally:
        spark.catalog.dropTempView("a_view_of_the_session")


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


ORDERED = sorted(n for n in QUERIES if n[:3] in ("l01", "l02", "l03", "l04", "l05"))


@pytest.mark.parametrize("name", ORDERED)
def test_rows_come_in_the_order_of_the_twin(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = con.execute(ORACLES[name])
    places = [[d[0] for d in cursor.description].index(c) for c in df.columns]
    theirs = [tuple(row[i] for i in places) for row in cursor.fetchall()]
    assert [tuple(r) for r in df.collect()] == theirs and len(theirs) > 1


#: The columns by which each question sorts; - for the largest first, + for NULL first, | for the size without sign.
SORTS = {
    "q01": "-enrolled_members +county_name +state_code", "q02": "+measure_name", "q03": "-|gap_to_threshold +measure_name",
    "q04": "+measure_name +measurement_year", "q05": "+measure_name", "q06": "+measure_name +measurement_quarter",
    "q07": "-performance_rate -denominator +provider_name +provider_type", "q08": "+snapshot_month +aid_category",
    "q09": "+measure_name +provider_rank +provider_name +provider_type", "q10": "+measure_name +measurement_year +quarter",
    "q11": "+overall_performance_rate +provider_name +provider_type", "q12": "+snapshot_month",
    "q13": "+measure_name -percentile_rank", "q14": "-total_paid",
}


@pytest.mark.parametrize("question", sorted(SORTS))
def test_questions_come_in_order(spark, question):
    name = min(n for n in QUERIES if n.startswith(question))
    rows = QUERIES[name](spark, SF_DIR).collect()
    keys = []
    for row in rows:
        key = []
        for part in SORTS[question].split():
            value = row[part.strip("+-|")]
            value = abs(value) if "|" in part and value is not None else value
            if part[0] == "-":
                key.append((value is None, 0 if value is None else -value))
            else:
                key.append((value is not None, "" if value is None else value))
        keys.append(tuple(key))
    assert keys == sorted(keys) and len(keys) > 1
