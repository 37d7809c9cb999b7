"""The same queries as SQL text for DuckDB over the raw tables, to compare results with.

Written on their own, from the meaning of each query: rates are rounded with
whole numbers, views join every dimension table, ranks use plain windows.
"""

from __future__ import annotations

import re

from ratestar.schema import TABLES

# The star tables as SQL over the raw tables.
STAR = {
    "dim_county": """
        SELECT lpad(CAST(n_nationkey + 1000 AS VARCHAR), 5, '0') AS county_fips, n_name AS county_name,
               r_name AS region,
               (['Metropolitan', 'Micropolitan', 'Rural', 'Frontier'])[n_nationkey % 4 + 1] AS urban_rural_class,
               'S' || CAST(n_nationkey % 10 AS VARCHAR) AS state_code
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "dim_provider": """
        SELECT CAST(1000000000 + s_suppkey AS VARCHAR) AS provider_npi,
               'Provider ' || CAST(s_suppkey - CASE WHEN s_suppkey % 20 = 16 THEN 4 ELSE 0 END AS VARCHAR) AS provider_name,
               (['PCP', 'Specialist', 'FQHC', 'Hospital'])[s_suppkey % 4 + 1] AS provider_type,
               'T' || CAST(s_suppkey % 8 AS VARCHAR) AS specialty_code,
               lpad(CAST(s_nationkey + 1000 AS VARCHAR), 5, '0') AS county_fips,
               s_suppkey % 20 < 17 AS accepting_medicaid
        FROM supplier""",
    "dim_member": """
        SELECT 'MBR' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS member_id,
               DATE '1945-01-01' + CAST((c_custkey * 37) % 28000 AS INTEGER) AS date_of_birth,
               CASE WHEN c_custkey % 50 = 0 THEN 'Other' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               'R' || CAST(c_custkey % 7 AS VARCHAR) AS race_ethnicity,
               lpad(CAST(c_nationkey + 1000 AS VARCHAR), 5, '0') AS county_fips,
               CAST(10000 + c_custkey % 90000 AS VARCHAR) AS zip_code,
               c_mktsegment AS aid_category,
               c_custkey % 25 < 2 AS smi_flag,
               CASE c_custkey % 5 WHEN 0 THEN CAST([] AS VARCHAR[]) WHEN 1 THEN ['Diabetes']
                    WHEN 2 THEN ['Diabetes', 'Hypertension'] WHEN 3 THEN ['Asthma', 'Depression', 'Obesity'] END
                    AS chronic_condition_flags,
               DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS enrollment_start_dt,
               CASE WHEN c_custkey % 10 >= 7 THEN DATE '2000-01-01' + CAST(c_custkey % 600 AS INTEGER) END
                    AS enrollment_end_dt
        FROM customer""",
    "dim_measure": """
        SELECT p_brand AS measure_id, 'Measure ' || CAST(n AS VARCHAR) AS measure_name,
               (['Diabetes', 'Preventive', 'Behavioral Health', 'Respiratory', 'Utilization'])[n % 5 + 1]
                   AS measure_category,
               (['HEDIS', 'CMS Adult Core Set', 'CMS Child Core Set'])[n % 3 + 1] AS reporting_standard,
               CASE WHEN n % 9 = 0 THEN 'Lower is Better' ELSE 'Higher is Better' END AS reporting_direction,
               CAST(60 + (n % 4) * 3 AS DECIMAL(5, 2)) AS regulatory_threshold,
               n % 3 <> 0 AS high_priority_flag, n % 2 = 0 AS star_rating_flag
        FROM (SELECT DISTINCT p_brand, CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS n FROM part)""",
    "fact_quality_events": """
        SELECT l_orderkey * 10 + l_linenumber AS event_id,
               'MBR' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS member_id, p_brand AS measure_id,
               CAST(year(l_shipdate) AS INTEGER) AS measurement_year,
               CAST(quarter(l_shipdate) AS INTEGER) AS "quarter",
               l_linenumber < 7 AS in_denominator, l_linenumber < 7 AND l_quantity <= 32 AS in_numerator,
               CASE WHEN l_quantity <> 50 THEN l_linenumber < 7 AND l_discount >= 0.095 END AS exclusion_applied,
               CAST(l_shipdate AS DATE) AS service_date,
               CAST(1000000000 + l_suppkey AS VARCHAR) AS provider_npi,
               CASE WHEN l_linestatus = 'F' THEN 'Admin' ELSE 'EHR' END AS data_source,
               lpad(CAST(c_nationkey + 1000 AS VARCHAR), 5, '0') AS county_fips
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON l_partkey = p_partkey""",
    "fact_enrollment": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_month,
               'MBR' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS member_id, c_mktsegment AS aid_category,
               lpad(CAST(c_nationkey + 1000 AS VARCHAR), 5, '0') AS county_fips,
               o_orderpriority AS plan_id, o_orderkey % 10 <> 0 AS is_active
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "fact_claims": """
        SELECT 'CLM' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS claim_id,
               'MBR' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS member_id,
               CAST(1000000000 + o_orderkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS provider_npi,
               CAST(o_orderdate AS DATE) AS service_date,
               CASE o_orderstatus WHEN 'F' THEN 'IP' WHEN 'O' THEN 'OP' WHEN 'P' THEN 'Prof' END AS claim_type,
               CASE o_orderkey % 4 WHEN 0 THEN ['E11.9'] WHEN 1 THEN ['I10', 'E11.9']
                    WHEN 2 THEN ['J45.20', 'I10', 'Z23'] ELSE CAST([] AS VARCHAR[]) END AS dx_codes,
               CASE o_orderkey % 3 WHEN 0 THEN ['99213'] WHEN 1 THEN ['99214', '83036'] END AS proc_codes,
               lpad(CAST((o_orderkey % 10) * 10 + 100 AS VARCHAR), 4, '0') AS revenue_code,
               CAST(o_totalprice AS DECIMAL(12, 2)) AS paid_amount,
               CAST(year(o_orderdate) AS INTEGER) AS measurement_year
        FROM orders""",
}

NUM = "COUNT(*) FILTER (WHERE e.in_numerator AND NOT e.exclusion_applied)"
DEN = "COUNT(*) FILTER (WHERE e.in_denominator AND NOT e.exclusion_applied)"


def rate(n: str = NUM, d: str = DEN) -> str:
    """n / d in percent, two digits, half up, in whole numbers."""
    return f"CASE WHEN {d} > 0 THEN CAST(({n} * 20000 + {d}) // (2 * {d}) AS DOUBLE) / 100 END"


def raw(n: str = NUM, d: str = DEN) -> str:
    return f"{n} * 100.0 / NULLIF({d}, 0)"


def gap(threshold: str, n: str = NUM, d: str = DEN) -> str:
    over = f"(CAST({threshold} * 100 AS BIGINT) * {d} - {n} * 10000)"
    return (f"CASE WHEN {d} > 0 THEN CAST(sign({over}) * ((2 * abs({over}) + {d}) // (2 * {d})) AS DOUBLE) / 100 END")


PAID = "SUM(c.paid_amount)"
CENTS = "CAST(SUM(c.paid_amount) * 100 AS HUGEINT)"
MICRO = f"(({CENTS} * 20000 + COUNT(c.paid_amount)) // (2 * COUNT(c.paid_amount)))"
MEMBERS = "COUNT(DISTINCT c.member_id)"

VIEWS = {
    "quality": ("fact_quality_events e", {"m": ("dim_measure", "measure_id"), "y": ("dim_county", "county_fips"),
                                          "p": ("dim_provider", "provider_npi"), "b": ("dim_member", "member_id")}),
    "enrollment": ("fact_enrollment e", {"y": ("dim_county", "county_fips"), "b": ("dim_member", "member_id")}),
    "claims": ("fact_claims c", {"b": ("dim_member", "member_id"), "p": ("dim_provider", "provider_npi")}),
}
COLUMN = {
    "quality": {**{c: f"e.{c}" for c in ("measure_id", "measurement_year", "quarter", "county_fips", "provider_npi",
                                         "data_source")},
                **{c: f"m.{c}" for c in ("measure_name", "measure_category", "reporting_standard",
                                         "reporting_direction", "high_priority_flag", "star_rating_flag")},
                "regulatory_threshold": "CAST(m.regulatory_threshold AS DOUBLE)",
                **{c: f"y.{c}" for c in ("county_name", "state_code", "region", "urban_rural_class")},
                **{c: f"p.{c}" for c in ("provider_name", "provider_type")},
                **{c: f"b.{c}" for c in ("aid_category", "gender", "race_ethnicity")}},
    "enrollment": {**{c: f"e.{c}" for c in ("snapshot_month", "aid_category", "county_fips", "plan_id", "is_active")},
                   **{c: f"y.{c}" for c in ("county_name", "state_code", "region")}, "gender": "b.gender"},
    "claims": {**{c: f"c.{c}" for c in ("claim_type", "measurement_year", "revenue_code", "provider_npi")},
               "aid_category": "b.aid_category", "gender": "b.gender",
               **{c: f"p.{c}" for c in ("provider_name", "provider_type")}},
}
MEASURE = {
    "denominator": DEN, "numerator": NUM, "total_events": "COUNT(*)",
    "exclusion_count": "COUNT(*) FILTER (WHERE e.exclusion_applied)",
    "performance_rate": rate(), "gap_to_threshold": gap("any_value(m.regulatory_threshold)"),
    "distinct_members": "COUNT(DISTINCT e.member_id)", "distinct_providers": "COUNT(DISTINCT e.provider_npi)",
    "enrolled_members": "COUNT(DISTINCT e.member_id)",
    "active_member_months": "COUNT(*) FILTER (WHERE e.is_active)", "snapshots": "COUNT(*)",
    "claim_count": "COUNT(*)", "total_paid": f"CAST({PAID} AS DOUBLE)", "unique_members": MEMBERS,
    "avg_paid": f"CAST(({MICRO} + 5000) // 10000 AS DOUBLE) / 100",
    "cost_per_member": f"CAST((2 * {CENTS} + {MEMBERS}) // (2 * {MEMBERS}) AS DOUBLE) / 100",
}


def view(name: str, dimensions: list[str], measures: list[str], where: str = "", how: str = "LEFT",
         extra: str = "") -> str:
    source, joins = VIEWS[name]
    fact = source.split()[1]
    columns = [f"{COLUMN[name][d]} AS \"{d}\"" for d in dimensions] + [f"{MEASURE[m]} AS {m}" for m in measures]
    joined = " ".join(f"{how} JOIN {t} {a} ON {fact}.{k} = {a}.{k}" for a, (t, k) in joins.items()
                      if how == "LEFT" or any(COLUMN[name][d].startswith(f"{a}.") for d in dimensions) or f"{a}." in where)
    group = " GROUP BY ALL" if dimensions else ""
    return (f"SELECT {', '.join(columns)}{extra} FROM {source} {joined}"
            f"{' WHERE ' + where if where else ''}{group}")


def with_star(body: str) -> str:
    tables = [t for t in STAR if re.search(rf"\b{t}\b", body)]
    ctes = ", ".join(f"{t} AS ({STAR[t]})" for t in tables)
    return re.sub(r"\s+", " ", f"WITH {ctes} {body}" if ctes else body).strip()


HIGHER_2000 = "e.measurement_year = 2000 AND m.reporting_direction = 'Higher is Better'"
PROVIDER = ["provider_name", "provider_type"]
PROVIDER_MEASURE = view("quality", [*PROVIDER, "measure_name"], ["performance_rate"], HIGHER_2000, "INNER",
                        f", {raw()} AS raw_rate")
PROVIDER_NPI_MEASURE = view("quality", ["provider_npi", *PROVIDER, "measure_name"], ["performance_rate"], HIGHER_2000,
                            "INNER", f", {raw()} AS raw_rate")
PROVIDER_ALL = view("quality", PROVIDER, ["performance_rate"], "e.measurement_year = 2000", "INNER",
                    f", {raw()} AS raw_rate")
ORDERED = "provider_name ASC NULLS FIRST, provider_type ASC NULLS FIRST"
MONTHS = "SELECT snapshot_month, COUNT(DISTINCT member_id) AS monthly_active_members FROM fact_enrollment WHERE is_active GROUP BY ALL"


def tiles(n: int, name: str) -> str:
    return (f"SELECT provider_name, provider_type, performance_rate AS overall_performance_rate, "
            f"CAST(ntile({n}) OVER (ORDER BY raw_rate ASC NULLS FIRST, {ORDERED}) AS INTEGER) AS {name} "
            f"FROM ({PROVIDER_ALL})")


def lagged(rates: str, by: str, period: list[str], function: str, name: str) -> str:
    columns = ", ".join([by, *period])
    return (f"SELECT {columns}, performance_rate, {function}(performance_rate) OVER "
            f"(PARTITION BY {by} ORDER BY {', '.join(period)}) AS {name} FROM ({rates})")


def difference(lag: str, columns: str, first: str, second: str, name: str) -> str:
    cents = f"(CAST(round({first} * 100) AS BIGINT) - CAST(round({second} * 100) AS BIGINT))"
    return f"SELECT {columns}, CAST({cents} AS DOUBLE) / 100 AS {name} FROM ({lag})"


PERIOD = ["measurement_year", "quarter"]
BY_QUARTER = view("quality", ["measure_name", *PERIOD], ["performance_rate"], how="INNER")
BY_YEAR = view("quality", ["measure_name", "measurement_year"], ["performance_rate"], how="INNER")
CATEGORY_QUARTER = view("quality", ["measure_category", *PERIOD], ["performance_rate"])


def percentile(rates: str, columns: str, by: str, key: str) -> str:
    part = f"PARTITION BY {by}" if by else ""
    place = f"rank() OVER ({part} ORDER BY {key} ASC NULLS FIRST)"
    size = f"COUNT(*) OVER ({part})"
    return (f"SELECT {columns}, CASE WHEN n > 1 THEN CAST(((r - 1) * 2000 + (n - 1)) // (2 * (n - 1)) AS DOUBLE) / 10 "
            f"ELSE 0.0 END AS percentile_rank FROM (SELECT *, {place} AS r, {size} AS n FROM ({rates}))")


# The quarters of the rates with gaps, months enrolled, and definitions of several years.
GAPPY = 'NOT (e.measurement_year % 2 = 0 AND e."quarter" = 2)'
NUMBER = 'measurement_year * 4 + "quarter"'
DEFINED = """(SELECT measure_id, measure_name, 2000 AS since, regulatory_threshold FROM dim_measure
    UNION ALL SELECT measure_id, measure_name, 1994, regulatory_threshold - 5 FROM dim_measure
    UNION ALL SELECT measure_id, measure_name, 1997, regulatory_threshold + 2 FROM dim_measure WHERE right(measure_id, 1) IN ('1', '3', '5'))"""
MONTHS_ENROLLED = """(SELECT member_id, aid_category, CAST(year(m) AS INTEGER) AS "year", CAST(month(m) AS INTEGER) AS "month" FROM (
    SELECT member_id, aid_category, unnest(generate_series(CAST(date_trunc('month', enrollment_start_dt) AS TIMESTAMP),
        CAST(least(coalesce(enrollment_end_dt, DATE '2000-12-31'), DATE '2000-12-31') AS TIMESTAMP), INTERVAL 1 MONTH)) AS m
    FROM dim_member WHERE enrollment_start_dt <= least(coalesce(enrollment_end_dt, DATE '2000-12-31'), DATE '2000-12-31')))"""


def in_time(by: str, distance: int, name: str, first: str, second: str, change: str) -> str:
    rates = view("quality", [by, *PERIOD], ["performance_rate"], GAPPY, "INNER")
    joined = (f"SELECT a.*, b.performance_rate AS {name} FROM ({rates}) a LEFT JOIN ({rates}) b ON a.{by} = b.{by} "
              f'AND a.measurement_year * 4 + a."quarter" = b.measurement_year * 4 + b."quarter" + {distance}')
    return difference(joined, f'{by}, measurement_year, "quarter", performance_rate, {name}', first, second, change)


def cost(by: list[str], period: str) -> str:
    """Cents over months, rounded half up in whole numbers; period is SQL over a month's number."""
    keys = ", ".join([*by, '"year"', "period"])
    return f"""
        SELECT {keys}, CAST(coalesce(SUM(months), 0) AS BIGINT) AS member_months, CAST(coalesce(SUM(claims), 0) AS BIGINT) AS claim_count,
               CAST(SUM(cents) AS DOUBLE) / 100 AS total_paid,
               CASE WHEN SUM(months) > 0 THEN CAST((2 * coalesce(SUM(cents), 0) + SUM(months)) // (2 * SUM(months)) AS DOUBLE) / 100 END AS cost_per_member_month
        FROM (SELECT {", ".join([*by, '"year"'])}, {period} AS period, 1 AS months, NULL AS claims, NULL AS cents FROM {MONTHS_ENROLLED}
              UNION ALL BY NAME
              SELECT {"".join(f"b.{c}, " for c in by)} CAST(year(service_date) AS INTEGER) AS "year", {period.replace('"month"', 'CAST(month(service_date) AS INTEGER)')} AS period,
                     1 AS claims, CAST(paid_amount * 100 AS HUGEINT) AS cents FROM fact_claims c LEFT JOIN dim_member b ON c.member_id = b.member_id
              WHERE year(service_date) <= 2000)
        GROUP BY {keys}"""


WRITTEN = ("dim_county", "dim_provider", "dim_member", "fact_enrollment", "fact_claims")


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _catalog_columns() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, {_text(f.dataType.simpleString())} AS type, {_text(f.metadata['comment'])} AS comment, "
        f"{f.name in TABLES[t].partition_by} AS partitions, COUNT({f.name}) AS filled FROM {t}" for t in WRITTEN for f in TABLES[t].columns)


def _catalog_tables() -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, {_text(TABLES[t].comment)} AS comment, 'gold' AS quality, COUNT(*) AS row_count FROM {t}" for t in WRITTEN)


#: The ladders of the anonymous members, as SQL over the member table.
LADDERS = {
    "zip_code": ["zip_code", "substr(zip_code, 1, 3)", "substr(zip_code, 1, 2)", "substr(zip_code, 1, 1)", "NULL"],
    "date_of_birth": ["strftime(date_of_birth, '%Y-%m')", "strftime(date_of_birth, '%Y')", "CAST(year(date_of_birth) // 10 * 10 AS VARCHAR) || 's'", "NULL"],
    "gender": ["gender", "NULL"],
}


def anonymous(k: int, most: str) -> str:
    """Every level of coarseness one after the other, the cheapest that leaves out few enough."""
    points = [(z, d, g) for z in range(5) for d in range(4) for g in range(2)]
    rows = " UNION ALL ".join(
        f"SELECT {i} AS point, {z / 4 + d / 3 + g} AS climbed, CAST({LADDERS['zip_code'][z]} AS VARCHAR) AS zip_code, "
        f"CAST({LADDERS['date_of_birth'][d]} AS VARCHAR) AS date_of_birth, CAST({LADDERS['gender'][g]} AS VARCHAR) AS gender, aid_category FROM dim_member"
        for i, (z, d, g) in enumerate(points))
    return f"""
        SELECT zip_code, date_of_birth, gender, aid_category, COUNT(*) AS members
        FROM (SELECT *, COUNT(*) OVER (PARTITION BY point, zip_code, date_of_birth, gender) AS n FROM ({rows}))
        WHERE n >= {k} AND point = (
            SELECT point FROM (
                SELECT point, COUNT(*) AS total, COUNT(*) FILTER (WHERE n >= {k}) AS kept, MAX(climbed) / 3 AS share
                FROM (SELECT *, COUNT(*) OVER (PARTITION BY point, zip_code, date_of_birth, gender) AS n FROM ({rows})) GROUP BY point)
            WHERE total - kept <= {most} * total ORDER BY (total - kept) + kept * share, point LIMIT 1)
        GROUP BY ALL"""


def _member_year(year: int) -> str:
    return (f"SELECT member_id, COUNT(CASE WHEN is_active THEN 1 END) AS active_months, MAX(plan_id) AS last_plan "
            f"FROM fact_enrollment WHERE year(snapshot_month) = {year} GROUP BY member_id")


def _orphans() -> str:
    edges = [("J1", "dim_member", "dim_county", "county_fips"), ("J2", "dim_provider", "dim_county", "county_fips"),
             ("J3", "fact_claims", "dim_member", "member_id"), ("J4", "fact_claims", "dim_provider", "provider_npi"),
             ("J5", "fact_enrollment", "dim_county", "county_fips"), ("J6", "fact_enrollment", "dim_member", "member_id"),
             ("J7", "fact_quality_events", "dim_county", "county_fips"),
             ("J8", "fact_quality_events", "dim_measure", "measure_id"),
             ("J9", "fact_quality_events", "dim_member", "member_id"),
             ("J10", "fact_quality_events", "dim_provider", "provider_npi")]
    return " UNION ALL ".join(
        f"SELECT '{i}' AS edge, COUNT(*) - COUNT(l.{k}) AS empty_rows, "
        f"COUNT(DISTINCT CASE WHEN r.{k} IS NULL THEN l.{k} END) AS orphan_keys, "
        f"COUNT(CASE WHEN r.{k} IS NULL THEN l.{k} END) AS orphan_rows "
        f"FROM {left} l LEFT JOIN {right} r ON l.{k} = r.{k}" for i, left, right, k in edges)


REQUIRED = {
    "dim_county": "county_fips county_name state_code", "dim_provider": "provider_npi provider_name provider_type",
    "dim_member": "member_id date_of_birth aid_category enrollment_start_dt",
    "dim_measure": "measure_id measure_name measure_category reporting_standard measurement_year reporting_direction",
    "fact_quality_events": "event_id member_id measure_id measurement_year quarter in_denominator in_numerator",
    "fact_enrollment": "snapshot_month member_id aid_category is_active",
    "fact_claims": "claim_id member_id service_date claim_type measurement_year",
}
KEYS = [("dim_county", "county_fips"), ("dim_provider", "provider_npi"), ("dim_member", "member_id"),
        ("dim_measure", "measure_id"), ("fact_quality_events", "event_id"),
        ("fact_quality_events", "member_id, measure_id, measurement_year"),
        ("fact_enrollment", "member_id, snapshot_month"), ("fact_claims", "claim_id")]
TAGGED = [("dim_provider", "provider_npi", None, "ssn"), ("dim_provider", "provider_name", None, "ssn"),
          ("dim_member", "member_id", "member_id", "true"), ("dim_member", "date_of_birth", "date_of_birth", "ssn"),
          ("dim_member", "gender", "demographics", "true"), ("dim_member", "race_ethnicity", "demographics", "true"),
          ("dim_member", "zip_code", "zip_code", "address"), ("dim_member", "chronic_condition_flags", "diagnosis", None),
          ("fact_quality_events", "member_id", "member_id", "true"),
          ("fact_quality_events", "service_date", "service_date", None),
          ("fact_enrollment", "member_id", "member_id", "true"), ("fact_claims", "member_id", "member_id", "true"),
          ("fact_claims", "dx_codes", "diagnosis", None), ("fact_claims", "service_date", "service_date", None),
          ("fact_claims", "paid_amount", "financial", "true")]


def _quoted(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


def _exposure() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) AS row_count, COUNT({c}) AS filled, "
        f"{_quoted(phi)} AS phi, {_quoted(pii)} AS pii FROM {t}" for t, c, phi, pii in TAGGED)


def _nulls() -> str:
    def column(table: str, name: str) -> str:
        value = "2000" if (table, name) == ("dim_measure", "measurement_year") else f'"{name}"'
        return (f"SELECT '{table}' AS table_name, '{name}' AS column_name, COUNT(*) - COUNT({value}) AS null_count "
                f"FROM {table}")
    return " UNION ALL ".join(column(t, c) for t, names in REQUIRED.items() for c in names.split())


def _keys() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{k}' AS key_columns, COUNT(*) AS distinct_keys, "
        f"COUNT(CASE WHEN n > 1 THEN 1 END) AS repeated_keys, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS surplus_rows "
        f"FROM (SELECT COUNT(*) AS n FROM {t} GROUP BY {k})" for t, k in KEYS)


def _codes(column: str) -> str:
    return (f"SELECT code, COUNT(*) AS claim_count, COUNT(DISTINCT member_id) AS unique_members, "
            f"CAST(SUM(paid_amount) AS DOUBLE) AS total_paid "
            f"FROM (SELECT member_id, paid_amount, unnest({column}) AS code FROM fact_claims) GROUP BY code")


ENROLLED = view("enrollment", ["county_name", "state_code"], ["enrolled_members", "active_member_months"], how="INNER")
AT_RISK = ("(reporting_direction = 'Higher is Better' AND performance_rate < regulatory_threshold) OR "
           "(reporting_direction = 'Lower is Better' AND performance_rate > regulatory_threshold)")

ORACLES: dict[str, str] = {name: with_star(body) for name, body in {
    "s01_typed_scan": "SELECT o_orderstatus, COUNT(*) AS orders, MIN(o_orderkey) AS first_key, "
                      "MAX(o_orderkey) AS last_key FROM orders GROUP BY o_orderstatus",
    "s02_inferred_scan": "SELECT c_mktsegment, COUNT(*) AS customers FROM customer GROUP BY c_mktsegment",
    "s10_member_county_on_events":
        'SELECT b.county_fips, e."quarter", COUNT(*) AS events, COUNT(DISTINCT e.member_id) AS members '
        'FROM fact_quality_events e LEFT JOIN dim_member b USING (member_id) GROUP BY ALL',
    "s10_member_attributes_on_enrollment":
        "SELECT e.member_id, CAST(e.snapshot_month AS VARCHAR) AS month, b.aid_category, b.county_fips "
        "FROM fact_enrollment e LEFT JOIN dim_member b USING (member_id)",
    "s03_full_refresh": view("claims", ["measurement_year", "claim_type"], ["claim_count", "total_paid"]),
    "s05_typed_append": view("enrollment", ["plan_id", "is_active"], ["snapshots", "enrolled_members"]),
    "s06_catalog_scan": "SELECT region, gender, COUNT(*) AS members FROM dim_member JOIN dim_county USING (county_fips) "
                        "GROUP BY region, gender",
    "s08_views": "SELECT r_name AS region, COUNT(*) AS counties FROM nation JOIN region ON n_regionkey = r_regionkey "
                 "GROUP BY r_name",
    "s09_measurement_year": "SELECT measurement_year, COUNT(*) AS claims, CAST(MIN(service_date) AS VARCHAR) AS first_day, "
                            "CAST(MAX(service_date) AS VARCHAR) AS last_day FROM fact_claims GROUP BY measurement_year",
    "s10_member_attributes_on_claims": "SELECT c.member_id, c.claim_id, c.claim_type, b.aid_category, b.county_fips "
                                       "FROM fact_claims c LEFT JOIN dim_member b ON c.member_id = b.member_id",
    "s11_snapshot_diff": f"""
        , old AS ({_member_year(1999)}), new AS ({_member_year(2000)}),
        pairs AS (SELECT o.*, n.member_id AS n_id, n.active_months AS n_months, n.last_plan AS n_plan
                  FROM old o FULL JOIN new n ON o.member_id = n.member_id)
        SELECT member_id, active_months, last_plan,
               CASE WHEN n_id IS NULL THEN 'delete' ELSE 'update_preimage' END AS _change_type, CAST(1 AS BIGINT) AS copies
        FROM pairs WHERE member_id IS NOT NULL AND (n_id IS NULL OR active_months <> n_months OR last_plan <> n_plan)
        UNION ALL
        SELECT n_id, n_months, n_plan, CASE WHEN member_id IS NULL THEN 'insert' ELSE 'update_postimage' END, 1
        FROM pairs WHERE n_id IS NOT NULL AND (member_id IS NULL OR active_months <> n_months OR last_plan <> n_plan)""",
    "p01_projection": "SELECT claim_id, provider_name AS provider, provider_type AS practice "
                      "FROM fact_claims JOIN dim_provider USING (provider_npi)",
    "p02_all_of_derived_table": f"SELECT * FROM ({view('claims', ['claim_type'], ['claim_count', 'total_paid'])}) WHERE claim_count > 0",
    "p03_nested_derived_table": f"SELECT aid_category, MAX(unique_members) AS most_members FROM "
                                f"({view('claims', ['aid_category', 'claim_type'], ['unique_members'])}) GROUP BY 1",
    "p04_ordinals": "SELECT aid_category, plan_id, COUNT(*) AS snapshots, COUNT(*) FILTER (WHERE is_active) AS active_snapshots "
                    "FROM fact_enrollment GROUP BY ALL",
    "p05_case_without_else": f"SELECT data_source, {NUM} AS met FROM fact_quality_events e GROUP BY data_source",
    "p06_case_with_else": "SELECT plan_id, COUNT(*) FILTER (WHERE is_active) AS active, COUNT(*) FILTER (WHERE NOT is_active) AS inactive "
                          "FROM fact_enrollment GROUP BY plan_id",
    "f01_year": view("quality", ["measure_id"], ["total_events"], "e.measurement_year = 2000"),
    "f02_year_and_quarter": view("quality", ["measure_id"], ["total_events"], 'e.measurement_year = 2000 AND e."quarter" = 1'),
    "f03_category": view("quality", ["measure_name"], ["total_events"], "m.measure_category = 'Diabetes'"),
    "f04_direction": view("quality", ["measure_name"], ["total_events"], "m.reporting_direction = 'Higher is Better'"),
    "f05_at_risk_after_aggregation":
        f"SELECT * FROM ({view('quality', ['measure_id', 'reporting_direction', 'regulatory_threshold'], ['performance_rate'])}) WHERE {AT_RISK}",
    "f06_after_window": f"SELECT * FROM ({tiles(4, 'performance_quartile')}) WHERE performance_quartile = 4",
    "f07_top_n_filter": f"SELECT * EXCLUDE (raw_rate) FROM (SELECT *, CAST(row_number() OVER (PARTITION BY measure_name "
                        f"ORDER BY raw_rate DESC NULLS LAST, {ORDERED}) AS INTEGER) AS rn FROM ({PROVIDER_MEASURE})) WHERE rn <= 1",
    "f08_active_members": "SELECT aid_category, COUNT(*) AS snapshots FROM fact_enrollment WHERE is_active GROUP BY 1",
    "f09_eligible_for_measure": 'SELECT "quarter", COUNT(*) AS events FROM fact_quality_events '
                                'WHERE in_denominator AND exclusion_applied = FALSE GROUP BY 1',
    "f10_high_priority_measures": view("quality", ["measure_category"], ["total_events", "performance_rate"], "m.high_priority_flag"),
    "f11_star_rating_measures": view("quality", ["measure_category"], ["total_events", "performance_rate"], "m.star_rating_flag"),
    "f13_either_of_two_tables": view("quality", ["measure_category"], ["total_events", "performance_rate"],
                                     "e.measurement_year = 2000 AND (m.star_rating_flag OR (b.gender = 'F' AND e.\"quarter\" = 1))"),
    "f12_three_valued_logic": f"SELECT exclusion_applied, COUNT(*) AS events, {DEN} AS eligible "
                              f"FROM fact_quality_events e GROUP BY exclusion_applied",
    "j01_member_county": "SELECT region, COUNT(*) AS row_count FROM dim_member JOIN dim_county USING (county_fips) GROUP BY 1",
    "j02_provider_county": "SELECT region, COUNT(*) AS row_count FROM dim_provider JOIN dim_county USING (county_fips) GROUP BY 1",
    "j03_claims_member": view("claims", ["gender"], ["claim_count", "total_paid"], how="INNER"),
    "j04_claims_provider": view("claims", ["provider_type"], ["claim_count", "total_paid"], how="INNER"),
    "j05_enrollment_county": view("enrollment", ["region"], ["snapshots"], how="INNER"),
    "j06_enrollment_member": view("enrollment", ["gender"], ["snapshots"], how="INNER"),
    "j07_events_county": view("quality", ["urban_rural_class"], ["total_events"], how="INNER"),
    "j08_events_measure": view("quality", ["reporting_standard"], ["total_events"], how="INNER"),
    "j09_events_member": view("quality", ["race_ethnicity"], ["total_events"], how="INNER"),
    "j10_events_provider": view("quality", ["provider_type"], ["total_events"], how="INNER"),
    "j11_star_join": view("quality", ["measure_category", "region", "provider_type", "gender"],
                          ["total_events", "denominator", "numerator", "performance_rate"]),
    "j12_three_way_join": view("quality", ["provider_type", "measure_category"], ["numerator", "denominator"], how="INNER"),
    "a01_denominator": view("quality", ["measure_name"], ["denominator"]),
    "a02_numerator": view("quality", ["measure_name"], ["numerator"]),
    "a03_total_events": view("quality", ["data_source"], ["total_events"]),
    "a04_exclusion_count": view("quality", ["provider_type"], ["exclusion_count"]),
    "a05_performance_rate": view("quality", ["county_name", "state_code"], ["performance_rate"]),
    "a06_gap_to_threshold": view("quality", ["measure_id", "measurement_year"], ["gap_to_threshold"]),
    "a07_distinct_members": view("quality", ["region"], ["distinct_members"]),
    "a08_distinct_providers": view("quality", ["measure_category"], ["distinct_providers"]),
    "a09_total_paid": view("claims", ["measurement_year"], ["total_paid"]),
    "a10_cost_per_member": view("claims", ["gender"], ["cost_per_member"]),
    "a11_claim_count": view("claims", ["claim_type", "aid_category"], ["claim_count"]),
    "a12_avg_paid": view("claims", ["provider_type"], ["avg_paid"]),
    "a13_unique_members": view("claims", ["claim_type"], ["unique_members"]),
    "a14_enrolled_members": view("enrollment", ["region"], ["enrolled_members"]),
    "a15_active_member_months": view("enrollment", ["plan_id"], ["active_member_months"]),
    "a16_monthly_active_members": MONTHS,
    "a18_five_keys": view("quality", ["measure_name", "measure_category", "measurement_year", "reporting_direction",
                                      "regulatory_threshold"], ["total_events", "exclusion_count"]),
    "m02_all_measures": view("quality", ["measure_id", "measurement_year"],
                             ["denominator", "numerator", "total_events", "exclusion_count", "performance_rate",
                              "gap_to_threshold", "distinct_members", "distinct_providers"]),
    "m02_all_measures_in_total": view("quality", [], ["denominator", "numerator", "total_events", "exclusion_count",
                                                      "performance_rate", "distinct_members", "distinct_providers"]),
    "m03_filter_before": view("quality", ["region", "aid_category"], ["denominator", "performance_rate"],
                              "e.measurement_year IN (1999, 2000) AND b.gender = 'F'"),
    "m04_filter_after": f"SELECT * FROM ({view('quality', PROVIDER, ['performance_rate', 'denominator'])}) "
                        f"WHERE performance_rate > 66 AND denominator >= 10",
    "m01_by_quarter_label":
        'SELECT CAST(measurement_year AS VARCHAR) || \'-Q\' || CAST("quarter" AS VARCHAR) AS quarter_label, * EXCLUDE (measurement_year, "quarter") FROM ('
        + view("quality", ["measurement_year", "quarter", "measure_category"], ["total_events", "performance_rate"]) + ")",
    "m01_by_member_age":
        "SELECT CAST(floor(datediff('day', b.date_of_birth, current_date) / 365.25) AS INTEGER) AS member_age, COUNT(*) AS total_events, "
        "COUNT(DISTINCT e.member_id) AS distinct_members FROM fact_quality_events e LEFT JOIN dim_member b USING (member_id) "
        "WHERE e.measurement_year = 2000 GROUP BY 1",
    "m02_members_and_providers": view("quality", ["provider_type", "aid_category"],
                                      ["denominator", "performance_rate", "distinct_members", "distinct_providers"]),
    "m02_distinct_by_provider_type": view("quality", ["provider_type"], ["total_events", "distinct_members", "distinct_providers"]),
    "m06_window_on_view": f"SELECT *, CAST(rank() OVER (PARTITION BY measure_category ORDER BY performance_rate DESC NULLS LAST) "
                          f"AS INTEGER) AS category_rank FROM ({view('quality', ['measure_category', 'measure_name'], ['performance_rate'])})",
    "m07_one_rate": f"SELECT *, performance_rate AS recomputed FROM "
                    f"({view('quality', ['state_code', 'quarter'], ['numerator', 'denominator', 'performance_rate'])})",
    "w01_rank_by_provider_number": f"SELECT * EXCLUDE (raw_rate), CAST(rank() OVER (PARTITION BY measure_name ORDER BY raw_rate DESC "
                                   f"NULLS LAST) AS INTEGER) AS provider_rank FROM ({PROVIDER_NPI_MEASURE})",
    "w02_previous_quarter_by_category": difference(
        lagged(CATEGORY_QUARTER, "measure_category", ["measurement_year", '"quarter"'], "lag", "prev_quarter_rate"),
        'measure_category, measurement_year, "quarter", performance_rate, prev_quarter_rate',
        "performance_rate", "prev_quarter_rate", "qoq_change"),
    "w03_quartiles_per_measure": f"SELECT * EXCLUDE (raw_rate), CAST(ntile(4) OVER (PARTITION BY measure_name ORDER BY raw_rate ASC "
                                 f"NULLS FIRST, {ORDERED}) AS INTEGER) AS performance_quartile FROM ({PROVIDER_MEASURE})",
    "w04_running_and_rolling_by_aid_category": """
        SELECT snapshot_month, aid_category, monthly_active_members,
               strftime(snapshot_month, '%Y-%m') AS enrollment_month_label,
               CAST(SUM(monthly_active_members) OVER (PARTITION BY aid_category ORDER BY snapshot_month) AS BIGINT)
                   AS cumulative_member_months,
               CAST((20 * SUM(monthly_active_members) OVER w + COUNT(*) OVER w) // (2 * COUNT(*) OVER w) AS DOUBLE) / 10
                   AS rolling_6mo_avg
        FROM (SELECT snapshot_month, aid_category, COUNT(DISTINCT member_id) AS monthly_active_members
              FROM fact_enrollment WHERE is_active GROUP BY ALL)
        WINDOW w AS (PARTITION BY aid_category ORDER BY snapshot_month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
    "w05_provider_percentile": percentile(
        f"SELECT provider_name, provider_type, performance_rate AS overall_performance_rate FROM ({PROVIDER_ALL})",
        "provider_name, provider_type, overall_performance_rate", "", "overall_performance_rate"),
    "w06_dense_rank": f"SELECT * EXCLUDE (raw_rate), CAST(dense_rank() OVER (PARTITION BY measure_name ORDER BY raw_rate DESC "
                      f"NULLS LAST) AS INTEGER) AS provider_rank FROM ({PROVIDER_MEASURE})",
    "w07_next_quarter": difference(
        lagged(BY_QUARTER, "measure_name", ["measurement_year", '"quarter"'], "lead", "next_quarter_rate"),
        'measure_name, measurement_year, "quarter", performance_rate, next_quarter_rate',
        "next_quarter_rate", "performance_rate", "next_change"),
    "w08_year_over_year": difference(
        lagged(BY_YEAR, "measure_name", ["measurement_year"], "lag", "prev_year_rate"),
        "measure_name, measurement_year, performance_rate, prev_year_rate",
        "performance_rate", "prev_year_rate", "yoy_change"),
    "w09_deciles": tiles(10, "performance_decile"),
    "w10_top_providers": f"SELECT * EXCLUDE (raw_rate) FROM (SELECT *, CAST(row_number() OVER (PARTITION BY measure_name "
                         f"ORDER BY raw_rate DESC NULLS LAST, {ORDERED}) AS INTEGER) AS rn FROM ({PROVIDER_MEASURE})) WHERE rn <= 3",
    "w11_aggregate_in_window": f"SELECT m.measure_category, m.measure_name, CAST(rank() OVER (PARTITION BY m.measure_category "
                               f"ORDER BY {raw()} DESC NULLS LAST) AS INTEGER) AS category_rank FROM fact_quality_events e "
                               f"JOIN dim_measure m ON e.measure_id = m.measure_id WHERE e.measurement_year = 2000 GROUP BY m.measure_category, m.measure_name",
    "l01_sort_by_one": view("claims", ["claim_type"], ["total_paid"]) + " ORDER BY total_paid DESC, claim_type",
    "l02_sort_by_many": view("quality", ["measure_name", "measurement_year"], ["numerator"])
                        + " ORDER BY measure_name NULLS FIRST, measurement_year NULLS FIRST",
    "l03_mixed_sort": view("quality", ["measure_name", "state_code"], ["numerator"])
                      + " ORDER BY measure_name NULLS FIRST, numerator DESC, state_code NULLS FIRST",
    "l04_sort_by_expression": view("quality", ["measure_name"], ["gap_to_threshold"])
                              + " ORDER BY abs(gap_to_threshold) DESC NULLS LAST, measure_name NULLS FIRST",
    "l05_top_k": f"{ENROLLED} ORDER BY enrolled_members DESC, county_name, state_code LIMIT 5",
    "x01_round": "SELECT claim_type, CAST(ROUND(SUM(paid_amount), 0) AS DOUBLE) AS paid_0, "
                 "CAST(ROUND(SUM(paid_amount), 1) AS DOUBLE) AS paid_1, CAST(SUM(paid_amount) AS DOUBLE) AS paid_2 "
                 "FROM fact_claims GROUP BY claim_type",
    "x02_nullif": f'SELECT "quarter", in_denominator, {rate()} AS performance_rate FROM fact_quality_events e GROUP BY "quarter", in_denominator',
    "x03_abs": f"SELECT measure_id, ABS(gap_to_threshold) AS distance FROM ({view('quality', ['measure_id'], ['gap_to_threshold'])})",
    "x04_measurement_quarter": "SELECT CAST(measurement_year AS VARCHAR) || '-Q' || CAST(\"quarter\" AS VARCHAR) AS measurement_quarter, "
                               "COUNT(*) AS events FROM fact_quality_events GROUP BY 1",
    "x05_member_age": "SELECT CAST(floor(datediff('day', date_of_birth, DATE '2000-12-31') / 365.25) AS INTEGER) AS member_age, "
                      "COUNT(*) AS members FROM dim_member GROUP BY 1",
    "x06_enrollment_month_label": "SELECT strftime(snapshot_month, '%Y-%m') AS month, COUNT(*) AS snapshots FROM fact_enrollment GROUP BY 1",
    "x07_arithmetic": f'SELECT data_source, "quarter", CAST((x * 20000 + t) // (2 * t) AS DOUBLE) / 100 AS excluded_percent, t - x AS kept FROM '
                      f'(SELECT data_source, "quarter", {MEASURE["exclusion_count"]} AS x, COUNT(*) AS t FROM fact_quality_events e GROUP BY ALL)',
    "x08_comparison": f"SELECT measure_id, performance_rate < regulatory_threshold AS below, performance_rate > regulatory_threshold AS above, "
                      f"regulatory_threshold = 63 AS is_63 FROM ({view('quality', ['measure_id', 'regulatory_threshold'], ['performance_rate'])})",
    "x09_current_date": "SELECT aid_category, COUNT(CASE WHEN enrollment_end_dt < current_date THEN 1 END) AS ended, "
                        "COUNT(*) - COUNT(enrollment_end_dt) AS open, "
                        "COUNT(*) FILTER (WHERE dayofyear(enrollment_start_dt) < 183) AS overdue, "
                        "COUNT(*) FILTER (WHERE dayofyear(enrollment_start_dt) = 183) AS due FROM dim_member GROUP BY aid_category",
    "x10_array": "SELECT member_id, gender || '/' || race_ethnicity AS profile, CAST(len([gender, race_ethnicity]) AS INTEGER) AS parts FROM dim_member",
    "x11_month_start": "SELECT CAST(CAST(date_trunc('month', service_date) AS DATE) AS VARCHAR) AS month, COUNT(*) AS claims FROM fact_claims GROUP BY 1",
    "x12_year_and_quarter": "SELECT CAST(year(service_date) AS INTEGER) AS year, CAST(quarter(service_date) AS INTEGER) AS service_quarter, "
                            "COUNT(*) AS claims FROM fact_claims GROUP BY 1, 2",
    "x13_zero_padded_keys": "SELECT o_orderkey, 'CLM' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS claim_id, "
                            "CASE WHEN o_orderkey >= 1000 THEN CAST(o_orderkey * 100000 AS VARCHAR) "
                            "ELSE lpad(CAST(o_orderkey * 100000 AS VARCHAR), 8, '0') END AS wide_key FROM orders",
    "r01_claims_by_condition": "SELECT condition, COUNT(DISTINCT member_id) AS members, COUNT(*) AS claim_count, "
                               "CAST(SUM(paid_amount) AS DOUBLE) AS total_paid FROM (SELECT c.member_id, c.paid_amount, "
                               "unnest(b.chronic_condition_flags) AS condition FROM fact_claims c JOIN dim_member b ON c.member_id = b.member_id) "
                               "GROUP BY condition",
    "r02_claims_by_diagnosis": _codes("dx_codes"),
    "r02_claims_by_procedure": _codes("proc_codes"),
    "r02_claims_with_diagnosis": "SELECT claim_type, COUNT(*) AS claim_count, CAST(SUM(paid_amount) AS DOUBLE) AS total_paid "
                                 "FROM fact_claims WHERE list_contains(dx_codes, 'I10') GROUP BY claim_type",
    "q01_enrollment_by_county": f"{ENROLLED} ORDER BY enrolled_members DESC, county_name, state_code LIMIT 15",
    "q02_quarter_metrics": view("quality", ["measure_name", "measure_category", "reporting_direction", "regulatory_threshold"],
                                ["denominator", "numerator", "performance_rate", "gap_to_threshold"],
                                'e.measurement_year = 2000 AND e."quarter" = 1'),
    "q03_measures_at_risk": "SELECT * FROM (" + view(
        "quality", ["measure_name", "measure_category", "measurement_year", "reporting_direction", "regulatory_threshold"],
        ["performance_rate", "gap_to_threshold", "denominator"], "e.measurement_year = 2000") + f") WHERE {AT_RISK}",
    "q04_years_compared": view("quality", ["measure_name", "measure_category", "measurement_year"],
                               ["performance_rate", "denominator", "numerator", "distinct_members"]),
    "q05_diabetes_performance": view("quality", ["measure_name", "reporting_direction", "regulatory_threshold"],
                                     ["denominator", "numerator", "performance_rate", "gap_to_threshold"],
                                     "e.measurement_year = 2000 AND m.measure_category = 'Diabetes'"),
    "q06_behavioral_health_by_quarter":
        "SELECT *, CAST(measurement_year AS VARCHAR) || '-Q' || CAST(\"quarter\" AS VARCHAR) AS measurement_quarter FROM (" + view(
            "quality", ["measure_name", "measurement_year", "quarter"], ["denominator", "numerator", "performance_rate"],
            "m.measure_category = 'Behavioral Health'") + ")",
    "q07_most_compliant_providers": view("quality", PROVIDER, ["denominator", "numerator", "performance_rate"], HIGHER_2000, "INNER")
        + " ORDER BY performance_rate DESC NULLS LAST, denominator DESC, provider_name, provider_type LIMIT 10",
    "q08_enrollment_by_aid_category": "SELECT snapshot_month, aid_category, COUNT(DISTINCT member_id) AS monthly_active_members, "
                                      "strftime(snapshot_month, '%Y-%m') AS enrollment_month_label FROM fact_enrollment WHERE is_active "
                                      "GROUP BY snapshot_month, aid_category",
    "q09_ranked_providers": f"SELECT * EXCLUDE (raw_rate), CAST(rank() OVER (PARTITION BY measure_name ORDER BY raw_rate DESC "
                            f"NULLS LAST) AS INTEGER) AS provider_rank FROM ({PROVIDER_MEASURE})",
    "q10_quarter_over_quarter": difference(
        lagged(BY_QUARTER, "measure_name", ["measurement_year", '"quarter"'], "lag", "prev_quarter_rate"),
        'measure_name, measurement_year, "quarter", performance_rate, prev_quarter_rate',
        "performance_rate", "prev_quarter_rate", "qoq_change"),
    "q11_bottom_quartile_providers": f"SELECT * FROM ({tiles(4, 'performance_quartile')}) WHERE performance_quartile = 1",
    "q12_cumulative_enrollment": f"""
        SELECT snapshot_month, monthly_active_members,
               CAST(SUM(monthly_active_members) OVER (ORDER BY snapshot_month) AS BIGINT) AS cumulative_member_months,
               ROUND(AVG(monthly_active_members) OVER (ORDER BY snapshot_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 0)
                   AS rolling_3mo_avg
        FROM ({MONTHS})""",
    "q13_county_percentiles": percentile(
        view("quality", ["county_name", "state_code", "measure_name"], ["performance_rate"],
             "e.measurement_year = 2000 AND m.measure_category = 'Diabetes'", "INNER"),
        "county_name, state_code, measure_name, performance_rate", "measure_name", "performance_rate"),
    "q14_claims_cost": view("claims", ["claim_type", "aid_category"],
                            ["claim_count", "total_paid", "avg_paid", "unique_members"], how="INNER"),
    "v01_row_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in STAR),
    "v02_null_counts": _nulls(),
    "v03_orphan_keys": _orphans(),
    "v04_repeated_keys": _keys(),
    "v05_met_but_not_eligible": "SELECT measure_id, COUNT(*) AS total_events, "
                                "COUNT(CASE WHEN in_numerator AND NOT in_denominator THEN 1 END) AS met_not_eligible, "
                                "COUNT(*) - COUNT(exclusion_applied) AS unknown_exclusion FROM fact_quality_events GROUP BY measure_id",
    "g01_sensitive_exposure": _exposure(),
    "g02_masked_members": """
        SELECT sha256('ratestar' || member_id) AS member_id, CAST(date_trunc('year', date_of_birth) AS DATE) AS date_of_birth,
               CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS VARCHAR) AS race_ethnicity, county_fips,
               substr(zip_code, 1, 3) AS zip_code, aid_category, smi_flag, enrollment_start_dt, enrollment_end_dt,
               TRUE AS conditions_hidden FROM dim_member""",
    "g02_masked_claims": """
        SELECT claim_id, sha256('ratestar' || member_id) AS member_id, provider_npi,
               CAST(date_trunc('year', service_date) AS DATE) AS service_date, claim_type, revenue_code, TRUE AS dx_hidden,
               CAST(len(proc_codes) AS INTEGER) AS proc_count, CAST(NULL AS DOUBLE) AS paid_amount, measurement_year
        FROM fact_claims""",
    "s04_typed_tables": _catalog_columns(),
    "s05_numbered_batches": "SELECT is_active, CAST(year(snapshot_month) AS INTEGER) AS year, COUNT(DISTINCT (member_id, snapshot_month)) AS keys, "
                            "COUNT(DISTINCT member_id) AS members FROM fact_enrollment GROUP BY ALL",
    "s07_schema": _catalog_tables(),
    "s11_refreshed_rates": view("quality", ["measure_name", "measurement_year"],
                                ["total_events", "denominator", "numerator", "performance_rate", "gap_to_threshold"]),
    "m08_routed_to_stored": view("quality", ["measure_name", "quarter"], ["denominator", "numerator", "performance_rate", "gap_to_threshold"],
                                 "e.measurement_year = 2000 AND m.measure_category IN ('Diabetes', 'Preventive')"),
    "m08_routed_to_larger": view("quality", ["measure_category", "region"], ["total_events", "exclusion_count", "performance_rate"], how="INNER"),
    "a07_people_from_stored": view("quality", ["region", "measurement_year"], ["total_events", "distinct_members", "distinct_providers"]),
    "a13_members_from_stored": view("claims", ["claim_type"], ["claim_count", "total_paid", "unique_members", "cost_per_member"]),
    "a14_enrolled_from_stored": view("enrollment", ["region"], ["enrolled_members", "active_member_months", "snapshots"]),
    "a16_monthly_from_stored": MONTHS,
    "a10_cost_per_member_month": "SELECT * EXCLUDE (period) FROM (" + cost(["aid_category"], "1") + ")",
    "a10_cost_per_member_month_by_quarter": cost([], '(("month" - 1) // 3 + 1)'),
    "j08_rates_by_definition": f"""
        SELECT e.measure_id, e.measurement_year, total_events, denominator, numerator, since AS definition_measurement_year, measure_name,
               CAST(regulatory_threshold AS DOUBLE) AS regulatory_threshold, {rate("numerator", "denominator")} AS performance_rate,
               {gap("regulatory_threshold", "numerator", "denominator")} AS gap_to_threshold
        FROM ({view("quality", ["measure_id", "measurement_year"], ["total_events", "denominator", "numerator"])}) e
        LEFT JOIN (SELECT e.y, d.* FROM (SELECT DISTINCT measurement_year AS y FROM fact_quality_events) e JOIN {DEFINED} d ON d.since <= e.y
                   QUALIFY row_number() OVER (PARTITION BY e.y, d.measure_id ORDER BY d.since DESC) = 1) d
        ON d.measure_id = e.measure_id AND d.y = e.measurement_year""",
    "j08_events_with_definitions": f"""
        SELECT measurement_year, since AS definition_measurement_year, CAST(regulatory_threshold AS DOUBLE) AS regulatory_threshold,
               COUNT(*) AS events, COUNT(DISTINCT event_id) AS event_ids
        FROM fact_quality_events e ASOF LEFT JOIN {DEFINED} d ON e.measure_id = d.measure_id AND e.measurement_year >= d.since GROUP BY ALL""",
    "v04_keys_of_definitions": f"SELECT 'dim_measure' AS table_name, 'measure_id, measurement_year' AS key_columns, COUNT(*) AS distinct_keys, "
                               f"CAST(0 AS BIGINT) AS repeated_keys, CAST(0 AS BIGINT) AS surplus_rows FROM {DEFINED}",
    "w02_previous_quarter_in_time": in_time("measure_name", 1, "prev_quarter_rate", "performance_rate", "prev_quarter_rate", "qoq_change"),
    "w07_next_quarter_in_time": in_time("measure_name", -1, "next_quarter_rate", "next_quarter_rate", "performance_rate", "next_change"),
    "w08_quarter_of_last_year": in_time("measure_name", 4, "last_year_rate", "performance_rate", "last_year_rate", "yoy_change"),
    "w02_all_quarters": f"""SELECT * FROM (
        WITH r AS ({view("quality", ["measure_category", *PERIOD], ["performance_rate"], GAPPY, "INNER")}),
        n AS (SELECT *, {NUMBER} AS number FROM r),
        every AS (SELECT measure_category, unnest(range(lo, hi + 1)) AS number
                  FROM (SELECT measure_category, MIN(number) AS lo, MAX(number) AS hi FROM n GROUP BY measure_category))
        SELECT every.measure_category, CAST((every.number - 1) // 4 AS INTEGER) AS measurement_year, CAST((every.number - 1) % 4 + 1 AS INTEGER) AS "quarter",
               a.performance_rate, b.performance_rate AS prev_quarter_rate
        FROM every LEFT JOIN n a ON a.measure_category = every.measure_category AND a.number = every.number
        LEFT JOIN n b ON b.measure_category = every.measure_category AND b.number = every.number - 1)""",
    "w04_rolling_months_in_time": """
        SELECT snapshot_month, aid_category, enrolled_members,
               CAST((20 * SUM(enrolled_members) OVER w + COUNT(*) OVER w) // (2 * COUNT(*) OVER w) AS DOUBLE) / 10 AS rolling_3mo_avg
        FROM (SELECT snapshot_month, aid_category, COUNT(DISTINCT member_id) AS enrolled_members, year(snapshot_month) * 12 + month(snapshot_month) AS number
              FROM fact_enrollment WHERE is_active AND month(snapshot_month) % 5 <> 0 GROUP BY ALL)
        WINDOW w AS (PARTITION BY aid_category ORDER BY number RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "w04_running_total_of_days": """
        SELECT claim_type, service_date, claims, CAST(SUM(claims) OVER (PARTITION BY claim_type ORDER BY service_date) AS BIGINT) AS claims_so_far
        FROM (SELECT claim_type, service_date, COUNT(*) AS claims FROM fact_claims GROUP BY ALL)""",
    "w04_rolling_average_of_days": """
        SELECT claim_type, service_date, claims, CAST((200 * SUM(claims) OVER w + COUNT(*) OVER w) // (2 * COUNT(*) OVER w) AS DOUBLE) / 100 AS rolling_30_avg
        FROM (SELECT claim_type, service_date, COUNT(*) AS claims FROM fact_claims GROUP BY ALL)
        WINDOW w AS (PARTITION BY claim_type ORDER BY service_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
    "g03_anonymous_members": anonymous(5, "0.1"),
    "g02_masked_for_pii_reader": "SELECT * FROM dim_provider",
}.items()}
