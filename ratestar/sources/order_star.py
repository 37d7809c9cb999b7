"""The star derived from order-management tables (orders, line items, parts, …).

Each fact asks only for the joins that the wanted columns need: an event's
measure comes from the part, its member from the order, its county from the
customer. The joins are left outer and many-to-one, so leaving one out never
changes the number of events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratestar.schema import BEHAVIORAL, DIABETES, HIGHER, LOWER, TABLES
from ratestar.sources.star import Star, Where

# Declared so that a read needs no job of its own to find the schema.
RAW_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


def _padded(number: str, width: int) -> str:
    """Zero-padded digits; longer numbers stay whole, so keys stay distinct."""
    digits = f"CAST({number} AS STRING)"
    return f"lpad({digits}, greatest({width}, length({digits})), '0')"


def _fips(key: str) -> str:
    return _padded(f"{key} + 1000", 5)


def _member(key: str) -> str:
    return f"concat('MBR', {_padded(key, 7)})"


def _npi(key: str) -> str:
    return f"CAST({key} + 1000000000 AS STRING)"


def _choose(index: str, *values: str) -> str:
    return f"array({', '.join(repr(v) for v in values)})[CAST({index} AS INT)]"


# Star columns as SQL over the joined raw tables. Their wording of types, standards
# and categories is fixed values.
PROJECTIONS = {
    "dim_county": {
        "county_fips": _fips("n_nationkey"),
        "county_name": "n_name",
        "region": "r_name",
        "urban_rural_class": _choose("n_nationkey % 4", "Metropolitan", "Micropolitan", "Rural", "Frontier"),
        "state_code": "concat('S', n_nationkey % 10)",
    },
    "dim_provider": {
        "provider_npi": _npi("s_suppkey"),
        # Fixed share, growing number: one in twenty has the name, and the type, of another.
        "provider_name": "concat('Provider ', s_suppkey - CASE WHEN s_suppkey % 20 = 16 THEN 4 ELSE 0 END)",
        "provider_type": _choose("s_suppkey % 4", "PCP", "Specialist", "FQHC", "Hospital"),
        "specialty_code": "concat('T', s_suppkey % 8)",
        "county_fips": _fips("s_nationkey"),
        "accepting_medicaid": "s_suppkey % 20 < 17",
    },
    "dim_member": {
        "member_id": _member("c_custkey"),
        "date_of_birth": "date_add(DATE '1945-01-01', CAST(c_custkey * 37 % 28000 AS INT))",
        "gender": "CASE WHEN c_custkey % 50 = 0 THEN 'Other' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END",
        "race_ethnicity": "concat('R', c_custkey % 7)",
        "county_fips": _fips("c_nationkey"),
        "zip_code": "CAST(c_custkey % 90000 + 10000 AS STRING)",
        "aid_category": "c_mktsegment",
        "smi_flag": "c_custkey % 25 < 2",
        "chronic_condition_flags": """CASE c_custkey % 5 WHEN 0 THEN array() WHEN 1 THEN array('Diabetes')
            WHEN 2 THEN array('Diabetes', 'Hypertension') WHEN 3 THEN array('Asthma', 'Depression', 'Obesity') END""",
        "enrollment_start_dt": "date_add(DATE '1994-01-01', CAST(c_custkey % 365 AS INT))",
        "enrollment_end_dt":
            "CASE WHEN c_custkey % 10 >= 7 THEN date_add(DATE '2000-01-01', CAST(c_custkey % 600 AS INT)) END",
    },
    "dim_measure": {
        "measure_id": "p_brand",
        "measure_name": "concat('Measure ', n)",
        "measure_category": _choose("n % 5", DIABETES, "Preventive", BEHAVIORAL, "Respiratory", "Utilization"),
        "reporting_standard": _choose("n % 3", "HEDIS", "CMS Adult Core Set", "CMS Child Core Set"),
        "numerator_definition": "NULL",
        "denominator_definition": "NULL",
        "exclusion_definition": "NULL",
        "age_range": "NULL",
        "measurement_year": "2000",
        "reporting_direction": f"CASE WHEN n % 9 = 0 THEN '{LOWER}' ELSE '{HIGHER}' END",
        "regulatory_threshold": "n % 4 * 3 + 60",
        "high_priority_flag": "n % 3 <> 0",
        "star_rating_flag": "n % 2 = 0",
        "data_source": _choose("n % 3", "Admin", "Hybrid", "ECDS"),
    },
    "fact_quality_events": {
        "event_id": "l_orderkey * 10 + l_linenumber",
        "member_id": _member("o_custkey"),
        "measure_id": "p_brand",
        "measurement_year": "year(l_shipdate)",
        "quarter": "quarter(l_shipdate)",
        "in_denominator": "l_linenumber < 7",
        "in_numerator": "l_linenumber < 7 AND l_quantity <= 32",
        "exclusion_applied": "CASE WHEN l_quantity <> 50 THEN l_linenumber < 7 AND l_discount >= 0.095D END",
        "service_date": "l_shipdate",
        "provider_npi": _npi("l_suppkey"),
        "data_source": "CASE WHEN l_linestatus = 'F' THEN 'Admin' ELSE 'EHR' END",
        "county_fips": _fips("c_nationkey"),
    },
    "fact_enrollment": {
        "snapshot_month": "trunc(CAST(o_orderdate AS DATE), 'month')",
        "member_id": _member("o_custkey"),
        "aid_category": "c_mktsegment",
        "county_fips": _fips("c_nationkey"),
        "plan_id": "o_orderpriority",
        "is_active": "o_orderkey % 10 <> 0",
    },
    "fact_claims": {
        "claim_id": f"concat('CLM', {_padded('o_orderkey', 8)})",
        "member_id": _member("o_custkey"),
        "provider_npi": _npi("o_orderkey % nullif(suppliers, 0)"),
        "service_date": "o_orderdate",
        "claim_type": "CASE o_orderstatus WHEN 'F' THEN 'IP' WHEN 'O' THEN 'OP' WHEN 'P' THEN 'Prof' END",
        "dx_codes": """CASE o_orderkey % 4 WHEN 0 THEN array('E11.9') WHEN 1 THEN array('I10', 'E11.9')
            WHEN 2 THEN array('J45.20', 'I10', 'Z23') ELSE array() END""",
        "proc_codes": "CASE o_orderkey % 3 WHEN 0 THEN array('99213') WHEN 1 THEN array('99214', '83036') END",
        "revenue_code": _padded("o_orderkey % 10 * 10 + 100", 4),
        "paid_amount": "o_totalprice",
        "measurement_year": "year(o_orderdate)",
    },
}


class OrderStar(Star):
    """Star tables projected from the Parquet files ``<folder>/<table>.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def _read(self, name: str, needed: set[str], where: Where) -> DataFrame:
        rows = {
            "dim_county": self._counties, "dim_provider": lambda *_: self.raw("supplier"),
            "dim_member": lambda *_: self.raw("customer"), "dim_measure": self._measures,
            "fact_quality_events": self._line_items, "fact_claims": self._claimed_orders,
            "fact_enrollment": lambda needed, _: self._owned_orders(bool(needed & {"aid_category", "county_fips"})),
        }[name](needed, where)
        return rows.selectExpr(*[
            f"CAST({PROJECTIONS[name][f.name]} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in TABLES[name].columns if f.name in needed])

    def _counties(self, needed: set[str], where: Where) -> DataFrame:
        nations = self.raw("nation")
        if "region" not in needed:
            return nations
        return nations.join(self.raw("region"), F.expr("n_regionkey = r_regionkey"), "left")

    def _measures(self, needed: set[str], where: Where) -> DataFrame:
        brands = self.raw("part").select("p_brand").distinct()
        return brands.selectExpr("p_brand", r"CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INT) AS n")

    def _owned_orders(self, with_customer: bool) -> DataFrame:
        """Orders, with their customer if wanted.

        Events join this as a whole: the customer is looked up once per order,
        and line items are shuffled by order only, not by customer again.
        """
        orders = self.raw("orders")
        if not with_customer:
            return orders
        return orders.join(self.raw("customer"), F.expr("o_custkey = c_custkey"), "left")

    def _line_items(self, needed: set[str], where: Where) -> DataFrame:
        rows = _within_year(self.raw("lineitem"), "l_shipdate", where)
        if needed & {"member_id", "county_fips"}:
            rows = rows.join(self._owned_orders("county_fips" in needed), F.expr("l_orderkey = o_orderkey"), "left")
        if "measure_id" in needed:
            rows = rows.join(self.raw("part"), F.expr("l_partkey = p_partkey"), "left")
        return rows

    def _claimed_orders(self, needed: set[str], where: Where) -> DataFrame:
        rows = _within_year(self.raw("orders"), "o_orderdate", where)
        if "provider_npi" in needed:  # spread over all suppliers, whose keys run from 0
            rows = rows.withColumn("suppliers", self.raw("supplier").agg(F.count("*").alias("suppliers")).scalar())
        return rows


def _within_year(rows: DataFrame, column: str, where: Where) -> DataFrame:
    """A filter on years as a plain range too, which Parquet statistics can prune."""
    wanted = where.get("measurement_year")
    years = [wanted] if isinstance(wanted, int) else list(wanted) if isinstance(wanted, (list, tuple, set, range)) else []
    if not years:
        return rows
    first, end = min(years), max(years) + 1
    return rows.filter(f"{column} >= TIMESTAMP_NTZ '{first:04d}-01-01' AND {column} < TIMESTAMP_NTZ '{end:04d}-01-01'")
