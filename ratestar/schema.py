"""The seven tables of the star: columns, keys, edges and sensitivity tags."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, BOOL, INT, LONG, DATE = (
    T.StringType(), T.BooleanType(), T.IntegerType(), T.LongType(), T.DateType())
STRINGS = T.ArrayType(STRING)


def _column(name: str, dtype: T.DataType, comment: str, required: bool = False) -> T.StructField:
    return T.StructField(name, dtype, not required, {"comment": comment})


@dataclass(frozen=True)
class Table:
    """One star table. ``keys`` are the column sets that must be unique.

    ``reference`` tables list what exists in the world (counties, measures)
    and do not grow with the facts.
    """

    name: str
    comment: str
    columns: T.StructType
    keys: tuple[tuple[str, ...], ...]
    partition_by: tuple[str, ...] = ()
    reference: bool = False

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.columns if not f.nullable]


TABLES: dict[str, Table] = {t.name: t for t in (
    Table("dim_county", "Counties used to report by place.", T.StructType([
        _column("county_fips", STRING, "Five-digit county code", True),
        _column("county_name", STRING, "County name; repeats across states", True),
        _column("region", STRING, "Reporting region"),
        _column("urban_rural_class", STRING, "Settlement class of the county"),
        _column("state_code", STRING, "State of the county", True),
    ]), (("county_fips",),), reference=True),
    Table("dim_provider", "Providers that render services.", T.StructType([
        _column("provider_npi", STRING, "Ten-digit provider number", True),
        _column("provider_name", STRING, "Display name; not unique", True),
        _column("provider_type", STRING, "Kind of practice", True),
        _column("specialty_code", STRING, "Taxonomy code of the specialty"),
        _column("county_fips", STRING, "County of the practice"),
        _column("accepting_medicaid", BOOL, "Takes new members"),
    ]), (("provider_npi",),)),
    Table("dim_member", "Enrolled members and their demographics.", T.StructType([
        _column("member_id", STRING, "Member number", True),
        _column("date_of_birth", DATE, "Birth date", True),
        _column("gender", STRING, "Gender code"),
        _column("race_ethnicity", STRING, "Self-reported group"),
        _column("county_fips", STRING, "County of residence"),
        _column("zip_code", STRING, "Postal code of residence"),
        _column("aid_category", STRING, "Eligibility category", True),
        _column("smi_flag", BOOL, "Serious mental illness"),
        _column("chronic_condition_flags", STRINGS, "Chronic conditions of the member"),
        _column("enrollment_start_dt", DATE, "First day enrolled", True),
        _column("enrollment_end_dt", DATE, "Last day enrolled; empty while enrolled"),
    ]), (("member_id",),)),
    Table("dim_measure", "Definitions of the quality measures.", T.StructType([
        _column("measure_id", STRING, "Short code of the measure", True),
        _column("measure_name", STRING, "Full name of the measure", True),
        _column("measure_category", STRING, "Clinical area", True),
        _column("reporting_standard", STRING, "Programme that asks for the measure", True),
        _column("numerator_definition", STRING, "What counts as met"),
        _column("denominator_definition", STRING, "Who is eligible"),
        _column("exclusion_definition", STRING, "Who is taken out"),
        _column("age_range", STRING, "Ages covered"),
        _column("measurement_year", INT, "Year of the definition", True),
        _column("reporting_direction", STRING, "Which way is better", True),
        _column("regulatory_threshold", T.DecimalType(5, 2), "Rate the contract asks for, in percent"),
        _column("high_priority_flag", BOOL, "Watched closely"),
        _column("star_rating_flag", BOOL, "Part of the plan rating"),
        _column("data_source", STRING, "How the measure is collected"),
    ]), (("measure_id",),), reference=True),
    Table("fact_quality_events", "One measured event of a member.", T.StructType([
        _column("event_id", LONG, "Event number", True),
        _column("member_id", STRING, "Member measured", True),
        _column("measure_id", STRING, "Measure applied", True),
        _column("measurement_year", INT, "Year the event counts for", True),
        _column("quarter", INT, "Quarter of the event, 1 to 4", True),
        _column("in_denominator", BOOL, "Member was eligible", True),
        _column("in_numerator", BOOL, "Criteria were met", True),
        _column("exclusion_applied", BOOL, "Taken out; unknown when empty"),
        _column("service_date", DATE, "Day of the service"),
        _column("provider_npi", STRING, "Rendering provider"),
        _column("data_source", STRING, "Where the event was recorded"),
        _column("county_fips", STRING, "County of the member at the time"),
    ]), (("event_id",), ("member_id", "measure_id", "measurement_year")), ("measurement_year",)),
    Table("fact_enrollment", "One member in one month.", T.StructType([
        _column("snapshot_month", DATE, "First day of the month", True),
        _column("member_id", STRING, "Member enrolled", True),
        _column("aid_category", STRING, "Eligibility category that month", True),
        _column("county_fips", STRING, "County that month"),
        _column("plan_id", STRING, "Health plan"),
        _column("is_active", BOOL, "Enrollment was active", True),
    ]), (("member_id", "snapshot_month"),), ("snapshot_month",)),
    Table("fact_claims", "One claim.", T.StructType([
        _column("claim_id", STRING, "Claim number", True),
        _column("member_id", STRING, "Member treated", True),
        _column("provider_npi", STRING, "Rendering provider"),
        _column("service_date", DATE, "Day of the service", True),
        _column("claim_type", STRING, "Setting of the claim", True),
        _column("dx_codes", STRINGS, "Diagnosis codes"),
        _column("proc_codes", STRINGS, "Procedure codes"),
        _column("revenue_code", STRING, "Institutional revenue code"),
        _column("paid_amount", T.DecimalType(12, 2), "Amount paid"),
        _column("measurement_year", INT, "Year of the service date", True),
    ]), (("claim_id",),), ("measurement_year",)),
)}


@dataclass(frozen=True)
class Edge:
    """A many-to-one join: ``left.key = right.key``."""

    id: str
    left: str
    right: str
    key: str


EDGES: dict[str, Edge] = {e.id: e for e in (
    Edge("J1", "dim_member", "dim_county", "county_fips"),
    Edge("J2", "dim_provider", "dim_county", "county_fips"),
    Edge("J3", "fact_claims", "dim_member", "member_id"),
    Edge("J4", "fact_claims", "dim_provider", "provider_npi"),
    Edge("J5", "fact_enrollment", "dim_county", "county_fips"),
    Edge("J6", "fact_enrollment", "dim_member", "member_id"),
    Edge("J7", "fact_quality_events", "dim_county", "county_fips"),
    Edge("J8", "fact_quality_events", "dim_measure", "measure_id"),
    Edge("J9", "fact_quality_events", "dim_member", "member_id"),
    Edge("J10", "fact_quality_events", "dim_provider", "provider_npi"),
)}


def edge_between(left: str, right: str) -> Edge:
    for edge in EDGES.values():
        if (edge.left, edge.right) == (left, right):
            return edge
    raise ValueError(f"no edge from {left} to {right}")


# The wording that data and filters share.
HIGHER, LOWER = "Higher is Better", "Lower is Better"
DIABETES, BEHAVIORAL = "Diabetes", "Behavioral Health"

# Sensitivity tags of tables and columns, as two layers applied
# one after the other (table, column or None, tag, value).
DECLARED_TAGS: list[tuple[str, str | None, str, str]] = [
    ("dim_county", None, "domain", "reference"),
    ("dim_county", None, "data_classification", "public"),
    ("dim_county", None, "contains_phi", "false"),
    ("dim_county", None, "contains_pii", "false"),
    ("dim_provider", None, "domain", "provider"),
    ("dim_provider", None, "data_classification", "confidential"),
    ("dim_provider", None, "contains_phi", "false"),
    ("dim_provider", None, "contains_pii", "true"),
    ("dim_member", None, "domain", "member"),
    ("dim_member", None, "data_classification", "restricted"),
    ("dim_member", None, "contains_phi", "true"),
    ("dim_member", None, "contains_pii", "true"),
    ("dim_member", None, "hipaa", "true"),
    ("dim_member", "member_id", "pii", "true"),
    ("dim_member", "member_id", "phi", "true"),
    ("dim_member", "date_of_birth", "pii", "true"),
    ("dim_member", "date_of_birth", "phi", "true"),
    ("dim_member", "gender", "pii", "true"),
    ("dim_member", "race_ethnicity", "pii", "true"),
    ("dim_member", "zip_code", "pii", "true"),
    ("dim_member", "zip_code", "phi", "true"),
    ("dim_member", "chronic_condition_flags", "phi", "true"),
    ("dim_measure", None, "domain", "quality_measures"),
    ("dim_measure", None, "data_classification", "internal"),
    ("dim_measure", None, "contains_phi", "false"),
    ("dim_measure", None, "contains_pii", "false"),
    ("fact_quality_events", None, "domain", "quality_measures"),
    ("fact_quality_events", None, "data_classification", "restricted"),
    ("fact_quality_events", None, "contains_phi", "true"),
    ("fact_quality_events", None, "contains_pii", "true"),
    ("fact_quality_events", None, "hipaa", "true"),
    ("fact_quality_events", "member_id", "pii", "true"),
    ("fact_quality_events", "member_id", "phi", "true"),
    ("fact_quality_events", "service_date", "phi", "true"),
    ("fact_enrollment", None, "domain", "enrollment"),
    ("fact_enrollment", None, "data_classification", "restricted"),
    ("fact_enrollment", None, "contains_phi", "true"),
    ("fact_enrollment", None, "contains_pii", "true"),
    ("fact_enrollment", None, "hipaa", "true"),
    ("fact_enrollment", "member_id", "pii", "true"),
    ("fact_enrollment", "member_id", "phi", "true"),
    ("fact_claims", None, "domain", "claims"),
    ("fact_claims", None, "data_classification", "restricted"),
    ("fact_claims", None, "contains_phi", "true"),
    ("fact_claims", None, "contains_pii", "true"),
    ("fact_claims", None, "hipaa", "true"),
    ("fact_claims", "member_id", "pii", "true"),
    ("fact_claims", "member_id", "phi", "true"),
    ("fact_claims", "dx_codes", "phi", "true"),
    ("fact_claims", "service_date", "phi", "true"),
    ("fact_claims", "paid_amount", "pii", "true"),
]
APPLIED_TAGS: list[tuple[str, str | None, str, str]] = [
    ("dim_county", None, "domain", "quality"),
    ("dim_county", None, "phi", "false"),
    ("dim_provider", None, "domain", "operations"),
    ("dim_provider", None, "data_classification", "pii"),
    ("dim_provider", None, "phi", "false"),
    ("dim_provider", "provider_npi", "pii", "ssn"),
    ("dim_provider", "provider_name", "pii", "ssn"),
    ("dim_member", None, "domain", "quality"),
    ("dim_member", None, "data_classification", "pii"),
    ("dim_member", None, "phi", "true"),
    ("dim_member", "member_id", "phi", "member_id"),
    ("dim_member", "date_of_birth", "phi", "date_of_birth"),
    ("dim_member", "date_of_birth", "pii", "ssn"),
    ("dim_member", "gender", "phi", "demographics"),
    ("dim_member", "race_ethnicity", "phi", "demographics"),
    ("dim_member", "zip_code", "pii", "address"),
    ("dim_member", "zip_code", "phi", "zip_code"),
    ("dim_member", "chronic_condition_flags", "phi", "diagnosis"),
    ("dim_measure", None, "domain", "quality"),
    ("dim_measure", None, "phi", "false"),
    ("fact_quality_events", None, "domain", "quality"),
    ("fact_quality_events", None, "data_classification", "pii"),
    ("fact_quality_events", None, "phi", "true"),
    ("fact_quality_events", "member_id", "phi", "member_id"),
    ("fact_quality_events", "service_date", "phi", "service_date"),
    ("fact_enrollment", None, "domain", "quality"),
    ("fact_enrollment", None, "data_classification", "pii"),
    ("fact_enrollment", None, "phi", "true"),
    ("fact_enrollment", "member_id", "phi", "member_id"),
    ("fact_claims", None, "domain", "quality"),
    ("fact_claims", None, "data_classification", "pii"),
    ("fact_claims", None, "phi", "true"),
    ("fact_claims", "member_id", "phi", "member_id"),
    ("fact_claims", "dx_codes", "phi", "diagnosis"),
    ("fact_claims", "service_date", "phi", "service_date"),
    ("fact_claims", "paid_amount", "phi", "financial"),
]
