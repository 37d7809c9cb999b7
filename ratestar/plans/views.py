"""The metric views: quality performance, enrollment and claims."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratestar.functions import snippets as s
from ratestar.operators.metric_view import Attribute, Count, Derived, Dimension, Distinct, MetricView, Sum

EVENTS, ENROLLED, PAID = "fact_quality_events", "fact_enrollment", "fact_claims"

QUALITY = MetricView(
    name="quality_performance",
    comment="Rates of quality measures by measure, period, place, provider and member group.",
    source=EVENTS,
    joins=("dim_measure", "dim_county", "dim_provider", "dim_member"),
    dimensions=(
        Dimension("measure_id", EVENTS, "measure_id", "Short code of the measure"),
        Dimension("measure_name", "dim_measure", "measure_name", "Name of the measure"),
        Dimension("measure_category", "dim_measure", "measure_category", "Clinical area"),
        Dimension("reporting_standard", "dim_measure", "reporting_standard", "Programme asking for the measure"),
        Dimension("reporting_direction", "dim_measure", "reporting_direction", "Which way is better"),
        Dimension("regulatory_threshold", "dim_measure", "regulatory_threshold", "Rate asked for by contract"),
        Dimension("high_priority_flag", "dim_measure", "high_priority_flag", "Watched closely"),
        Dimension("star_rating_flag", "dim_measure", "star_rating_flag", "Part of the plan rating"),
        Dimension("measurement_year", EVENTS, "measurement_year", "Year measured"),
        Dimension("quarter", EVENTS, "quarter", "Quarter, 1 to 4"),
        Dimension("county_fips", EVENTS, "county_fips", "County code at the time of the event"),
        Dimension("county_name", "dim_county", "county_name", "County name"),
        Dimension("state_code", "dim_county", "state_code", "State"),
        Dimension("region", "dim_county", "region", "Reporting region"),
        Dimension("urban_rural_class", "dim_county", "urban_rural_class", "Settlement class"),
        Dimension("provider_npi", EVENTS, "provider_npi", "Rendering provider"),
        Dimension("provider_name", "dim_provider", "provider_name", "Provider name"),
        Dimension("provider_type", "dim_provider", "provider_type", "Kind of practice"),
        Dimension("data_source", EVENTS, "data_source", "Where the event was recorded"),
        Dimension("aid_category", "dim_member", "aid_category", "Eligibility category"),
        Dimension("gender", "dim_member", "gender", "Gender code"),
        Dimension("race_ethnicity", "dim_member", "race_ethnicity", "Self-reported group"),
        Dimension("quarter_label", EVENTS, "quarter_label", "Year and quarter, like 2025-Q1", ("measurement_year", "quarter"),
                  lambda *_: s.measurement_quarter()),
        Dimension("member_age", "dim_member", "member_age", "Age today in whole years", ("date_of_birth",),
                  lambda *_: s.member_age()),
    ),
    measures=(
        Count("denominator", ("in_denominator", "exclusion_applied"), s.counts_as_eligible,
              "Eligible events that are not excluded"),
        Count("numerator", ("in_numerator", "exclusion_applied"), s.counts_as_met,
              "Events that met the criteria and are not excluded; eligibility is not tested"),
        Count("total_events", comment="All events"),
        Count("exclusion_count", ("exclusion_applied",), lambda: F.col("exclusion_applied"), "Excluded events"),
        Derived("performance_rate", ("numerator", "denominator"),
                lambda m: s.rate(m["numerator"], m["denominator"]),
                comment="Numerator over denominator in percent; empty without a denominator"),
        Derived("gap_to_threshold", ("threshold", "numerator", "denominator"),
                lambda m: s.gap(m["threshold"], m["numerator"], m["denominator"]),
                constant_within=("measure_id", "measure_name", "regulatory_threshold"),
                comment="Threshold minus unrounded rate; positive is below the threshold"),
        Distinct("distinct_members", "member_id", "Members with events"),
        Distinct("distinct_providers", "provider_npi", "Providers with events"),
    ),
    helpers=(Attribute("threshold", "dim_measure", "regulatory_threshold"),),
)

ENROLLMENT = MetricView(
    name="enrollment",
    comment="Monthly enrollment by place, category, plan and member group.",
    source=ENROLLED,
    joins=("dim_county", "dim_member"),
    dimensions=(
        Dimension("snapshot_month", ENROLLED, "snapshot_month", "First day of the month"),
        Dimension("aid_category", ENROLLED, "aid_category", "Eligibility category that month"),
        Dimension("county_fips", ENROLLED, "county_fips", "County code that month"),
        Dimension("plan_id", ENROLLED, "plan_id", "Health plan"),
        Dimension("is_active", ENROLLED, "is_active", "Enrollment was active"),
        Dimension("county_name", "dim_county", "county_name", "County name"),
        Dimension("state_code", "dim_county", "state_code", "State"),
        Dimension("region", "dim_county", "region", "Reporting region"),
        Dimension("urban_rural_class", "dim_county", "urban_rural_class", "Settlement class"),
        Dimension("gender", "dim_member", "gender", "Gender code"),
        Dimension("race_ethnicity", "dim_member", "race_ethnicity", "Self-reported group"),
    ),
    measures=(
        Distinct("enrolled_members", "member_id", "Members with a snapshot, active or not"),
        Count("active_member_months", ("is_active",), s.active_members, "Active snapshots"),
        Count("snapshots", comment="All snapshots"),
    ),
)

CLAIMS = MetricView(
    name="claims",
    comment="Claims and their cost by setting, period, provider and member group.",
    source=PAID,
    joins=("dim_member", "dim_provider"),
    dimensions=(
        Dimension("claim_type", PAID, "claim_type", "Setting of the claim"),
        Dimension("measurement_year", PAID, "measurement_year", "Year of service"),
        Dimension("revenue_code", PAID, "revenue_code", "Institutional revenue code"),
        Dimension("provider_npi", PAID, "provider_npi", "Rendering provider"),
        Dimension("aid_category", "dim_member", "aid_category", "Eligibility category"),
        Dimension("gender", "dim_member", "gender", "Gender code"),
        Dimension("race_ethnicity", "dim_member", "race_ethnicity", "Self-reported group"),
        Dimension("provider_name", "dim_provider", "provider_name", "Provider name"),
        Dimension("provider_type", "dim_provider", "provider_type", "Kind of practice"),
    ),
    measures=(
        Count("claim_count", comment="Claims"),
        Derived("total_paid", ("paid",), lambda m: F.round(m["paid"], 2), comment="Amount paid"),
        # Six digits first, as AVG of a two-digit decimal gives.
        Derived("avg_paid", ("paid", "paid_claims"),
                lambda m: F.round((m["paid"] / F.nullif(m["paid_claims"], F.lit(0))).cast("decimal(16,6)"), 2),
                comment="Amount per claim that has one"),
        Distinct("unique_members", "member_id", "Members with claims"),
        Derived("cost_per_member", ("paid", "unique_members"),
                lambda m: F.round(m["paid"] / F.nullif(m["unique_members"], F.lit(0)), 2),
                comment="Amount per distinct member; months do not enter"),
    ),
    helpers=(
        Sum("paid", "paid_amount"),
        Count("paid_claims", ("paid_amount",), lambda: F.col("paid_amount").isNotNull()),
    ),
)
