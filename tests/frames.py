"""Hand-made star tables: rows as dicts, missing columns empty."""

from pyspark.sql import types as T

from ratestar.schema import TABLES
from ratestar.sources.star import FrameStar


def frame(spark, table, rows):
    fields = TABLES[table].columns
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
    return spark.createDataFrame([tuple(r.get(f.name) for f in fields) for r in rows], schema)


def star_of(spark, **tables):
    return FrameStar({name: frame(spark, name, rows) for name, rows in tables.items()})


def event(measure="M1", met=True, eligible=True, excluded=False, **more):
    return {"event_id": 1, "member_id": "A", "measure_id": measure, "measurement_year": 2000, "quarter": 1,
            "in_numerator": met, "in_denominator": eligible, "exclusion_applied": excluded,
            "provider_npi": "P1", "county_fips": "C1", **more}


def measure(code="M1", name="One", threshold=60, direction="Higher is Better", **more):
    from decimal import Decimal

    return {"measure_id": code, "measure_name": name, "measure_category": "Diabetes", "measurement_year": 2000,
            "reporting_direction": direction, "regulatory_threshold": Decimal(threshold), "high_priority_flag": True,
            "star_rating_flag": False, **more}


def provider(npi="P1", name="Ann", kind="PCP", **more):
    return {"provider_npi": npi, "provider_name": name, "provider_type": kind, **more}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
