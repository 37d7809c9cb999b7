"""Definitions that change from year to year: the one in force when a fact happened.

A table of definitions holds a row per key and year from which it is valid. A fact
takes the latest one that is not after its own year, so several definitions of a key
multiply no row, and a new definition leaves earlier facts as they were.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ratestar.functions import snippets as s
from ratestar.plans.views import EVENTS, QUALITY
from ratestar.schema import TABLES, Table
from ratestar.sources.star import Star

#: The measure table with a definition per year: its key is the measure and the year together.
VERSIONED_MEASURES = Table("dim_measure", TABLES["dim_measure"].comment, TABLES["dim_measure"].columns,
                           (("measure_id", "measurement_year"),), reference=True)


def in_force(definitions: DataFrame, keys: Sequence[str], since: str) -> DataFrame:
    """Definitions with ``_until``, the year before the next one of the same keys; NULL for the last.

    Of repeated definitions of one year, none is left out: see ``checks.repeated_keys``.
    The window holds the definitions of a key, as many as there are years.
    """
    years = Window.partitionBy(*keys).orderBy(since).rangeBetween(1, Window.unboundedFollowing)
    return definitions.withColumn("_until", F.min(since).over(years) - 1)


def with_definitions(facts: DataFrame, definitions: DataFrame, keys: Sequence[str], year: str, since: str,
                     columns: Sequence[str], how: str = "left") -> DataFrame:
    """Facts with ``columns`` of the definition in force in their ``year``.

    The join is by key, with the years as a condition; facts of many rows a key and year should be
    aggregated first. Facts before the first definition, or without year, have none.
    """
    valid = in_force(definitions.select(*dict.fromkeys([*keys, since, *columns])), keys, since).alias("d")
    condition = (F.col(f"f.{year}") >= F.col(f"d.{since}")) & (F.col("d._until").isNull() | (F.col(f"f.{year}") <= F.col("d._until")))
    for key in keys:
        condition = condition & (F.col(f"f.{key}") == F.col(f"d.{key}"))
    taken = [F.col(f"d.{c}").alias(c if c not in facts.columns else f"definition_{c}") for c in columns]
    return facts.alias("f").join(valid, condition, how).select("f.*", *taken)


def rates_by_definition(star: Star, where: dict | None = None) -> DataFrame:
    """Counts, rate and gap of each measure and year, held to the threshold of that year's definition.

    Events are counted per measure and year before the join.
    """
    counts = QUALITY.query(star, ["measure_id", "measurement_year"], ["total_events", "denominator", "numerator"], where)
    held = with_definitions(counts, star.table("dim_measure"), ["measure_id"], "measurement_year", "measurement_year",
                            ["measurement_year", "measure_name", "regulatory_threshold"])
    return held.withColumn("performance_rate", s.rate(F.col("numerator"), F.col("denominator"))).withColumn(
        "gap_to_threshold", s.gap(F.col("regulatory_threshold"), F.col("numerator"), F.col("denominator")))


def events_with_definitions(star: Star, columns: Sequence[str], definition: Sequence[str]) -> DataFrame:
    """Events one by one with the named columns of their definition in force.

    A measure that holds a third of the events is left to adaptive execution, or to a broadcast of the
    definitions, which Spark chooses by their size.
    """
    events = star.table(EVENTS, dict.fromkeys(["measure_id", "measurement_year", *columns]))
    return with_definitions(events, star.table("dim_measure"), ["measure_id"], "measurement_year", "measurement_year", definition)
