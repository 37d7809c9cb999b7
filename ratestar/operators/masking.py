"""Sensitivity tags: their final state, what they cover, and masking by them."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratestar.schema import APPLIED_TAGS, DECLARED_TAGS, TABLES
from ratestar.sources.star import Star

TagRow = tuple[str, str | None, str, str]


def final_tags(*layers: Iterable[TagRow]) -> dict[tuple[str, str | None], dict[str, str]]:
    """Tags after all layers: a later value replaces an earlier one of the same key."""
    state: dict[tuple[str, str | None], dict[str, str]] = {}
    for layer in layers or (DECLARED_TAGS, APPLIED_TAGS):
        for table, column, key, value in layer:
            state.setdefault((table, column), {})[key] = value
    return state


def tags_frame(spark: SparkSession) -> DataFrame:
    """``table_name, column_name, tag, value``; ``column_name`` is NULL for table tags."""
    rows = [(t, c, key, value) for (t, c), tags in final_tags().items() for key, value in tags.items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, tag string, value string")


def tag_rollup(spark: SparkSession) -> DataFrame:
    """How many tables and columns carry each tag value."""
    return tags_frame(spark).groupBy("tag", "value").agg(
        F.countDistinct("table_name").alias("tables"), F.count("column_name").alias("columns"))


def tag_columns(df: DataFrame, table: str) -> DataFrame:
    """Put the tags of a table's columns into the schema's metadata."""
    for (owner, column), tags in final_tags().items():
        if owner == table and column in df.columns:
            df = df.withMetadata(column, {**df.schema[column].metadata, "tags": tags})
    return df


def exposure(star: Star) -> DataFrame:
    """Filled values of every tagged column: how much sensitive data each table holds."""
    def one(table: str, columns: list[str]) -> DataFrame:
        counts = star.table(table, columns).agg(
            F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in columns])
        return counts.unpivot(["_rows"], columns, "column_name", "filled").select(
            F.lit(table).alias("table_name"), "column_name", F.col("_rows").alias("row_count"), "filled")

    tagged: dict[str, list[str]] = {}
    for table, column in final_tags():
        if column is not None:
            tagged.setdefault(table, []).append(column)
    counts = reduce(DataFrame.unionByName, [one(t, c) for t, c in tagged.items()])
    state = {(t, c): tags for (t, c), tags in final_tags().items() if c is not None}

    def value_of(tag: str) -> Column:
        pairs = [F.lit(x) for (t, c), tags in state.items() if tag in tags for x in (f"{t}.{c}", tags[tag])]
        return F.create_map(*pairs)[F.concat_ws(".", "table_name", "column_name")]

    return counts.withColumn("phi", value_of("phi")).withColumn("pii", value_of("pii"))


def _rule(tags: dict[str, str], column: str, dtype: str, salt: str) -> Column:
    value = F.col(column)
    if tags.get("phi") in ("date_of_birth", "service_date"):
        return F.trunc(value, "year")
    if tags.get("phi") == "zip_code":
        return F.substring(value, 1, 3)
    if tags.get("phi") == "member_id" or tags.get("pii") == "ssn":
        return F.sha2(F.concat(F.lit(salt), value), 256)
    return F.lit(None).cast(dtype)


def masked(star: Star, table: str, salt: str, cleared: Iterable[str] = ()) -> DataFrame:
    """A table as seen by a reader cleared for some of ``phi`` and ``pii``.

    A column is masked when it carries either tag without clearance for it.
    Member and provider numbers become salted hashes, so equal values stay
    equal and masked tables still join; dates keep their year, postal codes
    three digits; demographics, diagnoses and amounts are emptied.
    """
    cleared = set(cleared)
    state = final_tags()
    columns = []
    for field in TABLES[table].columns:
        tags = state.get((table, field.name), {})
        hidden = ({"phi", "pii"} & set(tags)) - cleared
        column = _rule(tags, field.name, field.dataType.simpleString(), salt) if hidden else F.col(field.name)
        columns.append(column.alias(field.name))
    return star.table(table).select(*columns)
