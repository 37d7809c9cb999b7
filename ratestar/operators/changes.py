"""Changes between two snapshots of a table, as a change feed would list them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changed rows of both snapshots with ``_change_type`` and ``copies``.

    ``insert`` and ``delete`` for keys on one side only; ``update_preimage``
    and ``update_postimage`` for keys whose row differs. Values are compared
    null-safe, arrays included.

    Equal rows cancel in one aggregation over both snapshots, combined before
    the shuffle, so only changed rows go on. With keys that are not unique the
    rows are compared as a bag: ``copies`` tells how many of a row came or
    went, and rows of a key are never paired with each other.
    """
    columns = old.columns
    if set(columns) != set(new.columns):
        raise ValueError("the snapshots have different columns")
    both = (old.withColumn("_delta", F.lit(-1).cast("long"))
            .unionByName(new.withColumn("_delta", F.lit(1).cast("long"))))
    changed = both.groupBy(*columns).agg(F.sum("_delta").alias("_delta")).filter("_delta <> 0")
    sides = changed.groupBy(*keys).agg(
        F.bool_or(F.col("_delta") < 0).alias("_had"), F.bool_or(F.col("_delta") > 0).alias("_has"))
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"c.{key}").eqNullSafe(F.col(f"s.{key}"))
    rows = changed.alias("c").join(sides.alias("s"), condition)
    kind = (F.when(F.col("_had") & F.col("_has"),
                   F.when(F.col("_delta") < 0, "update_preimage").otherwise("update_postimage"))
            .when(F.col("_has"), "insert").otherwise("delete"))
    return rows.select(*[F.col(f"c.{c}") for c in columns], kind.alias("_change_type"),
                       F.abs("_delta").alias("copies"))
