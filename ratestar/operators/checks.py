"""Data-quality passes: row counts, missing values, orphan keys, repeated keys."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ratestar.schema import EDGES, TABLES
from ratestar.sources.star import Star


def _stacked(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(star: Star, tables: Iterable[str] = tuple(TABLES)) -> DataFrame:
    """``table_name, row_count``. Reads one narrow column per table."""
    return _stacked(
        star.table(t, [TABLES[t].columns.names[0]]).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for t in tables)


def null_counts(star: Star, tables: Iterable[str] = tuple(TABLES)) -> DataFrame:
    """``table_name, column_name, null_count`` of each required column, one scan per table.

    Where a catalog keeps NOT NULL marks, Spark may take them for granted and
    not look; then give a ``ParquetStar`` over the files. The session catalog's
    Parquet tables keep none, so there the rows are counted.
    """
    def one(name: str) -> DataFrame:
        required = TABLES[name].required
        counts = star.table(name, required).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        return counts.unpivot([], required, "column_name", "null_count").select(
            F.lit(name).alias("table_name"), "column_name", "null_count")

    return _stacked(one(t) for t in tables)


def orphan_keys(star: Star) -> DataFrame:
    """Per edge: rows with an empty key, and keys and rows without a match.

    The keys of a table are counted first, all of its edges in one scan, so the
    join sees each key once however many rows carry it.
    """
    by_left: dict[str, list] = {}
    for edge in EDGES.values():
        by_left.setdefault(edge.left, []).append(edge)

    def used(left: str) -> DataFrame:
        edges = by_left[left]
        columns = [e.key for e in edges]
        label = F.create_map(*[F.lit(x) for e in edges for x in (e.key, e.id)])
        return (star.table(left, columns).unpivot([], columns, "column_name", "key")
                .groupBy(label[F.col("column_name")].alias("edge"), "key").agg(F.count(F.lit(1)).alias("rows")))

    def known(right: str) -> DataFrame:
        edges = [e for e in EDGES.values() if e.right == right]
        return star.table(right, [edges[0].key]).select(
            F.col(edges[0].key).alias("known"), F.explode(F.array(*[F.lit(e.id) for e in edges])).alias("edge"))

    keys = _stacked(used(t) for t in by_left)
    targets = _stacked(known(t) for t in dict.fromkeys(e.right for e in EDGES.values())).distinct()
    joined = keys.alias("k").join(
        targets.alias("t"), (F.col("k.edge") == F.col("t.edge")) & (F.col("k.key") == F.col("t.known")), "left")
    orphan = F.col("key").isNotNull() & F.col("known").isNull()
    return joined.groupBy("k.edge").agg(
        F.sum(F.when(F.col("key").isNull(), F.col("rows")).otherwise(0)).alias("empty_rows"),
        F.count_if(orphan).alias("orphan_keys"),
        F.sum(F.when(orphan, F.col("rows")).otherwise(0)).alias("orphan_rows"))


def repeated_keys(star: Star, tables: Iterable[str] = tuple(TABLES)) -> DataFrame:
    """Per declared key: distinct values, values that repeat, rows beyond the first of each.

    Each key's own columns are counted apart, in map tasks first, so a value that most
    rows have is a few partial counts.
    """
    def one(name: str, key: tuple[str, ...]) -> DataFrame:
        counts = star.table(name, key).groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
        return counts.agg(F.count(F.lit(1)).alias("distinct_keys"), F.count_if(F.col("rows") > 1).alias("repeated_keys"),
                          F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("surplus_rows")).select(
            F.lit(name).alias("table_name"), F.lit(", ".join(key)).alias("key_columns"), "distinct_keys", "repeated_keys", "surplus_rows")

    return _stacked(one(t, key) for t in tables for key in star.tables[t].keys)


def met_but_not_eligible(star: Star) -> DataFrame:
    """Per measure: events in the numerator but not in the denominator, which can lift a rate over 100."""
    events = star.table("fact_quality_events", ["measure_id", "in_denominator", "in_numerator", "exclusion_applied"])
    odd = F.col("in_numerator") & ~F.col("in_denominator")
    return events.groupBy("measure_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(odd).alias("met_not_eligible"),
        F.count_if(F.col("exclusion_applied").isNull()).alias("unknown_exclusion"))
