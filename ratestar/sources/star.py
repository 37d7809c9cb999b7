"""Access to the seven star tables, whatever holds them.

``table(name, columns, where)`` hands the wanted columns and row filters to the
source, so that it reads no more than the query needs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratestar.schema import TABLES, Table, edge_between

Where = Mapping[str, Any]


def matches(column: Column, wanted: Any) -> Column:
    """A condition from a value, a collection of values or a function of the column."""
    if callable(wanted):
        return wanted(column)
    if wanted is None:
        return column.isNull()
    if isinstance(wanted, (list, tuple, set, frozenset, range)):
        return column.isin(list(wanted))
    return column == F.lit(wanted)


def narrow(df: DataFrame, columns: Iterable[str] | None, where: Where | None) -> DataFrame:
    for name, wanted in (where or {}).items():
        df = df.filter(matches(F.col(name), wanted))
    return df if columns is None else df.select(*columns)


class Star:
    """Base of all sources; subclasses supply ``_read``, and ``tables`` if they hold others than the star's."""

    tables: Mapping[str, Table] = TABLES

    def table(self, name: str, columns: Iterable[str] | None = None, where: Where | None = None) -> DataFrame:
        if name not in self.tables:
            raise ValueError(f"unknown table {name}")
        columns = None if columns is None else list(dict.fromkeys(columns))
        known = self.tables[name].columns.names
        unknown = [c for c in [*(columns or []), *(where or {})] if c not in known]
        if unknown:
            raise ValueError(f"{name} has no column {', '.join(unknown)}")
        needed = set(known if columns is None else columns) | set(where or {})
        return narrow(self._read(name, needed, where or {}), columns, where)

    def _read(self, name: str, needed: set[str], where: Where) -> DataFrame:
        raise NotImplementedError

    def join(self, left: str, right: str, left_columns: Iterable[str], right_columns: Iterable[str],
             how: str = "inner") -> DataFrame:
        """Rows of one registered many-to-one edge.

        No broadcast hint: the right side is broadcast when its size is under
        the session's threshold, and a shuffled join splits hot keys (AQE).
        """
        edge = edge_between(left, right)
        one = self.table(left, [edge.key, *left_columns])
        other = self.table(right, [edge.key, *right_columns])
        return one.join(other, edge.key, how)

    def create_views(self, spark: SparkSession) -> None:
        """Register all tables as temporary views, for SQL text."""
        for name in TABLES:
            self.table(name).createOrReplaceTempView(name)

    @staticmethod
    def drop_views(spark: SparkSession) -> None:
        for name in TABLES:
            spark.catalog.dropTempView(name)


class CatalogStar(Star):
    """Tables of a catalog schema, scanned by qualified name."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database

    def _read(self, name: str, needed: set[str], where: Where) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")


class ParquetStar(Star):
    """One Parquet folder per table, read with the declared schema."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name: str, needed: set[str], where: Where) -> DataFrame:
        return self.spark.read.schema(TABLES[name].columns).parquet(f"{self.folder}/{name}")


class FrameStar(Star):
    """Given DataFrames; missing tables raise on use."""

    def __init__(self, frames: Mapping[str, DataFrame], tables: Mapping[str, Table] = TABLES):
        self.frames, self.tables = dict(frames), tables

    def _read(self, name: str, needed: set[str], where: Where) -> DataFrame:
        return self.frames[name]


