"""Stored aggregates of a metric view, kept up to date by changes and asked in place of the fact.

A rollup holds, for some dimensions of the fact (its grain), what measures add up from, and for distinct counts
exact bitmaps of dense numbers, which merge by OR where counts would not add up:

* ``sums``: a row for each combination of the grain, partitioned by period;
* ``distinct-<column>``: a row for each combination and range of 32,768 numbers that has any;
* ``numbers-<column>``: the number of each value, from 0 without gaps.

Changes (as ``snapshot_diff`` lists them) become signed partial sums, and only the
partitions they touch are written anew. Bitmaps cannot forget, so those of
touched partitions are built again from the fact's rows of these partitions.

``RoutedView`` answers from the smallest rollup that covers a question: its dimensions and filters
must be of the grain, or of tables joined by keys of the grain, and its measures stored. Others go to the fact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ratestar.operators.metric_view import Condition, Count, Distinct, MetricView, Sum
from ratestar.session import cut_lineage
from ratestar.sources.star import Star, matches

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row in partition below


@dataclass(frozen=True)
class Rollup:
    """What to store: fact columns as grain, and base measures of the view by name.

    ``partition_by`` are columns of the grain, periods as a rule.
    """

    view: MetricView
    name: str
    grain: tuple[str, ...]
    measures: tuple[str, ...]
    partition_by: tuple[str, ...]

    @property
    def additive(self) -> list[Count | Sum]:
        return [m for m in self._base() if isinstance(m, (Count, Sum))]

    @property
    def distinct(self) -> list[Distinct]:
        return [m for m in self._base() if isinstance(m, Distinct)]

    def _base(self):
        return self.view._base_of([self.view._measure(n, helpers=True) for n in self.measures])

    def _inputs(self) -> list[str]:
        return list(dict.fromkeys([*self.grain, *[c for m in self.additive for c in m.inputs]]))

    # Building

    def build(self, star: Star, folder: str) -> "StoredRollup":
        """Stores the aggregates of the whole fact in a new folder."""
        stored = StoredRollup(self, star.table(self.view.source, self.grain[:1]).sparkSession, folder)
        rows = star.table(self.view.source, self._inputs())
        sums = self._sums(rows.withColumn("_sign", F.lit(1).cast("long"))).withColumn("_batch", F.lit(0).cast("long"))
        stored._write(sums, "sums")
        for measure in self.distinct:
            stored._number(star, measure.column, {})
            stored._write(self._bitmaps(star, stored, measure.column, {}), f"distinct-{measure.column}")
        return stored

    def _sums(self, signed: DataFrame) -> DataFrame:
        """Partial sums of rows that count ``_sign`` times each."""
        columns = [F.sum("_sign").alias("_rows")]
        for m in self.additive:
            if isinstance(m, Count):
                condition = F.lit(True) if m.condition is None else m.condition()
                columns.append(F.coalesce(F.sum(F.when(condition, F.col("_sign"))), F.lit(0)).alias(m.name))
            else:
                value = F.col(m.column)
                columns.append(F.coalesce(F.sum(value * F.col("_sign")), F.lit(0).cast("long")).alias(m.name))
                columns.append(F.coalesce(F.sum(F.when(value.isNotNull(), F.col("_sign"))), F.lit(0)).alias(f"{m.name}__filled"))
        return signed.groupBy(*self.grain).agg(*columns)

    def _bitmaps(self, star: Star, stored: "StoredRollup", column: str, where: Mapping[str, Any]) -> DataFrame:
        rows = star.table(self.view.source, dict.fromkeys([*self.grain, column]), where).filter(F.col(column).isNotNull())
        once = rows.groupBy(*self.grain, column).agg(F.lit(1).alias("_")).drop("_") if column not in self.grain else rows.select(*self.grain).distinct()
        numbered = once.join(stored.table(f"numbers-{column}"), column)
        return numbered.groupBy(*self.grain, F.call_function("bitmap_bucket_number", "_number").alias("_range")).agg(
            F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", "_number")).alias("_bits"))

    # Asking

    def covers(self, dimensions: Sequence[str], measures: Sequence[str], where: Mapping[str, Any] | None = None,
               conditions: Sequence[Condition] = ()) -> bool:
        """Whether the question can be answered without the fact."""
        view = self.view
        named = [view._dimension(n) for n in [*dimensions, *(where or {}), *[n for c in conditions for n in c.dimensions]]]
        base = view._base_of([view._measure(n) for n in measures])
        tables = {d.table for d in named} | {m.table for m in base if hasattr(m, "table")}
        own = [c for d in named if d.table == view.source for c in d.reads]
        stored = {m.name for m in self._base()}
        return (set(own) | {view._key(t) for t in tables if t != view.source} <= set(self.grain)
                and all(m.name in stored for m in base if isinstance(m, (Count, Sum, Distinct))))


@dataclass(frozen=True)
class StoredRollup:
    """A rollup in a folder of Parquet tables."""

    rollup: Rollup
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def sums(self) -> DataFrame:
        """The groups that have rows."""
        return self.table("sums").filter("_rows > 0")

    def _write(self, df: DataFrame, name: str) -> None:
        """Writes, or replaces the partitions that the rows belong to and no other."""
        parts = self.rollup.partition_by
        (df.hint("rebalance", *[F.col(c) for c in parts]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).parquet(f"{self.folder}/{name}"))

    def _number(self, star: Star, column: str, where: Mapping[str, Any]) -> None:
        """Gives numbers to values of the fact that have none yet, going on from the largest."""
        values = star.table(self.rollup.view.source, [column], where).filter(F.col(column).isNotNull()).distinct()
        first = 0
        try:
            known = self.table(f"numbers-{column}")
            largest = known.agg(F.max("_number").alias("n")).first()["n"]
            first = 0 if largest is None else largest + 1
            values = values.join(known.select(column), column, "left_anti")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
        rows = cut_lineage(values.withColumn("_row", F.monotonically_increasing_id()))
        block = F.shiftright("_row", _ROW_BITS)
        sizes = rows.groupBy(block.alias("_block")).agg(F.count(F.lit(1)).alias("_n"))
        # A row for each partition, whatever the number of values.
        earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
        blocks = F.broadcast(sizes.select("_block", before.alias("_before")))
        place = F.col("_before") + F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + first
        (rows.withColumn("_block", block).join(blocks, "_block").select(column, place.cast("long").alias("_number"))
         .write.mode("append").parquet(f"{self.folder}/numbers-{column}"))

    def refresh(self, changes: DataFrame, star: Star, batch: int) -> None:
        """Takes in changed rows of the fact, as ``snapshot_diff`` gives them, numbered by ``batch`` from 1 on.

        ``star`` holds the fact after the changes. A partition remembers the last batch it has taken in, so a
        refresh that was cut off, or one called again, adds to no partition twice. Groups that lose all rows stay
        as empty ones.
        """
        rollup, parts = self.rollup, list(self.rollup.partition_by)
        removed = F.col("_change_type").isin("delete", "update_preimage")
        signed = changes.withColumn("_sign", F.col("copies") * F.when(removed, -1).otherwise(1))
        delta = cut_lineage(rollup._sums(signed))
        touched = cut_lineage(delta.select(*parts).distinct())
        # The periods that changed, so that no other partitions are listed or read.
        periods = {c: [row[0] for row in touched.select(c).distinct().collect()] for c in parts}
        where = {c: (lambda column, own=own: column.isin([x for x in own if x is not None]) | (column.isNull() & F.lit(None in own))) for c, own in periods.items()}
        old = self.table("sums")
        for c, condition in where.items():
            old = old.filter(condition(F.col(c)))
        current = _null_safe_join(old, touched, parts, "left_semi")
        done = current.groupBy(*parts).agg(F.max("_batch").alias("_last")).filter(F.col("_last") >= batch)
        current, delta = _null_safe_join(current, done, parts, "left_anti"), _null_safe_join(delta, done, parts, "left_anti")
        values = [c for c in delta.columns if c not in rollup.grain]
        merged = current.drop("_batch").unionByName(delta).groupBy(*rollup.grain).agg(*[F.sum(c).alias(c) for c in values])
        kinds = {f.name: f.dataType for f in old.schema}
        merged = merged.select(*[F.col(c).cast(kinds[c]).alias(c) for c in old.columns if c != "_batch"], F.lit(batch).cast("long").alias("_batch"))
        self._write(cut_lineage(merged.select(*old.columns)), "sums")
        for measure in rollup.distinct:
            self._number(star, measure.column, where)
            rebuilt = rollup._bitmaps(star, self, measure.column, where)
            rebuilt = cut_lineage(_null_safe_join(rebuilt, touched, parts, "left_semi"))
            self._forget(f"distinct-{measure.column}", touched)
            self._write(rebuilt, f"distinct-{measure.column}")

    def _forget(self, name: str, touched: DataFrame) -> None:
        """Empties partitions that may have no rows any more: an empty bitmap in each."""
        bitmaps = self.table(name)
        gone = _null_safe_join(bitmaps, touched, list(self.rollup.partition_by), "left_semi").groupBy(*self.rollup.grain).agg(F.min("_range").alias("_range"))
        empty = gone.withColumn("_bits", F.lit(bytearray(4096)))
        self._write(cut_lineage(empty.select(*bitmaps.columns)), name)

    def query(self, star: Star, dimensions: Sequence[str], measures: Sequence[str], where: Mapping[str, Any] | None = None,
              how: str = "left", conditions: Sequence[Condition] = ()) -> DataFrame:
        """The rows of ``MetricView.query`` from the stored tables and the dimension tables."""
        rollup, view = self.rollup, self.rollup.view
        view._validate(dimensions, measures, how)
        if not rollup.covers(dimensions, measures, where, conditions):
            raise ValueError(f"{rollup.name} does not hold all that is asked for")
        chosen = [view._measure(n) for n in measures]
        base = view._base_of(chosen)
        additive = [m for m in base if isinstance(m, (Count, Sum))]
        distinct = [m for m in base if isinstance(m, Distinct)]
        attributes = [m for m in base if not isinstance(m, (Count, Sum, Distinct))]
        groups = [view._dimension(n) for n in dimensions]
        filters = [(view._dimension(n), wanted) for n, wanted in (where or {}).items()]
        named = [*groups, *[d for d, _ in filters], *[view._dimension(n) for c in conditions for n in c.dimensions]]

        def joined(rows: DataFrame) -> DataFrame:
            """Stored rows that the question is about, with all named columns."""
            rows = rows.withColumns({d.column: d.value(*[F.col(c) for c in d.inputs]) for d in named if d.table == view.source and d.value})
            for d, wanted in filters:
                if d.table == view.source:
                    rows = rows.filter(matches(F.col(d.column), wanted))
            rows = rows.alias("source")
            used = {d.table for d in named} | {a.table for a in attributes}
            for table in (t for t in view.joins if t in used):
                key = view._key(table)
                other = view._rows(star, table, [key, *[a.column for a in attributes if a.table == table]], named, {})
                rows = rows.join(other.alias(table), F.col(f"source.{key}") == F.col(f"{table}.{key}"), how)
            for d, wanted in filters:
                if d.table != view.source:
                    rows = rows.filter(matches(view._qualified(d), wanted))
            for condition in conditions:
                rows = rows.filter(condition.holds(lambda n: view._qualified(view._dimension(n))))
            return rows

        by = [view._qualified(d).alias(d.name) for d in groups]
        merged = [F.sum("source._rows").alias("_rows")]
        for m in additive:
            total = F.sum(f"source.{m.name}")
            merged.append((F.when(F.sum(f"source.{m.name}__filled") > 0, total) if isinstance(m, Sum) else F.coalesce(total, F.lit(0))).alias(m.name))
        merged += [F.max(view._qualified(a)).alias(a.name) for a in attributes]
        result = joined(self.sums()).groupBy(*by).agg(*merged)
        for m in distinct:
            ranges = joined(self.table(f"distinct-{m.column}")).groupBy(*by, F.col("source._range").alias("_range")).agg(
                F.call_function("bitmap_or_agg", F.col("source._bits")).alias("_bits"))
            counts = ranges.groupBy(*dimensions).agg(F.sum(F.call_function("bitmap_count", "_bits")).alias(m.name))
            result = _null_safe_join(result, counts, list(dimensions), "left", [m.name])
            result = result.withColumn(m.name, F.coalesce(m.name, F.lit(0)))
        return result.select(*dimensions, *view._values(chosen))


def _null_safe_join(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str, extra: Sequence[str] = ()) -> DataFrame:
    """A join by columns in which NULL matches NULL; adds ``extra`` columns of the right side."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    found = left.alias("l").join(right.alias("r"), condition, how)
    return found.select("l.*", *[F.col(f"r.{c}") for c in extra])


@dataclass(frozen=True)
class RoutedView:
    """A metric view that asks stored rollups where they cover a question, the smallest first, and else the fact."""

    view: MetricView
    stored: tuple[StoredRollup, ...]

    def route(self, dimensions: Sequence[str], measures: Sequence[str], where: Mapping[str, Any] | None = None,
              conditions: Sequence[Condition] = ()) -> StoredRollup | None:
        """The rollup with the shortest grain that covers the question."""
        fitting = [s for s in self.stored if s.rollup.view is self.view and s.rollup.covers(dimensions, measures, where, conditions)]
        return min(fitting, key=lambda s: (len(s.rollup.grain), s.rollup.name), default=None)

    def query(self, star: Star, dimensions: Sequence[str], measures: Sequence[str], where: Mapping[str, Any] | None = None,
              how: str = "left", conditions: Sequence[Condition] = ()) -> DataFrame:
        self.view._validate(dimensions, measures, how)
        found = self.route(dimensions, measures, where, conditions)
        return (found or self.view).query(star, dimensions, measures, where, how, conditions)
