"""Named dimensions and measures over one fact table and its dimension tables.

A query names dimensions, measures and filters and gets a DataFrame:

* only dimension tables that a chosen dimension, measure or filter uses are
  joined (their keys are unique, see ``check_keys``);
* while at most one joined table grows with the data, the fact is aggregated
  to its own dimensions and join keys *before* the joins. Each map task combines
  its rows first, so a join key that holds a third of all rows shuffles as a
  handful of partial sums and is one row per group when it reaches the join;
* the keys of two or more growing tables are nearly as many as the rows, so
  there the rows are joined, with hot keys spread over salted copies, and
  aggregated once. Distinct counts over reference tables alone, which reduce to
  nothing smaller than the values counted, are joined first too;
* which of these it is follows from the definition, not from sizes. No table is
  counted; Spark's threshold decides what is broadcast, but salted copies never are;
* measures are sums of partial sums, so every total is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ratestar.schema import TABLES, Table, edge_between
from ratestar.sources.star import Star, matches

#: Copies of a growing dimension table in a join of whole rows, over which a hot key is spread.
SALTS = 8


@dataclass(frozen=True)
class Dimension:
    """A grouping column of the fact or of a joined dimension table, or an expression over columns of one of them.

    For an expression give the columns it reads as ``inputs`` and a function
    ``value`` from those to the result; ``column`` is then the name under which
    the rows carry it, and must differ from the table's columns.
    """

    name: str
    table: str
    column: str
    comment: str = ""
    inputs: tuple[str, ...] = ()
    value: Callable[..., Column] | None = None

    @property
    def reads(self) -> tuple[str, ...]:
        return self.inputs if self.value else (self.column,)


@dataclass(frozen=True)
class Condition:
    """A filter over several dimensions: ``holds`` gets a function from a dimension's name to its column."""

    dimensions: tuple[str, ...]
    holds: Callable[[Callable[[str], Column]], Column]


@dataclass(frozen=True)
class Count:
    """Rows for which ``condition`` holds; all rows without one."""

    name: str
    inputs: tuple[str, ...] = ()
    condition: Callable[[], Column] | None = None
    comment: str = ""

    def partial(self, rows: Column | None = None) -> Column:
        condition = F.lit(True) if self.condition is None else self.condition()
        return F.count(F.when(condition if rows is None else rows & condition, 1))

    def merge(self, partial: Column) -> Column:
        return F.coalesce(F.sum(partial), F.lit(0))


@dataclass(frozen=True)
class Sum:
    """Sum of a fact column; NULL when there is nothing to add."""

    name: str
    column: str
    comment: str = ""

    @property
    def inputs(self) -> tuple[str, ...]:
        return (self.column,)

    def partial(self, rows: Column | None = None) -> Column:
        return F.sum(F.col(self.column) if rows is None else F.when(rows, F.col(self.column)))

    def merge(self, partial: Column) -> Column:
        return F.sum(partial)


@dataclass(frozen=True)
class Distinct:
    """Distinct values of a fact column."""

    name: str
    column: str
    comment: str = ""


@dataclass(frozen=True)
class Attribute:
    """A dimension-table value that is the same in each group (the largest, to be repeatable)."""

    name: str
    table: str
    column: str
    comment: str = ""


@dataclass(frozen=True)
class Derived:
    """An expression over other measures.

    ``constant_within``: dimensions of which one must be grouped by for the
    result to mean anything.
    """

    name: str
    needs: tuple[str, ...]
    value: Callable[[Mapping[str, Column]], Column]
    constant_within: tuple[str, ...] = ()
    comment: str = ""


Measure = Count | Sum | Distinct | Attribute | Derived


def _reduced(fact: DataFrame, grain: Sequence[str], counted: Sequence[str],
             additive: Sequence[Count | Sum]) -> DataFrame:
    """Partial sums per ``grain`` and counted value.

    A single counted column joins the grain. Of several, each row gives one row
    per column (``_counts``, ``_value``) and one for the sums, so that a group
    holds members plus providers and not each pair of them.
    """
    if len(counted) <= 1:
        keys = list(dict.fromkeys([*grain, *counted]))
        partials = [m.partial().alias(f"_{m.name}") for m in additive]
        return fact.groupBy(*keys).agg(*partials) if partials else fact.select(*keys).distinct()
    kept = list(dict.fromkeys([*grain, *[c for m in additive for c in m.inputs]]))
    values = [F.col(c).cast("string").alias(f"_{c}") for c in counted]
    spread = fact.select(*kept, F.lit(None).cast("string").alias("_"), *values).unpivot(
        kept, ["_", *[f"_{c}" for c in counted]], "_counts", "_value")
    sums = F.col("_counts") == "_"
    return spread.groupBy(*grain, "_counts", "_value").agg(
        F.count(F.lit(1)).alias("_rows"), *[m.partial(sums).alias(f"_{m.name}") for m in additive])


def _counted_apart(rows: DataFrame, by: Sequence[Column], merged: Sequence[Column], additive: Sequence[Count | Sum],
                   attributes: Sequence[Attribute], distinct: Sequence[Distinct]) -> DataFrame:
    """Groups of joined ``_counts``, ``_value`` rows: each value once, then one row per group."""
    names = [F.col("source._counts").alias("_counts"), F.col("source._value").alias("_value")]
    values = rows.groupBy(*by, *names).agg(F.count(F.lit(1)).alias("_keys"), *merged)
    return values.groupBy(*values.columns[:len(by)]).agg(
        *[m.merge(F.col(m.name)).alias(m.name) for m in additive],
        *[F.max(a.name).alias(a.name) for a in attributes],
        *[F.count(F.when(F.col("_counts") == f"_{m.column}", F.col("_value"))).alias(m.name) for m in distinct])


@dataclass(frozen=True)
class MetricView:
    """A fact table, the dimension tables it joins, and what can be asked of them.

    ``helpers`` are measures that others are derived from and that cannot be
    asked for themselves. For tables of one's own give their definitions as
    ``tables`` and, for each joined one, the column shared with the source as
    ``keys``; both default to those of the star.
    """

    name: str
    source: str
    joins: tuple[str, ...]
    dimensions: tuple[Dimension, ...]
    measures: tuple[Measure, ...]
    helpers: tuple[Measure, ...] = ()
    comment: str = ""
    tables: Mapping[str, Table] = field(default_factory=lambda: TABLES)
    keys: Mapping[str, str] = field(default_factory=dict)

    def query(self, star: Star, dimensions: Sequence[str], measures: Sequence[str],
              where: Mapping[str, Any] | None = None, how: str = "left",
              conditions: Sequence[Condition] = ()) -> DataFrame:
        """Measures by dimensions.

        ``where`` maps a dimension to a value, a collection of values, or a
        function from Column to condition; ``conditions`` may combine several
        dimensions, also of different tables. Both apply before aggregation;
        filter the result for conditions on measures. ``how="left"`` counts
        fact rows without a match; ``"inner"`` drops those without a match in
        the tables used.
        """
        where = where or {}
        groups = [self._dimension(n) for n in dimensions]
        filters = [(self._dimension(n), wanted) for n, wanted in where.items()]
        conditional = [self._dimension(n) for c in conditions for n in c.dimensions]
        chosen = [self._measure(n) for n in measures]
        self._validate(dimensions, measures, how)

        base = self._base_of(chosen)
        additive = [m for m in base if isinstance(m, (Count, Sum))]
        distinct = [m for m in base if isinstance(m, Distinct)]
        attributes = [m for m in base if isinstance(m, Attribute)]

        named = [*groups, *[d for d, _ in filters], *conditional]
        used = {d.table for d in named} | {a.table for a in attributes}
        joined = [t for t in self.joins if t in used]
        keys = {t: self._key(t) for t in joined}

        # Conditions over the fact alone apply to its rows; the others need their columns after the joins.
        early = [c for c in conditions if all(self._dimension(n).table == self.source for n in c.dimensions)]
        late = [c for c in conditions if c not in early]
        kept = [self._dimension(n) for c in late for n in c.dimensions]
        own = list(dict.fromkeys(d.column for d in [*groups, *kept] if d.table == self.source))
        counted = list(dict.fromkeys(m.column for m in distinct))
        inputs = [c for m in additive for c in m.inputs]
        fact_columns = [*keys.values(), *counted, *inputs]
        pushed = {d.column: wanted for d, wanted in filters if d.table == self.source and not d.value}
        fact = self._rows(star, self.source, fact_columns, named, pushed)
        for dimension, wanted in filters:
            if dimension.table == self.source and dimension.value:
                fact = fact.filter(matches(F.col(dimension.column), wanted))
        for condition in early:
            fact = fact.filter(condition.holds(lambda n: F.col(self._dimension(n).column)))
        fact = fact.select(*list(dict.fromkeys([*own, *fact_columns])) or fact.columns[:1])

        if not joined:
            merged = [m.partial().alias(m.name) for m in additive]
            merged += [F.countDistinct(m.column).alias(m.name) for m in distinct]
            result = fact.groupBy(*[F.col(d.column).alias(d.name) for d in groups]).agg(*merged)
            return result.select(*dimensions, *self._values(chosen))

        # Rows are joined as they are if reducing them first would not shrink them
        # (unless a joined column would hide one that a measure reads).
        growing = [t for t in joined if not self.tables[t].reference]
        borrowed = {i.column for i in [*named, *attributes] if i.table in joined}
        direct = not borrowed & set(inputs) and (len(growing) > 1 or bool(counted) and not growing)
        grain = list(dict.fromkeys([*own, *keys.values()]))
        rows = fact if direct else _reduced(fact, grain, counted, additive)
        if direct and growing:
            parts = F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(SALTS)).cast("int")
            rows = rows.withColumn("_salt", parts)
        rows = rows.alias("source")
        for table in joined:
            plain = [keys[table], *[a.column for a in attributes if a.table == table]]
            other = self._rows(star, table, plain, named, {})
            other = other.select(*dict.fromkeys([*plain, *[d.column for d in named if d.table == table]]))
            match = F.col(f"source.{keys[table]}") == F.col(f"{table}.{keys[table]}")
            if direct and table in growing:
                # Spark takes the copies for one row, so its threshold would let them be broadcast.
                other = other.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
                match = match & (F.col("source._salt") == F.col(f"{table}._part"))
            rows = rows.join(other.alias(table), match, how)
        for dimension, wanted in filters:
            if dimension.table != self.source:
                rows = rows.filter(matches(self._qualified(dimension), wanted))
        for condition in late:
            rows = rows.filter(condition.holds(lambda n: self._qualified(self._dimension(n))))

        by = [self._qualified(d).alias(d.name) for d in groups]
        merged = [(m.partial() if direct else m.merge(F.col(f"source._{m.name}"))).alias(m.name) for m in additive]
        merged += [F.max(self._qualified(a)).alias(a.name) for a in attributes]
        if len(counted) > 1 and not direct:
            result = _counted_apart(rows, by, merged, additive, attributes, distinct)
        else:
            # The reduced rows hold each value once per key; where every key is
            # grouped by or is that value itself, plain counting is exact.
            once = not direct and set(keys.values()) <= {*own, *counted}
            count = F.count if once else F.countDistinct
            merged += [count(F.col(f"source.{m.column}")).alias(m.name) for m in distinct]
            result = rows.groupBy(*by).agg(*merged)
        return result.select(*dimensions, *self._values(chosen))

    def _rows(self, star: Star, table: str, columns: Sequence[str], named: Sequence[Dimension], where: Mapping[str, Any]) -> DataFrame:
        """A table's wanted columns and those of its named dimensions, expressions worked out."""
        mine = list(dict.fromkeys(d for d in named if d.table == table))
        wanted = list(dict.fromkeys([*columns, *[c for d in mine for c in d.reads]]))
        rows = star.table(table, wanted or [self.tables[table].columns.names[0]], where)
        return rows.withColumns({d.column: d.value(*[F.col(c) for c in d.inputs]) for d in mine if d.value})

    def _key(self, table: str) -> str:
        return self.keys.get(table) or edge_between(self.source, table).key

    def check_keys(self, star: Star) -> None:
        """Raise if a joined table repeats its key, which would multiply fact rows."""
        for table in self.joins:
            key = self._key(table)
            repeated = star.table(table, [key]).groupBy(key).count().filter("count > 1")
            if not repeated.isEmpty():
                raise ValueError(f"{self.name}: {table}.{key} is not unique")

    def describe(self) -> dict[str, str]:
        """Comment of every dimension and measure."""
        return {item.name: item.comment for item in (*self.dimensions, *self.measures)}

    def _qualified(self, item: Dimension | Attribute) -> Column:
        table = "source" if item.table == self.source else item.table
        return F.col(f"{table}.{item.column}")

    def _dimension(self, name: str) -> Dimension:
        for dimension in self.dimensions:
            if dimension.name == name:
                return dimension
        raise ValueError(f"{self.name} has no dimension {name!r}")

    def _measure(self, name: str, helpers: bool = False) -> Measure:
        for measure in (*self.measures, *(self.helpers if helpers else ())):
            if measure.name == name:
                return measure
        raise ValueError(f"{self.name} has no measure {name!r}")

    def _validate(self, dimensions: Sequence[str], measures: Sequence[str], how: str) -> None:
        if isinstance(dimensions, str) or isinstance(measures, str):
            raise ValueError("give dimensions and measures as lists of names")
        if not measures:
            raise ValueError("name at least one measure; there is no SELECT *")
        asked = [*dimensions, *measures]
        if len(set(asked)) != len(asked):
            raise ValueError("a dimension or measure is named twice")
        if how not in ("left", "inner"):
            raise ValueError("how must be 'left' or 'inner'")
        for name in measures:
            measure = self._measure(name)
            if isinstance(measure, Derived) and measure.constant_within:
                if not set(measure.constant_within) & set(dimensions):
                    raise ValueError(f"{name} needs one of {', '.join(measure.constant_within)} as a dimension")

    def _base_of(self, measures: Sequence[Measure]) -> list[Measure]:
        found: dict[str, Measure] = {}
        for measure in measures:
            parts = [measure]
            if isinstance(measure, Derived):
                parts = self._base_of([self._measure(n, helpers=True) for n in measure.needs])
            found.update({p.name: p for p in parts})
        return list(found.values())

    def _values(self, measures: Sequence[Measure]) -> list[Column]:
        def value(measure: Measure) -> Column:
            if not isinstance(measure, Derived):
                return F.col(measure.name)
            return measure.value({n: value(self._measure(n, helpers=True)) for n in measure.needs})

        return [value(m).alias(m.name) for m in measures]
