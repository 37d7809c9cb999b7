"""Ranks, n-tiles and percentiles of aggregated rows, without one task per group.

A window with ``PARTITION BY measure`` (or none) puts all providers of a
measure into one task. Here rows are sorted over the whole cluster, and a row's
place in its group follows from its place in the sort: the rows before its
block, plus its place in the block, less the place where its group starts. The
per-block counts are one row per sort partition, whatever the data.

Ranks sort only the distinct values of each group, with the number of rows that
have them, so a value that most rows share is one row of the sort. The ranks are
joined back under salted keys, which spread such a value over many tasks.

Sorted rows are written to the checkpoint folder when a function is called, not
when its result is used, as the bounds of a sort are sampled anew each time it
runs; the files go when nothing reads them any more. Ranks read their input
twice, so it is written there too, and worked out once.

The first n rows of a group need no sort of all: those of each salted part come
first, then those of the parts.

NULL placement follows Spark: first when ascending, last when descending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratestar.session import cut_lineage

ROWS_BITS = 33  # monotonically_increasing_id: partition above, row in partition below
SALTS = 16  # parts of a hot key
TOP_ROWS = 1 << 20  # rows that one task may get for the first n of a group
LIMITED = 1000  # the largest n up to which Spark lets map tasks send n rows of a group alone, by default


def _sorted_by(by: Sequence[str], key: str, descending: bool, ties: Sequence[str]) -> list[Column]:
    first = F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_first()
    return [*[F.col(c).asc_nulls_first() for c in by], first, *[F.col(c).asc_nulls_first() for c in ties]]


def _placed(df: DataFrame, order: Sequence[Column], weight: Column | None = None) -> DataFrame:
    """Rows in order with ``_place``, the 1-based place of their first unit of weight, and ``_total`` of all weights.

    Without a weight each row counts as one, and its place in the block is known without another look at it.
    """
    rows = cut_lineage(df.orderBy(*order).withColumn("_row", F.monotonically_increasing_id()))
    block = F.shiftright("_row", ROWS_BITS)
    sizes = rows.groupBy(block.alias("_block")).agg(F.sum(F.lit(1) if weight is None else weight).alias("_n"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sizes.select(
        "_block",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"))
    if weight is None:
        inside = F.col("_row").bitwiseAND(F.lit((1 << ROWS_BITS) - 1))
    else:
        window = Window.partitionBy("_block").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
        inside = F.coalesce(F.sum(weight).over(window), F.lit(0))
    return (rows.withColumn("_block", block).withColumn("_inside", inside)
            .join(F.broadcast(blocks), "_block")
            .withColumn("_place", F.col("_before") + F.col("_inside") + 1).drop("_row", "_block", "_inside", "_before"))


def _match(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``right``'s other columns to ``left``; NULL keys match NULL keys, hot ones are split."""
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(SALTS)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    condition = F.col("l._salt") == F.col("r._salt")
    for c in columns:
        condition = condition & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    extra = [F.col(f"r.{c}") for c in right.columns if c not in columns]
    return salted.alias("l").join(copies.alias("r"), condition).select("l.*", *extra).drop("_salt")


def _with_ties(df: DataFrame, by: Sequence[str], key: str, descending: bool) -> DataFrame:
    """Rows with ``_rank`` (ties share the first place) and ``_size`` of the group."""
    df = cut_lineage(df)
    values = df.groupBy(*by, key).agg(F.count(F.lit(1)).alias("_n"))
    ties = _placed(values, _sorted_by(by, key, descending, ()), F.col("_n"))
    if by:
        groups = ties.groupBy(*by).agg(F.min("_place").alias("_start"), F.sum("_n").alias("_size"))
        ties = _match(ties, groups, by).withColumn("_place", F.col("_place") - F.col("_start") + 1)
    else:
        ties = ties.withColumnRenamed("_total", "_size")
    return _match(df, ties.select(*by, key, F.col("_place").alias("_rank"), "_size"), [*by, key])


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def numbered(df: DataFrame, by: Sequence[str], key: str, descending: bool, ties: Sequence[str]) -> DataFrame:
    """Rows with ``_place`` and ``_total`` within ``by``; what the ties leave equal is ordered by a hash of the row."""
    rows = _placed(df, [*_sorted_by(by, key, descending, ties), _row_hash(df)])
    if not by:
        return rows
    groups = rows.groupBy(*by).agg(F.min("_place").alias("_start"), F.count(F.lit(1)).alias("_size"))
    return (_match(rows.drop("_total"), groups, by)
            .withColumn("_place", F.col("_place") - F.col("_start") + 1)
            .withColumnRenamed("_size", "_total").drop("_start"))


def rank(df: DataFrame, by: Sequence[str], key: str, name: str, descending: bool = True) -> DataFrame:
    """RANK within ``by``: ties share a rank and leave a gap."""
    return _with_ties(df, by, key, descending).withColumn(name, F.col("_rank").cast("int")).drop("_rank", "_size")


def percent_rank(df: DataFrame, by: Sequence[str], key: str, name: str, descending: bool = False) -> DataFrame:
    """PERCENT_RANK within ``by``: 0 to 1, and 0 for a group of one row."""
    share = (F.col("_rank") - 1).cast("double") / F.nullif(F.col("_size") - 1, F.lit(0))
    return (_with_ties(df, by, key, descending)
            .withColumn(name, F.coalesce(share, F.lit(0.0))).drop("_rank", "_size"))


def dense_rank(df: DataFrame, by: Sequence[str], key: str, name: str, descending: bool = True) -> DataFrame:
    """DENSE_RANK within ``by``: ties share a rank, without gaps."""
    df = cut_lineage(df)
    values = row_number(df.select(*by, key).distinct(), by, key, name, descending)
    return _match(df, values, [*by, key])


def row_number(df: DataFrame, by: Sequence[str], key: str, name: str, descending: bool = True,
               ties: Sequence[str] = ()) -> DataFrame:
    """ROW_NUMBER within ``by``; give ``ties`` columns that make the order total."""
    rows = numbered(df, by, key, descending, ties)
    return rows.withColumn(name, F.col("_place").cast("int")).drop("_place", "_total")


def ntile(df: DataFrame, tiles: int, by: Sequence[str], key: str, name: str, descending: bool = False,
          ties: Sequence[str] = ()) -> DataFrame:
    """NTILE within ``by``; the first groups take one row more when sizes differ."""
    rows = numbered(df, by, key, descending, ties)
    parts = (rows.withColumn("_long", F.col("_total") % tiles)
             .withColumn("_short_size", F.expr(f"_total div {tiles}"))
             .withColumn("_long_rows", F.col("_long") * (F.col("_short_size") + 1)))
    tile = F.when(F.col("_place") <= F.col("_long_rows"), F.expr("(_place - 1) div (_short_size + 1) + 1")).otherwise(
        F.expr("_long + (_place - _long_rows - 1) div greatest(_short_size, 1) + 1"))
    return (parts.withColumn(name, tile.cast("int"))
            .drop("_place", "_total", "_long", "_short_size", "_long_rows"))


def top_n(df: DataFrame, n: int, by: Sequence[str], key: str, name: str, descending: bool = True,
          ties: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows of each group, numbered, in the order of ``row_number``.

    A group is dealt over parts by a hash of the row, and the first ``n`` of its
    parts are ranked again. Map tasks send no more than ``n`` rows of a part; where ``n`` is over what Spark
    does that for, there are more parts, in two steps. So no task receives a whole group, and nothing is
    written. Where ``n`` is so large that the parts' rows are many, all rows are numbered.
    """
    steps = [SALTS] if n <= LIMITED else [SALTS ** 3, 4 * SALTS]
    if n * steps[-1] > TOP_ROWS:
        return row_number(df, by, key, name, descending, ties).filter(F.col(name) <= n)
    order = [*_sorted_by((), key, descending, ties), F.col("_hash")]
    rows = df.withColumn("_hash", _row_hash(df))
    for parts in steps:
        window = Window.partitionBy(*by, F.pmod("_hash", F.lit(parts))).orderBy(*order)
        rows = rows.withColumn("_place", F.row_number().over(window)).filter(F.col("_place") <= n).drop("_place")
    first = rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return first.filter(F.col(name) <= n).drop("_hash")
