"""k-anonymity: columns coarsened together until each combination has at least k rows.

Masking goes column by column, and a region, a birth year and a gender together may
still single someone out. Here each such column has a ladder of coarser values, and a choice of one
level for each is a point of a lattice. All points are judged at once, from the counts of the
finest combinations, which are aggregated first: how many rows would be in
groups under k and go, and how much the others lose. The least loss wins.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from ratestar.sources.star import Star

Ladder = Sequence[Callable[[Column], Column]]


def whole(value: Column) -> Column:
    return value


def hidden(value: Column) -> Column:
    return F.lit(None).cast("string")


def first_digits(n: int) -> Callable[[Column], Column]:
    return lambda value: F.substring(value, 1, n)


#: Coarser and coarser values; each level must be a function of the one before it.
ZIP_CODE: Ladder = (whole, first_digits(3), first_digits(2), first_digits(1), hidden)
BIRTH: Ladder = (lambda d: F.date_format(d, "yyyy-MM"), lambda d: F.date_format(d, "yyyy"),
                 lambda d: F.concat((F.floor(F.year(d) / 10) * 10).cast("string"), F.lit("s")), hidden)
GENDER: Ladder = (whole, hidden)
MEMBER_LADDERS: Mapping[str, Ladder] = {"zip_code": ZIP_CODE, "date_of_birth": BIRTH, "gender": GENDER}


@dataclass(frozen=True)
class Point:
    """A level for each column, what it costs, and how many rows are in groups that are too small."""

    levels: tuple[int, ...]
    loss: float
    suppressed: int


def _loss(levels: Sequence[int], heights: Sequence[int], kept: int, total: int) -> float:
    """A suppressed row loses all, another one the mean share of the ladders that its columns climb."""
    share = sum(level / max(1, height) for level, height in zip(levels, heights)) / len(levels)
    return ((total - kept) + kept * share) / total if total else 0.0


def judge(df: DataFrame, ladders: Mapping[str, Ladder], k: int) -> list[Point]:
    """All points of the lattice. Their number is the product of the ladders' lengths, whatever the data.

    NULL is a value like any other.
    """
    columns, rungs = list(ladders), [range(len(ladder)) for ladder in ladders.values()]
    finest = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    levels = [F.struct(*[step(F.col(c)).cast("string").alias(f"l{j}") for j, step in enumerate(ladders[c])]).alias(f"_{i}") for i, c in enumerate(columns)]
    values = finest.select("_n", *levels).groupBy(*[f"_{i}" for i in range(len(columns))]).agg(F.sum("_n").alias("_n"))
    points = [F.struct(F.lit(",".join(map(str, point))).alias("point"), *[F.col(f"_{i}")[f"l{level}"].alias(f"v{i}") for i, level in enumerate(point)])
              for point in product(*rungs)]
    groups = values.select("_n", F.explode(F.array(*points)).alias("p")).groupBy("p").agg(F.sum("_n").alias("_n"))
    found = groups.groupBy("p.point").agg(F.sum("_n").alias("total"), F.coalesce(F.sum(F.when(F.col("_n") >= k, F.col("_n"))), F.lit(0)).alias("kept"))
    out = []
    for row in found.collect():
        point = tuple(map(int, row["point"].split(",")))
        out.append(Point(point, _loss(point, [len(r) - 1 for r in rungs], row["kept"], row["total"]), row["total"] - row["kept"]))
    return sorted(out, key=lambda p: (p.loss, p.levels))


def anonymous(df: DataFrame, ladders: Mapping[str, Ladder], k: int, most_suppressed: float = 0.1) -> DataFrame:
    """Rows with the named columns coarsened (as strings) such that each combination has k rows at least.

    Rows whose combination is rarer are left out, at most the given share of all; of the points that
    allow it, that of least loss is taken, of equal ones the one with the lower levels in the
    order of the columns. If none does, nothing but suppression is left and a ValueError is raised. Other columns stay
    as they are and should hold nothing that singles out. Tables without rows stay so.
    """
    points = judge(df, ladders, k)
    if not points:
        return df.withColumns({c: F.lit(None).cast("string") for c in ladders})
    total = df.count()
    allowed = [p for p in points if p.suppressed <= most_suppressed * total]
    if not allowed:
        raise ValueError(f"no level of coarseness gives groups of {k} rows")
    rows = df.withColumns({c: ladder[level](F.col(c)).cast("string") for (c, ladder), level in zip(ladders.items(), allowed[0].levels)})
    # Groups that are too small are few rows each, so no key of this join is hot on their side.
    small = rows.groupBy(*ladders).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") < k)
    condition = F.lit(True)
    for c in ladders:
        condition = condition & F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}"))
    return rows.alias("r").join(small.alias("s"), condition, "left_anti")


def anonymous_members(star: Star, k: int = 5, most_suppressed: float = 0.1) -> DataFrame:
    """Postal code, birth and gender of members, coarsened together, with their eligibility category; no numbers of members."""
    members = star.table("dim_member", [*MEMBER_LADDERS, "aid_category"])
    return anonymous(members, MEMBER_LADDERS, k, most_suppressed)
