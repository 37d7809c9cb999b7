"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratestar.session import collect_garbage, cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(id, comp) for every end of the links (a, b): comp is the smallest id that links reach.

    Each round hangs the larger neighbours of every node on its smallest one,
    then the smaller ones too (the large-star and small-star steps). Both are a
    minimum per node, which combines before the shuffle, and a join; no task
    gathers a node's neighbours. Rounds grow with the logarithm of the size, and
    each is written to the checkpoint folder.
    """
    stars = cut_lineage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    while True:
        both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # After the large step every pair points down, so all neighbours of the small step are smaller.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.*").where("u > v").distinct())
        after = cut_lineage(small)
        # Stars are done when no node that points down is pointed at, and none points at two.
        ends = after.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("down")),
                                              F.struct(F.col("v").alias("node"), F.lit(0).alias("down")))).alias("e"))
        done = ends.groupBy("e.node").agg(F.sum("e.down").alias("down"), F.count("*").alias("n")).where("down > 0 AND n > 1").isEmpty()
        stars = after
        collect_garbage(links.sparkSession)
        if done:
            break
    return stars.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionAll(
        stars.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())
