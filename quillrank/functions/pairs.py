"""Self-join of a long table on a group column, safe for very large groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouped_pairs(df: DataFrame, group: str, item: str, value: str, tile: int = 2048,
                  first: Column | None = None) -> DataFrame:
    """Rows ``(group, i, j, vi, vj)`` with i < j for items sharing a group.

    Callers aggregate by (i, j) at once, so Spark combines the pairs map-side.
    A group with more than ``tile`` members is cut into parts by item hash and
    joined part by part: the join key becomes (group, part, part), so a hot
    group spreads over many tasks and no key holds more than about ``tile``
    rows per side. Groups below the limit have one part and are not copied.

    ``first``, a condition on the row of the smaller item, is applied before the join: rows that fail it never
    enter the left side. Then every part of the left meets every part of the right.
    """
    parts = (df.groupBy(group).agg(F.count("*").alias("__n"))
             .filter(F.col("__n") > tile)
             .select(group, F.ceil(F.col("__n") / tile).cast("int").alias("__parts")))
    base = (df.select(group, item, value).join(parts, group, "left")
            .withColumn("__parts", F.coalesce("__parts", F.lit(1)))
            .withColumn("__own", F.pmod(F.xxhash64(item), "__parts").cast("int")))
    low, high = (F.col("__own"),) * 2 if first is None else (F.lit(0), F.col("__parts") - 1)
    left = (base if first is None else base.filter(first)).select(group, F.col("__own").alias("__a"), F.col(item).alias("__x"),
                       F.col(value).alias("__vx"),
                       F.explode(F.sequence(low, F.col("__parts") - 1)).alias("__b"))
    right = base.select(group, F.col("__own").alias("__b"), F.col(item).alias("__y"),
                        F.col(value).alias("__vy"),
                        F.explode(F.sequence(F.lit(0), high)).alias("__a"))
    # the join multiplies its input, so its tasks must not be merged by input size
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [group, "__a", "__b"]
    pairs = left.repartition(n, *keys).join(right.repartition(n, *keys), keys)
    if first is not None:
        return pairs.filter(F.col("__x") < F.col("__y")).select(
            group, F.col("__x").alias("i"), F.col("__y").alias("j"), F.col("__vx").alias("vi"), F.col("__vy").alias("vj"))
    pairs = pairs.filter((F.col("__a") < F.col("__b")) | (F.col("__x") < F.col("__y")))
    ordered = F.col("__x") < F.col("__y")

    def side(first: str, second: str) -> Column:
        return F.when(ordered, F.col(first)).otherwise(F.col(second))

    return pairs.select(group, side("__x", "__y").alias("i"), side("__y", "__x").alias("j"),
                        side("__vx", "__vy").alias("vi"), side("__vy", "__vx").alias("vj"))
