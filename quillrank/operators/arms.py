"""Scoring every request against every arm without multiplying rows."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARM_BLOCK = 1000
BROADCAST_BLOCKS = 100


def with_arm_blocks(requests: DataFrame, arms: DataFrame, *columns: str) -> DataFrame:
    """Each request with an array ``arms`` of structs, one row per block of 1000 arms.

    Up to 100,000 arms the packed blocks are broadcast, a size checked by the
    count here. Beyond that both sides are salted and joined by a shuffle, so
    a block meets its requests in many tasks.
    """
    n = arms.count()
    blocks = max(1, math.ceil(n / ARM_BLOCK))
    packed = (arms.select(F.struct(*columns).alias("a"),
                          F.pmod(F.xxhash64(columns[0]), F.lit(blocks)).cast("int").alias("__block"))
              .groupBy("__block").agg(F.collect_list("a").alias("arms")))
    asked = requests.withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    if blocks <= BROADCAST_BLOCKS:
        return asked.join(F.broadcast(packed), "__block").drop("__block")
    salts = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = asked.withColumn("__salt", F.pmod(F.xxhash64(*requests.columns), F.lit(salts)).cast("int"))
    packed = packed.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return asked.join(packed, ["__block", "__salt"]).drop("__block", "__salt")


def best_arm(requests: DataFrame, key: str, arms: DataFrame, columns: tuple[str, ...],
             score: Callable[[Column], Column]) -> DataFrame:
    """(key, arm, score): the arm with the highest rounded score, the smallest arm on ties."""
    scored = F.transform("arms", lambda a: F.struct((-F.round(score(a), 6)).alias("key"),
                                                    a[columns[0]].alias("arm")))
    per_block = with_arm_blocks(requests, arms, *columns).select(key, F.array_min(scored).alias("best"))
    return (per_block.groupBy(key).agg(F.min("best").alias("best"))
            .select(key, "best.arm", (F.lit(0.0) - F.col("best.key")).alias("score")))
