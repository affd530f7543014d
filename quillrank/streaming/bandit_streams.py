"""Bandit statistics and topics kept up to date by streams.

All statistics are sums, so the stream runs the batch aggregation as it is and
Spark keeps one short state row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import linucb, online_topics
from ..operators.bandit import arm_stats
from ..session import scratch_path
from .sink import latest, run_available


def read_table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Stream of a table's parquet files, new files included as they arrive."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}*.parquet")


def stream_arm_stats(pulls: DataFrame, path: str | None = None) -> DataFrame:
    return latest(arm_stats(pulls), ["arm"], path)


def stream_linucb_state(pulls: DataFrame, d: int, path: str | None = None) -> DataFrame:
    return latest(linucb.linucb_state(pulls, d), ["arm"], path)


def stream_user_state(pulls: DataFrame, d: int, ridge: float = 0.1, path: str | None = None) -> DataFrame:
    return latest(linucb.ridge_sums(pulls, "user_id", d, ridge), ["user_id"], path)


def stream_arm_daily(pulls: DataFrame, delay: str = "1 hour", path: str | None = None) -> DataFrame:
    """(day, arm, trials, wins) in daily windows; the watermark lets old days leave the state."""
    # windows and watermarks need an instant: the one that reads as ts in UTC
    timed = pulls.withColumn("at", F.timestamp_micros("t")).withWatermark("at", delay)
    daily = (timed.groupBy(F.window("at", "1 day"), "arm")
             .agg(F.count("*").alias("trials"), F.sum("reward").alias("wins"))
             .select(F.date_from_unix_date(F.floor(F.unix_seconds("window.start") / 86400).cast("int"))
                     .cast("string").alias("day"), "arm", "trials", "wins"))
    return latest(daily, ["day", "arm"], path)


def stream_topics(words: DataFrame, topics: int, total_docs: int | None = None,
                  path: str | None = None) -> DataFrame:
    """(word, weight) after one online LDA step per micro-batch of documents.

    Batch n reads the weights batch n - 1 wrote, so a repeated batch starts
    from the same weights again.
    """
    spark = words.sparkSession
    path = path or scratch_path(spark, "topics")

    def step(batch: DataFrame, number: int) -> None:
        old = spark.read.parquet(f"{path}/weights/batch={number - 1}") if number else None
        new = online_topics.update(batch, topics, old, updates=number, total_docs=total_docs)
        new.write.mode("overwrite").parquet(f"{path}/weights/batch={number}")

    run_available(words, step, "append", f"{path}/checkpoint")
    weights = spark.read.parquet(f"{path}/weights")
    return weights.filter(F.col("batch") == weights.agg(F.max("batch")).scalar()).drop("batch")
