"""Exactly-once table of the latest rows of an updating stream."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def run_available(stream: DataFrame, each_batch: Callable[[DataFrame, int], None], mode: str,
                  checkpoint: str) -> None:
    """Processes all input there is, then stops; a restart continues at the checkpoint."""
    q = (stream.writeStream.outputMode(mode).foreachBatch(each_batch).trigger(availableNow=True)
         .option("checkpointLocation", checkpoint).start())
    q.awaitTermination()


class LatestRows:
    """The newest row of each key, in a folder that stays small.

    A micro-batch writes its changed rows to a folder of its own number. Every ``every`` batches a snapshot takes in the
    last snapshot and the batches since; an empty file named after the last batch commits it by a rename, and what
    it replaces is deleted. Readers take the largest committed snapshot and the batches after it: a kill before the
    commit leaves a snapshot that nobody reads and the next attempt overwrites, a kill after it leaves folders
    that the next snapshot deletes. A repeated batch overwrites itself.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], every: int = 20):
        self.spark, self.path, self.keys, self.every = spark, path, keys, every
        jvm = spark.sparkContext._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self, folder: str) -> list[int]:
        place = self._at(f"{self.path}/{folder}")
        names = [f.getPath().getName() for f in self._fs.listStatus(place)] if self._fs.exists(place) else []
        return sorted(int(m[1]) for m in (re.fullmatch(r"n=(\d+)", x) for x in names) if m)

    def committed(self) -> int:
        """The last batch of the snapshot that counts; -1 if there is none."""
        return max(self._numbers("commits"), default=-1)

    def write(self, batch: DataFrame, number: int) -> None:
        if number <= self.committed():
            return  # a batch that is repeated after its snapshot was committed
        batch.write.mode("overwrite").parquet(f"{self.path}/rows/n={number}")
        if (number + 1) % self.every == 0:
            self.compact(number)

    def compact(self, number: int) -> None:
        self.rows(number).write.mode("overwrite").parquet(f"{self.path}/snapshots/n={number}")
        self.commit(number)
        for folder, keep in (("rows", number + 1), ("snapshots", number), ("commits", number)):
            for n in self._numbers(folder):
                if n < keep:
                    self._fs.delete(self._at(f"{self.path}/{folder}/n={n}"), True)

    def commit(self, number: int) -> None:
        draft = self._at(f"{self.path}/commits/draft-{number}")
        self._fs.create(draft, True).close()
        if not self._fs.rename(draft, self._at(f"{self.path}/commits/n={number}")):
            raise OSError(f"snapshot {number} was not committed")

    def rows(self, upto: int | None = None) -> DataFrame:
        """One row a key; the newest batch that has the key counts."""
        base = self.committed()
        numbers = [n for n in self._numbers("rows") if n > base and (upto is None or n <= upto)]
        parts = [self.spark.read.parquet(f"{self.path}/rows/n={n}").withColumn("__n", F.lit(n)) for n in numbers]
        if base >= 0:
            parts.append(self.spark.read.parquet(f"{self.path}/snapshots/n={base}").withColumn("__n", F.lit(base)))
        every = parts[0]
        for more in parts[1:]:
            every = every.unionByName(more)
        values = [c for c in every.columns if c not in (*self.keys, "__n")]
        newest = F.max_by(F.struct(*values), "__n").alias("row")
        return every.groupBy(*self.keys).agg(newest).select(*self.keys, "row.*")


def latest(stream: DataFrame, keys: list[str], path: str | None = None, every: int = 20) -> DataFrame:
    """Runs an aggregated stream and returns its current rows, one per key."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, "stream")
    table = LatestRows(spark, path, keys, every)
    run_available(stream, table.write, "update", f"{path}/checkpoint")
    return table.rows()
