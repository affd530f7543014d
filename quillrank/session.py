"""Session-level helpers: the shared folder, checkpoints, the package on executors."""

from __future__ import annotations

import atexit
import gc
import math
import os
import shutil
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may run without that setting; it gets its own folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if path is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
            path = tempfile.mkdtemp(prefix="quillrank-")
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
    """The table written once below the shared folder and read back; ``stored_at`` names the folder."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition) if partition else df.write
    writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def delete_stored(*tables: DataFrame) -> None:
    """Deletes tables made by :func:`stored` that nothing will read any more."""
    for table in tables:
        path = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete what finished jobs have shuffled and broadcast; it waits for the driver to collect its garbage.

    Listeners hold on to a job for a moment after its end, so one collection does not reach its files.
    """
    for pause in (0.3, 0.0):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(pause)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that an iterative job survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Input with fewer splits than cores, hashed over all cores; larger input as it is.

    For scans that feed CPU-heavy row work: a small file is one split, while a
    large table has plenty and need not be shuffled. Call it on a plain scan,
    whose split count is known without running anything.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n, key)


#: Rows of a partition whose tasks sort or hash them whole.
SLICE_ROWS = 1 << 20


def slices(df: DataFrame, rows: int = SLICE_ROWS) -> int:
    """Partitions of about ``rows`` rows for ``df``, whose rows are cheap to count; 0 if it has too few to keep all cores busy with that."""
    spark = df.sparkSession
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = math.ceil(df.count() / rows)
    return max(n, shuffles) if n > min(shuffles, spark.sparkContext.defaultParallelism) else 0


def sliced(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """``df`` hashed by its keys into ``n`` partitions, which adaptive execution does not merge; with 0 as it is."""
    return df.repartition(n, *keys) if n else df


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application, so that their Python workers can import it.

    Spark serves the archive from the driver to every executor, wherever the driver was started.
    """
    sc = spark.sparkContext
    if getattr(sc, "_quillrank_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="quillrank-package-")  # served from here as long as the driver lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "quillrank"), "zip", root, "quillrank"))
    sc._quillrank_shipped = True
