"""What the operators share: the row form of documents, stored tables, joins on hot keys."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: The six white-space characters that separate words: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands for a null doc_id inside the operators and sorts behind all others; output turns it into null again.
NO_ID = (1 << 63) - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def rows(docs: DataFrame) -> DataFrame:
    """(id, text): null texts become empty, null ids ``NO_ID``; further columns, whatever their names, are left out."""
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"),
                       F.coalesce("text", F.lit("")).alias("text"))


def marked(docs: DataFrame) -> DataFrame:
    """(id, mark, text): ``mark`` is the text's digest.

    (id, mark) joins a row to what was found about it. Repeated rows find the same, and rows that share a
    doc_id but differ in text don't mix.
    """
    return rows(docs).select("id", F.unhex(F.md5("text")).alias("mark"), "text")


def doc_id(column: str = "id") -> Column:
    return F.nullif(F.col(column), F.lit(NO_ID)).alias("doc_id")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The table, written once below the shared folder of ``spark.checkpoint.dir`` and read back.

    It cuts the lineage: a lost executor costs the tasks that read it, not the work before it. What the
    finished job shuffled is no longer needed; collecting garbage lets Spark's cleaner delete it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    out = spark.read.parquet(path)
    out.stored_at = path
    for tables in _RECORDS:
        tables.append(out)
    return out


_RECORDS: list[list[DataFrame]] = []


@contextmanager
def recorded() -> Iterator[list[DataFrame]]:
    """The tables that :func:`saved` makes meanwhile, for whoever will know when they are no longer read."""
    tables: list[DataFrame] = []
    _RECORDS.append(tables)
    try:
        yield tables
    finally:
        _RECORDS.remove(tables)


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by :func:`saved` that nothing will read any more."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def join_sized(left: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int,
               share: int = 1000) -> DataFrame:
    """Inner join of ``left`` (a stored table of ``total`` rows) with the one row each of its groups has in ``groups``.

    ``size`` is the number of rows of the group. Groups above total/share rows, of which there can be at most
    ``share``, are broadcast, so that no task gathers a hot key; the others are shuffled.
    """
    limit = total // share
    hot = F.broadcast(groups.filter(F.col(size) > limit))
    cold = groups.filter(F.col(size) <= limit)
    rest = left.join(F.broadcast(groups.filter(F.col(size) > limit).select(*keys)), keys, "left_anti")
    return left.join(hot, keys).unionByName(rest.join(cold, keys))
