"""Rating matrices and factors as text: readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .corpus import split_words


def read_coo(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """``user item rating`` lines; rows with missing or bad fields are skipped."""
    return _cells(spark.read.text(path), id_type)


def _cells(lines: DataFrame, id_type: str) -> DataFrame:
    p = F.col("p")
    return (lines.select(split_words(F.col("value")).alias("p"))
            .filter(F.size(p) >= 3)
            .select(p[0].try_cast(id_type).alias("user_id"), p[1].try_cast(id_type).alias("item_id"),
                    p[2].try_cast("double").alias("rating"))
            .dropna())


def read_coo_with_header(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_coo`, any white space between fields, for files starting with an ``m n nnz`` line."""
    # lines as one column: the separator is a character that no text has, and the reader drops each file's header
    lines = (spark.read.schema("value string").option("sep", "\x01").option("quote", "").option("header", True)
             .option("enforceSchema", True).csv(path))
    return _cells(lines, "bigint")


def write_coo(ratings: DataFrame, path: str) -> None:
    ratings.select(F.concat_ws(" ", "user_id", "item_id", "rating").alias("value")).write.text(path)


def write_factors(factors: DataFrame, path: str, text: bool = False) -> None:
    """``id v1,v2,...`` text lines, or parquet."""
    if text:
        line = F.concat_ws(" ", "id", F.array_join(F.transform("features", lambda v: v.cast("string")), ","))
        factors.select(line.alias("value")).write.text(path)
    else:
        factors.write.parquet(path)


def read_factors(spark: SparkSession, path: str, text: bool = False, id_type: str = "bigint") -> DataFrame:
    if not text:
        return spark.read.parquet(path)
    parts = F.split("value", " ", 2)
    return spark.read.text(path).select(
        parts[0].cast(id_type).alias("id"),
        F.transform(F.split(parts[1], ","), lambda v: v.cast("double")).alias("features"))


def write_similarity(similar: DataFrame, path: str) -> None:
    """``i j s`` lines with two decimals."""
    similar.select(F.format_string("%d %d %.2f", "i", "j", "sim").alias("value")).write.text(path)
