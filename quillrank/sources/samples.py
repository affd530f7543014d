"""Click-through samples: typed CSV and libsvm / libffm text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .corpus import split_words

#: Fixed column names and types of the census table.
CENSUS = ("age double, workclass string, fnlwgt double, education string, education_num double, "
          "marital_status string, occupation string, relationship string, race string, gender string, "
          "capital_gain double, capital_loss double, hours_per_week double, native_country string, "
          "income_bracket string")


def read_csv(spark: SparkSession, path: str, schema: str | StructType = CENSUS, header: bool = True) -> DataFrame:
    """Typed CSV with leading blanks removed and incomplete rows dropped."""
    return (spark.read.schema(schema).option("header", header).option("ignoreLeadingWhiteSpace", True)
            .option("enforceSchema", True).csv(path).dropna("any"))


def label_contains(column: str, text: str) -> Column:
    return F.col(column).contains(text).cast("int")


def parse_libffm(line: Column) -> tuple[Column, Column]:
    """Label and features of ``label [field:]feature:value ...`` lines.

    Whether a field is present is decided for every feature by its number of
    parts; without one the field is null, and so is the feature of a word without a colon.
    """
    words = split_words(line)

    def feature(w: Column) -> Column:
        p = F.split(w, ":")
        return F.struct(F.when(F.size(p) > 2, p[0].try_cast("int")).alias("field"),
                        F.try_element_at(p, F.lit(-2)).try_cast("int").alias("feature"),
                        F.try_element_at(p, F.lit(-1)).try_cast("double").alias("value"))

    return (words[0].try_cast("double"),
            F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), feature))


def read_libffm(spark: SparkSession, path: str) -> DataFrame:
    """(label, features array) of non-empty lines."""
    label, features = parse_libffm(F.col("value"))
    return spark.read.text(path).filter(F.trim("value") != "").select(
        label.alias("label"), features.alias("features"))


def write_libffm(features: DataFrame, path: str) -> None:
    """Long features as one libffm line per sample, fields in order."""
    word = F.format_string("%d:%d:%s", "field", "feature", F.col("value").cast("string"))
    (features.groupBy("sample_id", "label")
     .agg(F.array_sort(F.collect_list(F.struct("field", "feature", word.alias("word")))).alias("w"))
     .select(F.concat_ws(" ", "label", F.array_join("w.word", " ")).alias("value"))
     .write.text(path))
