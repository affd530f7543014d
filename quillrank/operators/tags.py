"""Tag selection over a labelled corpus: information gain and chi-square."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import xlogx
from ..session import cut_lineage


def category_counts(labelled: DataFrame) -> DataFrame:
    """(category, docs)."""
    return labelled.groupBy("category").agg(F.count("*").alias("docs"))


def category_entropy(labelled: DataFrame) -> DataFrame:
    """One row: entropy (natural log) of the categories."""
    counts = category_counts(labelled)
    return counts.agg((F.log(F.sum("docs")) - F.sum(xlogx(F.col("docs"))) / F.sum("docs")).alias("entropy"))


def tag_category_counts(labelled: DataFrame) -> DataFrame:
    """(tag, category, docs): documents of the category holding the tag."""
    return (labelled.select("category", F.explode(F.array_distinct("tags")).alias("tag"))
            .groupBy("tag", "category").agg(F.count("*").alias("docs")))


def contingency(labelled: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """(category, tag, a, m, q, n) document counts of the observed pairs.

    a: in the category with the tag; m: in the category; q: with the tag; n: all.
    The corpus is read for the pair counts and for the short category table,
    which is written once because several terms need it.
    """
    counts = cut_lineage(category_counts(labelled)) if counts is None else counts
    everything = counts.agg(F.sum("docs")).scalar()
    return (tag_category_counts(labelled)
            .select("category", "tag", F.col("docs").alias("a"),
                    F.sum("docs").over(W.partitionBy("tag")).alias("q"))
            .join(counts.select("category", F.col("docs").alias("m")), "category")
            .select("category", "tag", "a", "m", "q", everything.alias("n")))


def info_gain(labelled: DataFrame) -> DataFrame:
    """(word, ig) = H(C) - P(w) H(C|w) - P(not w) H(C|not w).

    Each entropy is ln M - (sum of m ln m) / M over its category counts m. For
    the documents without the word, that sum is the corpus constant corrected
    for the categories the word occurs in, so no word x category grid is built.
    """
    counts = cut_lineage(category_counts(labelled))
    whole = counts.agg(F.struct(F.sum("docs").alias("n"), F.sum(xlogx(F.col("docs"))).alias("s")))
    per_tag = (contingency(labelled, counts).groupBy(F.col("tag").alias("word"))
               .agg(F.sum("a").alias("q"), F.sum(xlogx(F.col("a"))).alias("with"),
                    F.sum(xlogx(F.col("m") - F.col("a")) - xlogx(F.col("m"))).alias("shift"))
               .withColumn("c", whole.scalar()))
    n, q = F.col("c.n"), F.col("q")
    system = xlogx(n) - F.col("c.s")
    inside = xlogx(q) - F.col("with")
    outside = xlogx(n - q) - (F.col("c.s") + F.col("shift"))
    return per_tag.select("word", ((system - inside - outside) / n).alias("ig"))


def chi_square(labelled: DataFrame) -> DataFrame:
    """(category, tag, chi) over the observed pairs; null if a margin is empty."""
    a, m, q, n = (F.col(c).cast("double") for c in "amqn")
    diff = a * (n + a - q - m) - (m - a) * (q - a)
    return contingency(labelled).select(
        "category", "tag", F.try_divide(n * diff * diff, m * q * (n - m) * (n - q)).alias("chi"))


def chi_top(labelled: DataFrame, top: int | None = None, digits: int = 6) -> DataFrame:
    """The best tags of each category with their rank; ``top=None`` keeps all.

    Spark prunes to ``top`` rows per task before the shuffle, so a category
    holding most of the tags does not arrive whole in one task.
    """
    scored = chi_square(labelled).dropna().withColumn("chi", F.round("chi", digits))
    best = W.partitionBy("category").orderBy(F.desc("chi"), "tag")
    ranked = scored.withColumn("rank", F.row_number().over(best))
    return ranked if top is None else ranked.filter(F.col("rank") <= top)


def write_info_gain(gains: DataFrame, path: str, sort: bool = False) -> None:
    """``word ig`` lines with two decimals."""
    gains = gains.orderBy(F.desc("ig"), "word") if sort else gains
    gains.select(F.format_string("%s %.2f", "word", "ig").alias("value")).write.text(path)


def write_chi(tags: DataFrame, path: str) -> None:
    """``category tag chi`` lines with two decimals, one folder per category."""
    line = F.format_string("%s %s %.2f", "category", "tag", "chi").alias("value")
    tags.select("category", line).write.partitionBy("category").text(path)
