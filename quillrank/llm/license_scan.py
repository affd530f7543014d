"""Licence detection: ordered rules behind keywords, overlaps settled by priority. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, doc_id, documents, marked, saved
from .license_rules import CC, GATES, Rule, rules

#: A word of the text as it is written; with A-Z in lower case it is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def either(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" ")))


def detections(docs: DataFrame, table: list[Rule]) -> DataFrame:
    """(id, mark, rule, label, priority, confidence, base, first, last): each match of each rule, in words from 0.

    Three gates keep most texts from most patterns: parts of words that all rules need, then the rule's keywords,
    then the pattern over the text's words. Texts that pass the first gate are written once.
    """
    lowered = F.lower("text")  # at least A-Z; this gate alone may let more through
    gate = either([F.contains(lowered, F.lit(g)) for g in GATES]) | F.rlike("text", F.lit(CC))
    words = F.concat(F.lit(" "), F.btrim(F.regexp_replace(F.translate("text", UPPER, LOWER), BETWEEN, " ")), F.lit(" "))
    texts = saved(marked(docs).filter(gate).select("id", "mark", words.alias("words")).dropDuplicates(["id", "mark"]),
                  "license-texts")
    keywords = sorted({r.keyword for r in table})
    met = F.array_compact(F.array(*(F.when(either([F.contains("words", F.lit(k)) for k in key.split("|")]), F.lit(key))
                                    for key in keywords)))
    spark = docs.sparkSession
    # the rules are a fixed list, so they are broadcast
    listed = F.broadcast(spark.createDataFrame(table, "rule string, label string, keyword string, priority int, "
                                                      "confidence double, pattern string, base boolean"))
    tried = (texts.withColumn("keyword", F.explode(met)).join(listed, "keyword")
             .filter(F.rlike(F.col("words"), F.col("pattern"))))
    # a text is its pieces between matches and the matches in turn; blanks count the words
    pieces, matches = F.split("words", F.col("pattern"), -1), F.regexp_extract_all("words", F.col("pattern"), F.lit(0))
    turn = F.arrays_zip(F.transform(pieces, blanks).alias("gap"), F.transform(matches, blanks).alias("own"))
    found = tried.select("id", "mark", "rule", "label", "priority", "confidence", "base", F.posexplode(turn).alias("k", "t"))
    upto = Window.partitionBy("id", "mark", "rule").orderBy("k")
    before = F.sum(F.col("t.gap") + F.coalesce("t.own", F.lit(0))).over(upto) - F.coalesce("t.own", F.lit(0))
    return (found.withColumn("first", (before - 1).cast("bigint")).filter("t.own is not null")
            .withColumn("last", F.col("first") + F.col("t.own")).drop("k", "t"))


def settled(found: DataFrame) -> DataFrame:
    """The detections but those that lie within another of at least their priority; base ones stay.

    In the order of starts, longer ones first, a detection lies within an earlier one if the furthest end so far of
    its priority or above reaches its own: one pass over a text's detections, however many there are.
    """
    order = (Window.partitionBy("id", "mark").orderBy("first", F.col("last").desc(), F.col("priority").desc(), "rule")
             .rowsBetween(Window.unboundedPreceding, -1))
    reach = [F.max(F.when(~F.col("base") & (F.col("priority") >= p), F.col("last"))).over(order) for p in range(6)]
    furthest = F.element_at(F.array(*reach), F.col("priority") + 1)
    return (found.filter("not base").withColumn("furthest", furthest)
            .filter(F.col("furthest").isNull() | (F.col("furthest") < F.col("last"))).drop("furthest")
            .unionByName(found.filter("base")))


def license_scan(docs: DataFrame, table: list[Rule] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans), one row for each row.

    ``spans`` lists the detections that stay (rule, label, first, last); ``score`` is the confidence of the best.
    Null and empty texts have no words, no labels ('') and score 0. Repeated rows get the same answer; an empty
    table gives an empty result; other columns are ignored.
    """
    kept = settled(saved(detections(docs, rules() if table is None else table), "license-found"))
    base = F.col("base")
    found = kept.groupBy("id", "mark").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"), F.collect_set(F.when(base, F.col("label"))).alias("b"),
        F.collect_set("label").alias("l"), F.max("confidence").alias("score"),
        F.array_sort(F.collect_list(F.struct("first", "last", "rule", "label"))).alias("spans"))
    counted = marked(docs).select("id", "mark", F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("n_words"))
    joined = lambda c: F.coalesce(F.array_join(F.array_sort(c), ","), F.lit(""))
    return counted.join(found, ["id", "mark"], "left").select(
        doc_id(), "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"), "first_word", "last_word",
        joined("b").alias("base_labels"), joined("l").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"), "spans")


def query(spark, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir)).drop("spans")
