"""Text pipeline: every stage works on what the one before it kept."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrank.llm import language_id
from quillrank.llm.bpe import encode
from quillrank.llm.common import NO_ID, discard, documents, recorded, saved
from quillrank.llm.exact_dedup import exact_duplicates
from quillrank.llm.mixing import mix
from quillrank.llm.near_dedup import near_duplicates


#: Tables that the last stage left behind. Its result is written before the next stage begins, which deletes them.
_left: list[DataFrame] = []


def stage(work: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    @functools.wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _left:
            table = _left.pop()
            if not table.sparkSession.sparkContext._jsc.sc().isStopped():
                discard(table)
        with recorded() as tables:
            out = work(spark, docs, sf_dir)
        _left.extend(tables)
        return out
    return run


def _key(column: str = "doc_id"):
    return F.coalesce(F.col(column).cast("bigint"), F.lit(NO_ID))


def _named(docs: DataFrame, name: str) -> str:
    """A column name that the table does not have yet."""
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def _only(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is ``kept`` in ``decided``; repeated rows once."""
    key, mark = _named(docs, "_key"), _named(docs, "_mark")
    stay = decided.filter("kept").select(_key().alias(key)).distinct()
    return (docs.withColumn(key, _key()).join(stay, key).withColumn(mark, F.md5(F.coalesce("text", F.lit(""))))
            .dropDuplicates([key, mark]).select(*docs.columns))


@stage
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: they have letters, and one language is likelier than all others."""
    return language_id.accepted(docs, F.lit(True))


@stage
def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return _only(docs, exact_duplicates(docs))


@stage
def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and all that have none."""
    return _only(docs, near_duplicates(docs))


@stage
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: not at all, once or twice."""
    key, copies, copy = (_named(docs, c) for c in ("_key", "_copies", "_copy"))
    taken = mix(docs).filter("copies > 0").groupBy(_key().alias(key)).agg(F.max("copies").alias(copies))
    return (docs.withColumn(key, _key()).join(taken, key)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns))


@stage
def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every copy in the mix, and the digest of the text that they decode to."""
    return encode(docs).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                               F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language ID", language_stage), ("exact dedup", exact_stage), ("MinHash near-dedup", near_stage),
          ("mixing", mixing_stage), ("BPE encoding", encoding_stage)]

#: None: naive Bayes, MinHash candidates, Newton steps and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table, each written and read again before the next."""
    docs = documents(spark, sf_dir)
    for k, (_, work) in enumerate(STAGES):
        before, docs = docs, work(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, "pipeline")
            if k:
                discard(before)
    return docs
