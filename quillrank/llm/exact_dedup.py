"""Exact duplicates by an extendible-hash index on shared files. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, NO_ID, discard, doc_id, documents, join_sized, rows, saved


def entries(docs: DataFrame, key_bits: int = 64) -> DataFrame:
    """(id, n, key, sha, norm): the text without white space, its hash key and what ranks a row among equals.

    ``key_bits`` below 64 makes keys collide; tests use it.
    """
    norm = F.translate("text", BLANKS, "")
    return rows(docs).select("id", F.length("text").alias("n"), norm.alias("norm")).select(
        "id", "n", "norm", F.sha2("norm", 256).alias("sha"),
        F.shiftleft(F.shiftrightunsigned(F.xxhash64("norm"), 64 - key_bits), 64 - key_bits).alias("key"))


def directory(keys: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """The directory of an extendible hash index over the distinct ``key`` values: (slot, bucket), and its depth.

    A slot stands for the first ``depth`` bits of a key. The directory starts at the depth that the number of
    keys asks for; while a bucket holds more than ``capacity`` keys, it doubles and only overfull buckets split.
    Ten doublings beyond even filling end it: keys equal in so many bits stay in one bucket and are chained.
    """
    distinct = saved(keys.select("key").distinct(), "exact-keys")
    start = max(0, math.ceil(math.log2(max(1, distinct.count()) / capacity)))
    deepest = start + 10
    # a histogram at the deepest level is all that the doublings read
    left = saved(distinct.groupBy(F.shiftrightunsigned("key", 64 - deepest).alias("slot"))
                 .agg(F.count("*").alias("n")), "exact-slots")
    done = None
    for depth in range(start, deepest + 1):
        prefix = F.shiftright("slot", deepest - depth)
        fill = left.groupBy(prefix.alias("prefix")).agg(F.sum("n").alias("fill"))
        # a bucket is named by its depth and prefix, in one number
        state = saved(left.withColumn("prefix", prefix).join(fill, "prefix").select(
            "slot", "n", F.when((F.col("fill") <= capacity) | F.lit(depth == deepest),
                                F.shiftleft(F.lit(1).cast("bigint"), depth) + F.col("prefix")).alias("bucket")),
            "exact-directory")
        closed = state.filter("bucket is not null").select("slot", "bucket")
        done = closed if done is None else done.unionByName(closed)
        left = state.filter("bucket is null").select("slot", "n")
        if left.isEmpty():
            break
    return done, deepest


def rank() -> Column:
    """Most code points, then smallest doc_id; the digest only tells rows apart that share both."""
    return F.struct((-F.col("n")).alias("less"), "id", "sha")


def buckets(stored: DataFrame, capacity: int) -> DataFrame:
    """(bucket, key, rows, id, sha): the index's files before texts are compared, one row per key, stored by bucket.

    ``id`` and ``sha`` are those of the key's first row by rank.
    """
    slots, depth = directory(stored, capacity)
    keys = stored.groupBy("key").agg(F.count("*").alias("rows"), F.min(rank()).alias("r")).select(
        F.shiftrightunsigned("key", 64 - depth).alias("slot"), "key", "rows", "r.id", "r.sha")
    return saved(keys.join(slots, "slot").drop("slot").repartition("bucket"), "exact-buckets")


def index(docs: DataFrame, stored: DataFrame, capacity: int, key_bits: int = 64) -> DataFrame:
    """One row per different text: (bucket, key, chain, sha, keep_id, group_size).

    A key that one row has is a chain of one link. The texts meet their keys in one shuffle, the same at every size;
    of keys that several rows have, the head (the first row by rank) is compared with the others byte by byte, and those
    that equal it are its link. What differs shares the key by collision only and makes the next link, until nothing is
    left: as many rounds as the longest chain is long. Keys with many rows are not gathered, their head is sent to
    them: heads with over a thousandth of the rows hold together at most a thousand mean texts.
    """
    files = buckets(stored, capacity)
    single = files.filter("rows = 1").select("bucket", "key", F.lit(1).alias("chain"), "sha", F.col("id").alias("keep_id"),
                                             F.lit(1).cast("bigint").alias("group_size"))
    shared = files.filter("rows > 1").select("bucket", "key", "rows")
    members = saved(join_sized(entries(docs, key_bits), shared.hint("merge"), ["key"], "rows", stored.count())
                    .select("bucket", "key", "id", "n", "sha", "norm"), "exact-members")
    links, chain = single, 0
    while not members.isEmpty():
        chain += 1
        heads = saved(members.groupBy("bucket", "key").agg(
            F.count("*").alias("rows"), F.min(rank()).alias("r"), F.min_by("norm", rank()).alias("head"))
            .select("bucket", "key", "rows", "head", F.col("r.id").alias("keep_id")), "exact-heads")
        same = F.col("norm") == F.col("head")
        met = saved(join_sized(members, heads.drop("bucket").hint("merge"), ["key"], "rows", members.count()).select(
            "bucket", "key", "id", "n", "sha", "keep_id", F.when(~same, F.col("norm")).alias("norm")), "exact-met")
        link = saved(met.filter("norm is null").groupBy("bucket", "key", "keep_id").agg(
            F.count("*").alias("group_size"), F.min("sha").alias("sha")).withColumn("chain", F.lit(chain)), "exact-links")
        left = saved(met.filter("norm is not null").drop("keep_id"), "exact-members")
        discard(members, heads, met)
        links, members = links.unionByName(link), left
    return saved(links, "exact-index")


def exact_duplicates(docs: DataFrame, capacity: int = 65536, key_bits: int = 64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row for each row of ``docs``.

    Texts are equal when they are after deleting white space; of equal ones the row with most code points
    stays, then the smallest doc_id. Null texts count as empty and are copies of each other. A null doc_id
    comes last among equals. A repeated row counts in ``group_size`` and is kept with its twin: both carry the
    doc_id that stays. An empty table gives an empty result; other columns are ignored.
    """
    stored = saved(entries(docs, key_bits).drop("norm"), "exact-entries")
    found = index(docs, stored, capacity, key_bits).select("key", "sha", "keep_id", "group_size")
    return join_sized(stored, found, ["key", "sha"], "group_size", stored.count()).select(
        doc_id(), doc_id("keep_id").alias("keep_id"), "group_size", (F.col("id") == F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"))


SQL = r"""with d as (
  select doc_id, length(coalesce(text, '')) n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') norm from documents),
best as (
  select norm, first(doc_id order by n desc, doc_id) keep_id, count(*) group_size from d group by norm)
select doc_id, keep_id, group_size, doc_id = keep_id kept, sha256(norm) text_sha256 from d join best using (norm)"""


def query(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))
