"""Target-distribution importance resampling: hashed n-gram gains, interned per batch, and a Gumbel draw."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.running import running
from .common import doc_id, documents, marked, saved
from .ngrams import Interned, Words, class_mask, crc32, word_spans
from .words import LOWERED, steps

#: Bytes of words after A-Z are lower-cased: digits, a-z and all of what is not ASCII.
WORD = class_mask((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: Buckets that one row of a task's histogram holds.
CHUNK = 100


class Settings(NamedTuple):
    longest: int = 3          # words in an n-gram
    buckets: int = 10_000
    least_words: int = 20     # documents with fewer are never drawn
    percent: int = 5          # of the documents with enough words
    seed: str = "42"


class Features:
    """The n-grams of some texts: each different one once, with its bucket, and where they occur."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, s: Settings):
        data = LOWERED[data]
        starts, ends, self.bounds = word_spans(data, offsets, WORD)
        self.n_words = np.diff(self.bounds)
        words = Words(data, starts, ends)
        place, begin, length = [], [], []
        left = np.repeat(self.bounds[1:], self.n_words) - np.arange(len(starts))  # words up to the text's end
        for n in range(1, s.longest + 1):
            first = np.flatnonzero(left >= n)
            at, size = words.runs(first, n)
            place.append(first), begin.append(at), length.append(size)
        self.place, begin, length = (np.concatenate(x) for x in (place, begin, length))
        table = Interned(words.buffer, begin, length)
        self.slot, self.count = table.slot, table.count
        self.bucket = (crc32(words.buffer, begin[table.owner], length[table.owner]) % np.uint32(s.buckets)).astype(np.int64)

    def histogram(self, buckets: int) -> np.ndarray:
        return np.bincount(self.bucket, self.count, buckets).astype(np.int64)

    def sums(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(features, their gains) of each text; every occurrence gathers the gain of its slot."""
        gain, number = np.zeros(self.bounds[-1] + 1, np.int64), np.zeros(self.bounds[-1] + 1, np.int64)
        of_slot = gains[self.bucket]
        # an n-gram's first word is met once for each n: add in place, one n at a time
        cut = np.flatnonzero(np.diff(self.place) <= 0) + 1
        for place, slot in zip(np.split(self.place, cut), np.split(self.slot, cut)):
            gain[place] += of_slot[slot]
            number[place] += 1
        return (np.diff(np.r_[0, np.cumsum(number)][self.bounds]), np.diff(np.r_[0, np.cumsum(gain)][self.bounds]))


def bucket_counts(texts: DataFrame, s: Settings) -> np.ndarray:
    """How many n-grams of the whole table fall into each bucket.

    A task adds up its texts and emits its histogram once, in chunks that are summed by Spark; the driver gets
    ``s.buckets`` numbers, whatever the size of the table.
    """
    width = min(CHUNK, s.buckets)
    chunks = math.ceil(s.buckets / width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(chunks * width, np.int64)
        for _, data, offsets in steps(batches):
            total[:s.buckets] += Features(data, offsets, s).histogram(s.buckets)
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(chunks), pa.int32()), pa.array(list(total.reshape(chunks, width)), pa.list_(pa.int64()))],
                ["chunk", "counts"])

    parts = texts.mapInArrow(run, "chunk int, counts array<bigint>")
    sums = parts.groupBy("chunk").agg(F.array(*[F.sum(F.col("counts")[k]) for k in range(width)]).alias("counts"))
    out = np.zeros((chunks, width), np.int64)
    for row in sums.collect():
        out[row["chunk"]] = row["counts"]
    return out.ravel()[:s.buckets]


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of the smoothed shares) for each bucket, in doubles."""
    n, all_s, all_t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_s + n) / ((s + 1.0) * (all_t + n))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weighted(docs: DataFrame, target: DataFrame, s: Settings) -> DataFrame:
    """(id, mark, n_words, n_features, weight) of each row; ``target`` has a column text."""
    gains = bucket_gains(bucket_counts(marked(docs).select("text"), s),
                         bucket_counts(target.select(F.coalesce("text", F.lit("")).alias("text")), s))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in steps(batches):
            f = Features(data, offsets, s)
            number, weight = f.sums(gains)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("mark"), pa.array(f.n_words.astype(np.int64)), pa.array(number),
                 pa.array(weight)], ["id", "mark", "n_words", "n_features", "weight"])

    return marked(docs).mapInArrow(run, "id bigint, mark binary, n_words bigint, n_features bigint, weight bigint")


def resample(docs: DataFrame, target: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank, mark): documents drawn to look like ``target``.

    Features are all runs of one to ``longest`` words of the lower-cased (A-Z) text, repeats counted, hashed by CRC-32.
    ``weight`` adds up each feature's gain: how much likelier its bucket is in the target than in ``docs``. A Gumbel
    value keyed by the doc_id turns it into ``score``; the highest ``percent`` of the documents with ``least_words``
    are the draw, numbered by ``rank``, ties to the smaller doc_id. The others have no rank.

    Null and empty texts have no features, weight 0, and are never drawn. A null doc_id draws with the key of the empty
    text and sorts last. Repeated rows are documents of their own: equal scores, ranks next to each other. An empty
    table gives an empty result, an empty target lets all gains come from ``docs`` alone; other columns are ignored.
    Both tables are read whole, ``docs`` twice; neither texts nor n-grams are shuffled, and the ranks come from
    totals of quantile slices.
    """
    s = settings or Settings()
    draw = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{s.seed}:"), F.coalesce(doc_id().cast("string"), F.lit(""))), 256),
                              1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((draw + 0.5) / 4294967296.0)))
    scored = saved(weighted(docs, target, s).withColumn("score", F.col("weight") + gumbel), "importance")
    enough = F.col("n_words") >= s.least_words
    limit = s.percent * scored.filter(enough).count() // 100
    ranked = running(scored.filter(enough).withColumn("down", -F.col("score")), "down", sums={"before": F.lit(1)},
                     ties=("id",), inclusive=False)
    ranked = ranked.withColumn("rank", F.when(F.col("before") < limit, F.col("before") + 1))
    names = ["n_words", "n_features", "weight", "score"]
    out = ranked.select("id", *names, "rank", "mark").unionByName(
        scored.filter(~enough).select("id", *names, F.lit(None).cast("bigint").alias("rank"), "mark"))
    return out.select(doc_id(), *names, F.col("rank").cast("bigint").alias("rank"), "mark")


def drawn(docs: DataFrame, resampled: DataFrame) -> DataFrame:
    """(doc_id, text, rank) of the drawn documents of :func:`resample`."""
    picked = resampled.filter("rank is not null").select(
        F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), "mark", "rank")
    texts = marked(docs).dropDuplicates(["id", "mark"])
    return picked.join(texts, ["id", "mark"]).select(doc_id(), "text", "rank")


SQL = r"""with recursive crc(i, k, c) as (
  select i, 0, i::bigint from range(256) t(i)
  union all select i, k + 1, case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from crc where k < 8),
tab as materialized (select list(c order by i) t from crc where k = 8),
w as materialized (
  select kind, id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws
  from (select 's' kind, doc_id id, text from documents union all select 't', item_id, text from benchmark)),
g as materialized (
  select kind, id, array_to_string(ws[i:i+n-1], ' ') gram
  from (select *, unnest(range(1, len(ws) - n + 2)) i from w cross join (select unnest([1, 2, 3]) n))),
b as materialized (
  select gram, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(octet_length(encode(gram))),
      lambda i: ('0x' || substr(hex(encode(gram)), (2*i + 1)::int, 2))::bigint)),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 bucket
  from (select distinct gram from g) cross join tab),
h as materialized (
  select bucket, count(*) filter (kind = 's') s, count(*) filter (kind = 't') t
  from g join b using (gram) group by bucket),
gain as materialized (
  select bucket, floor(1000*ln((t + 1)::double * (sum(s) over () + 10000)::double
                               / ((s + 1)::double * (sum(t) over () + 10000)::double)))::bigint gain from h),
d as (
  select id, count(*) n_features, sum(gain)::bigint weight
  from g join b using (gram) join gain using (bucket) where kind = 's' group by id),
f as (
  select id doc_id, coalesce(n_features, 0) n_features, coalesce(weight, 0) weight, coalesce(weight, 0) + floor(
      -1000*ln(-ln((('0x' || substr(sha256('42:' || id), 1, 8))::bigint + 0.5::double)/4294967296)))::bigint score,
    len(ws) >= 20 enough
  from w left join d using (id) where kind = 's'),
r as (select *, row_number() over (partition by enough order by score desc, doc_id) "rank" from f)
select doc_id, n_features, weight, score,
  case when enough and "rank" <= 5 * (select count(*) from f where enough) // 100 then "rank" end "rank" from r"""


def query(spark, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resample(documents(spark, sf_dir), target).select("doc_id", "n_features", "weight", "score", "rank")
