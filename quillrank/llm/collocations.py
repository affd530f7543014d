"""Phrase collocations: mergeable Misra-Gries summaries keep every frequent n-gram, a second pass counts exactly."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, saved
from .ngrams import Interned, Words, class_mask, word_spans, xxhash64
from .words import LOWERED, mix, steps

U64 = np.uint64
BLANK = class_mask((0x09, 0x09), (0x20, 0x20))
#: Bytes that end a piece: . , ; : ! ? and U+000A to U+000D.
STOP = class_mask((0x0A, 0x0D), (0x21, 0x21), (0x2C, 0x2C), (0x2E, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F))
WORD = ~(BLANK | STOP)


class Settings(NamedTuple):
    longest: int = 5                 # words in a phrase
    least: int = 100                 # occurrences of a candidate
    top: int = 2000                  # rows of each language
    part_bytes: int = 16 << 20       # text for which there is one hash partition
    most_parts: int = 16_384
    flush: int = 4 << 20             # n-grams that one summary of a task covers
    blob: int = 32 << 10             # entries in one row of a summary
    filter_bytes: int = 64 << 20     # most that the filter of surviving n-grams takes; a fuller one lets more through


class Phrases:
    """Words of some texts as hashes, with the language of each and the number of words up to the end of its piece."""

    def __init__(self, batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray):
        self.data = LOWERED[data]
        self.starts, self.ends, bounds = word_spans(self.data, offsets, WORD)
        n = len(self.starts)
        self.words = Words(self.data, self.starts, self.ends)
        place = np.arange(n)
        at, size = self.words.runs(place, 1)
        self.code = xxhash64(self.words.buffer, at, size)
        stops = np.r_[0, np.cumsum(STOP[self.data])][self.starts]
        begins = np.ones(n, bool)
        begins[1:] = stops[1:] != stops[:-1]
        begins[bounds[:-1][bounds[:-1] < n]] = True
        border = np.r_[np.flatnonzero(begins), n]
        self.left = border[np.searchsorted(border, place, "right")] - place if n else place
        langs = batch.column("lang").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.lang = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(bounds)).astype(np.int64)
        self.salt = np.array([xxhash.xxh64_intdigest(x) for x in self.langs], U64)

    def grams(self, n: int, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(first words, hashes) of the runs of ``n`` words inside a piece, of all of them or those ``allowed``."""
        first = np.flatnonzero((self.left >= n) if allowed is None else (self.left >= n) & allowed)
        h = self.salt[self.lang[first]] + U64(n)
        for k in range(n):
            h = mix(h * U64(0x9E3779B97F4A7C15) + self.code[first + k])
        return first, h


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> U64(32)) * U64(parts)) >> U64(32)


class Filter:
    """Bits of the n-grams that may be frequent, a segment for each hash partition. No frequent one is missing."""

    def __init__(self, segments: list[tuple[int, int, bytes]], parts: int):
        self.width = np.zeros(parts, U64)
        self.start = np.zeros(parts, np.int64)
        bits, total = [], 0
        for part, width, content in segments:
            self.width[part], self.start[part] = width, total
            bits.append(np.frombuffer(content, np.uint8))
            total += len(bits[-1]) * 8
        self.bits = np.concatenate([*bits, np.zeros(1, np.uint8)])

    @staticmethod
    def places(low: np.ndarray, width) -> Iterator[np.ndarray]:
        x = mix(low + U64(1))
        for _ in range(3):
            yield (x >> (U64(64) - U64(width))).astype(np.int64)
            x = x * U64(0x9E3779B97F4A7C15)

    @classmethod
    def segment(cls, low: np.ndarray, most_bytes: int) -> tuple[int, bytes]:
        """(width, content) of a segment with 2**width bits, about 12 bits or more for each n-gram."""
        width = max(3, min(int(12 * len(low)).bit_length(), int(most_bytes * 8).bit_length() - 1))
        on = np.zeros(1 << width, bool)
        for at in cls.places(low, width):
            on[at] = True
        return width, np.packbits(on).tobytes()

    def has(self, h: np.ndarray) -> np.ndarray:
        part = part_of(h, len(self.width)).astype(np.int64)
        width, start = self.width[part], self.start[part]
        found = width > 0
        for at in self.places(h & U64(0xFFFFFFFF), np.maximum(width, U64(1))):
            at = np.where(found, at + start, 0)
            found &= (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        return found


def texts(docs: DataFrame) -> DataFrame:
    """(lang, text): null languages become ``und``, null texts empty."""
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce("text", F.lit("")).alias("text"))


def summaries(docs: DataFrame, sizes: range, pairs, parts: int, s: Settings) -> DataFrame:
    """(part, kind, mass, keys, counts): summaries of the n-grams of each task, hashed into ``parts``.

    ``pairs``, if given, is the broadcast filter of the pairs of words that may be frequent; an n-gram with another
    pair in it is left out, as it cannot be frequent. Kind 0 has the occurrences that the rows of kind 1 stand for.
    """
    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h = np.concatenate(held)
        key, count = np.unique((part_of(h, parts) << U64(32)) | (h & U64(0xFFFFFFFF)), return_counts=True)
        part = (key >> U64(32)).astype(np.int64)
        own, first = np.unique(part, return_index=True)
        mass = np.add.reduceat(count, first)
        low, count = (key & U64(0xFFFFFFFF)).astype("<u4"), count.astype("<u4")
        rows = [(p, 0, m, None, None) for p, m in zip(own.tolist(), mass.tolist())]
        for p, a, b in zip(own.tolist(), first.tolist(), [*first[1:].tolist(), len(key)]):
            rows += [(p, 1, 0, low[k:min(k + s.blob, b)].tobytes(), count[k:min(k + s.blob, b)].tobytes())
                     for k in range(a, b, s.blob)]
        for k in range(0, len(rows), 256):
            yield pa.RecordBatch.from_pylist([dict(zip(("part", "kind", "mass", "keys", "counts"), r)) for r in rows[k:k + 256]],
                                             schema=pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("mass", pa.int64()),
                                                               ("keys", pa.binary()), ("counts", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch, data, offsets in steps(batches):
            p = Phrases(batch, data, offsets)
            usual = None
            if pairs is not None:
                first, h = p.grams(2)
                usual = np.zeros(len(p.starts) + 8, bool)
                usual[first] = pairs.value.has(h)
            for n in sizes:
                allowed = None if usual is None else np.logical_and.reduce([usual[k:k + len(p.starts)] for k in range(n - 1)])
                h = p.grams(n, allowed)[1]
                held.append(h)
                total += len(h)
            if total >= s.flush:
                yield from flush(held)
                held, total = [], 0
        if total:
            yield from flush(held)

    return texts(docs).mapInArrow(run, "part int, kind int, mass bigint, keys binary, counts binary")


class Summary:
    """Misra-Gries counters, at most ``capacity`` of them. ``lost`` bounds what any n-gram's counter lacks."""

    def __init__(self, capacity: int):
        self.capacity, self.lost, self.waiting = capacity, 0, 0
        self.keys, self.counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys), self.counts.append(counts)
        self.waiting += len(keys)
        if self.waiting > max(1 << 20, self.capacity):
            self.merge()

    def merge(self) -> Summary:
        """Adds up what waits; beyond the capacity, all counters fall by the largest one that has no room."""
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts).astype(np.int64)
        keys, place = np.unique(keys, return_inverse=True)
        counts = np.bincount(place, counts, len(keys)).astype(np.int64)
        if len(keys) > self.capacity:
            fall = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            self.lost += fall
            keys, counts = keys[counts > fall], counts[counts > fall] - fall
        self.keys, self.counts, self.waiting = [keys], [counts], 0
        return self


def survivors(parts_of: DataFrame, parts: int, s: Settings) -> Filter:
    """Merges the summaries of each partition and keeps the n-grams that may have ``least`` occurrences.

    A partition of mass m gets more than m / least counters, so no counter lacks ``least``: whatever is that frequent
    is still there. The rows of kind 0 come first and tell the mass; the blobs stream behind them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = None, 0, None

        def result() -> pa.RecordBatch:
            summary.merge()
            low = summary.keys[0][summary.counts[0] + summary.lost >= s.least]
            width, content = Filter.segment(low.astype(U64), max(1, s.filter_bytes // parts))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([width], pa.int32()),
                                               pa.array([content], pa.binary())], ["part", "width", "content"])

        for batch in batches:
            for p, kind, m, keys, counts in zip(*(batch.column(c) for c in ("part", "kind", "mass", "keys", "counts"))):
                if p.as_py() != part:
                    if summary is not None:
                        yield result()
                    part, mass, summary = p.as_py(), 0, None
                if kind.as_py() == 0:
                    mass += m.as_py()
                    continue
                if summary is None:
                    summary = Summary(mass // s.least + 1)
                summary.add(np.frombuffer(keys.as_buffer(), "<u4"), np.frombuffer(counts.as_buffer(), "<u4"))
        if summary is not None:
            yield result()

    found = (parts_of.repartition(parts, "part").sortWithinPartitions("part", "kind")
             .mapInArrow(run, "part int, width int, content binary"))
    return Filter([tuple(r) for r in found.collect()], parts)


def exact_counts(docs: DataFrame, filters, s: Settings) -> DataFrame:
    """(lang, phrase, size, f) of the phrases that pass the filters; the row without phrase counts all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in steps(batches):
            p = Phrases(batch, data, offsets)
            first, size = [], []
            for n in range(1, s.longest + 1):
                at, h = p.grams(n)
                at = at[(filters.value[0] if n <= 2 else filters.value[1]).has(h)]
                first.append(at), size.append(np.full(len(at), n))
            first, size = np.concatenate(first), np.concatenate(size)
            begin, length = p.words.runs(first, size)
            table = Interned(p.words.buffer, begin, length)
            key, count = np.unique(p.lang[first] * (len(table.owner) + 1) + table.slot, return_counts=True)
            lang, slot = key // (len(table.owner) + 1), key % (len(table.owner) + 1)
            own = table.owner[slot]
            raw = p.words.buffer.tobytes()
            phrase = [raw[a:a + b].decode() for a, b in zip(begin[own].tolist(), length[own].tolist())]
            words = np.bincount(p.lang, minlength=len(p.langs))
            names = [p.langs[x] for x in lang.tolist()] + p.langs
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(phrase + [None] * len(p.langs), pa.string()),
                 pa.array(np.r_[size[own], np.zeros(len(p.langs), np.int64)].astype(np.int32)),
                 pa.array(np.r_[count, words].astype(np.int64))], ["lang", "phrase", "size", "f"])

    found = texts(docs).mapInArrow(run, "lang string, phrase string, size int, f bigint")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).filter(
        (F.col("f") >= s.least) | F.col("phrase").isNull())


def frequent(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(lang, phrase, size, f): every run of one to ``longest`` words inside a piece with ``least`` occurrences or more.

    Rows without phrase have size 0 and all words of the language.
    """
    s = settings or Settings()
    sc = docs.sparkSession.sparkContext
    volume = texts(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, min(s.most_parts, -(-volume // s.part_bytes)))
    short = survivors(summaries(docs, range(1, 3), None, parts, s), parts, s)
    pairs = sc.broadcast(short)
    long = survivors(summaries(docs, range(3, s.longest + 1), pairs, parts, s), parts, s)
    counted = saved(exact_counts(docs, sc.broadcast((short, long)), s), "phrases")
    return counted


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(17,0)")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates, each by its lowest-scoring cut, smaller first part on ties.

    The product of three counts passes 64 bits, so it is divided as a decimal of 38 digits.
    """
    own = counts.filter("phrase is not null")
    n = counts.filter("phrase is null").select("lang", F.col("f").alias("n"))
    words = F.split("phrase", " ", -1)
    cuts = own.filter("size > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "k", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"))
    both = (cuts.join(own.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
            .join(own.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
            .join(n, "lang"))
    product = F.lit(1000).cast("decimal(4,0)") * _exact("a") * _exact("n")
    both = both.withColumn("product", product).withColumn("parts", _exact("l") * _exact("r"))
    each = both.withColumn("score", F.expr("product div parts"))
    least = each.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x"))
    return least.select("lang", "phrase", "x.a", "x.l", "x.r", "x.n", "x.score")


def outside(counts: DataFrame) -> DataFrame:
    """(lang, phrase) of the candidates that lie in no longer candidate found as often."""
    own = counts.filter("size > 1")
    words = F.split("phrase", " ", -1)
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))))
    covered = (own.filter("size > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("f").alias("longer"))
               .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    return (own.join(covered, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < 100 * F.col("f")))
            .select("lang", "phrase"))


def collocations(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of each language whose words belong together most.

    Texts are lower-cased (A-Z), cut into pieces at . , ; : ! ? and line ends, and these into words at blanks and
    tabs. A candidate is a run of two to ``longest`` words inside a piece with a >= ``least`` occurrences. Its score is
    floor(1000 a n / (l r)) for the cut that scores lowest. Candidates within a longer one that is found as often are
    left out; ``top`` others are ranked by score, a and phrase (UTF-8 order).

    Null texts are empty and a null lang is ``und``; ids do not matter, so repeated rows count each time. Texts
    without words add nothing, an empty table gives an empty result, other columns are ignored.

    Three passes read the texts: one summarises words and pairs, one the runs of three words or more whose pairs may
    be frequent, the last counts what survived. Summaries travel as hashes, so a hot n-gram is one entry a task;
    hash collisions let a rare phrase survive but never drop one, and the last pass counts by bytes.
    """
    s = settings or Settings()
    counts = frequent(docs, s)
    rows = scored(counts).join(outside(counts), ["lang", "phrase"])
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # best of each share of a language first, so that no task sorts a whole language
    rows = rows.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    some = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).filter(F.col("rank") <= s.top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return best.filter(F.col("rank") <= s.top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""with p as materialized (
  select coalesce(lang, 'und') lang, regexp_extract_all(piece, '[^\x20\x09]+') ws
  from (select lang, unnest(string_split_regex(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) piece from documents)),
total as materialized (select lang, sum(len(ws))::bigint n from p group by lang),
f as materialized (
  select lang, size, array_to_string(ws[i:i+size-1], ' ') phrase, count(*) f
  from (select *, unnest(range(1, len(ws) - size + 2)) i from p cross join (select unnest(range(1, 6)) size))
  group by all having count(*) >= 100),
c as materialized (select *, string_split(phrase, ' ') ws from f where size > 1),
cut as (
  select c.lang, c.phrase, c.f a, k, x.f l, y.f r, n, (1000::hugeint * c.f * n) // (x.f::hugeint * y.f) score
  from (select *, unnest(range(1, size)) k from c) c join total using (lang)
  join f x on x.lang = c.lang and x.phrase = array_to_string(c.ws[1:k], ' ')
  join f y on y.lang = c.lang and y.phrase = array_to_string(c.ws[k+1:], ' ')),
best as (select * from cut qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_of as (
  select lang, phrase, max(f) longer
  from (select lang, f, array_to_string(ws[i:i+m-1], ' ') phrase
        from (select *, unnest(range(1, size - m + 2)) i from (select *, unnest(range(2, size)) m from c where size > 2)))
  group by 1, 2),
r as (
  select best.*, row_number() over (partition by lang order by score desc, a desc, phrase) "rank"
  from best left join inner_of using (lang, phrase) where longer is null or 100 * longer < 100 * a)
select lang, "rank", phrase, a, l, r, n, score::bigint score from r where "rank" <= 2000"""


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))
