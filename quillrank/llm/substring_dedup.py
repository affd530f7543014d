"""Repeated passages across documents, found by recompression: runs and pairs of words become symbols."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, doc_id, documents, join_sized, rows, saved
from .words import fingerprints, mix, powers, spans, steps

#: Rounds of recompression. After two, a symbol spans up to four words (runs apart) and its form depends on three
#: words on either side, so that every window of 20 words has symbols whose form it determines.
ROUNDS = 2


class Symbols(NamedTuple):
    name: np.ndarray   # equal word sequences in equal surroundings get equal names
    start: np.ndarray  # first word
    low: np.ndarray    # the words low to high determine that this symbol stands here
    high: np.ndarray


def _firsts(n: int, bounds: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Marks the symbols with which a text begins."""
    out = np.zeros(n, bool)
    at = np.searchsorted(start, bounds[:-1][bounds[1:] > bounds[:-1]])
    out[at] = True
    return out


def _before(low: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``low`` of the symbol before each place; there is none before the first."""
    return np.where(at > 0, low[at - 1], -1)


def _after(high: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.where(at + 1 < len(high), high[np.minimum(at + 1, len(high) - 1)], high[-1] + 1)


def runs(s: Symbols, bounds: np.ndarray) -> Symbols:
    """Block compression: a run of one symbol becomes one symbol named by it and the run's length."""
    n = len(s.name)
    new = np.r_[True, s.name[1:] != s.name[:-1]] | _firsts(n, bounds, s.start)
    at = np.flatnonzero(new)
    length = np.diff(np.r_[at, n])
    last = at + length - 1
    long = length > 1
    name = s.name[at]
    name[long] = mix(name[long] + length[long].astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    # where a run ends, one of a single symbol too, is known from the symbols beside it
    return Symbols(name, s.start[at], _before(s.low, at), _after(s.high, last))


def pairs(s: Symbols, bounds: np.ndarray, level: int) -> Symbols:
    """Pair compression: each symbol falls to the left or right half of the alphabet by its name; a left one
    followed by a right one becomes one symbol. The halves are disjoint, so no choice of pairs is left open."""
    n = len(s.name)
    first = _firsts(n, bounds, s.start)
    side = (mix(s.name + np.uint64(level)) >> np.uint64(63)).astype(bool)
    head = np.zeros(n, bool)
    head[:-1] = ~side[:-1] & side[1:] & ~first[1:]
    tail = np.r_[False, head[:-1]]
    # a single symbol is known to be one from the symbols beside it; a pair ends with its second symbol
    every = np.arange(n)
    low = np.where(head, s.low, _before(s.low, every))
    high = _after(s.high, every)
    name = s.name.copy()
    name[head] = mix(s.name[head] * np.uint64(0x9E3779B97F4A7C15) + mix(s.name[1:][head[:-1]]))
    keep = ~tail
    return Symbols(name[keep], s.start[keep], low[keep], high[keep])


def recompress(codes: np.ndarray, bounds: np.ndarray) -> Symbols:
    """The symbols of all texts after ``ROUNDS`` rounds; ``codes`` are the words' fingerprints.

    Names are fingerprints of what a symbol stands for, so tasks that never meet give equal substrings equal names.
    What a symbol at an end of a text depends on reaches beyond the text: no window contains it.
    """
    place = np.arange(len(codes))
    s = Symbols(codes, place, place, place + 1)
    for level in range(ROUNDS):
        s = pairs(runs(s, bounds), bounds, level)
    # the neighbours of a text's end lie in another text: push those bounds out of every window
    text = np.searchsorted(bounds, s.start, "right") - 1
    outside = (s.low < bounds[text]) | (s.high > bounds[text + 1])
    first = _firsts(len(s.name), bounds, s.start)
    edge = outside | first | np.r_[first[1:], True][:len(first)]
    return Symbols(s.name, s.start, np.where(edge, -1, s.low), np.where(edge, len(codes) + 1, s.high))


def sums_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums from which ``between`` takes the fingerprint of any stretch of words."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(_BASE, len(codes)), out=out[1:])
    return out, powers(pow(_BASE, -1, 1 << 64), len(codes) + 1)


_BASE = 0xD1342543DE82EF95


def between(sums: tuple[np.ndarray, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix((sums[0][b] - sums[0][a]) * sums[1][a] + (b - a).astype(np.uint64))


def anchors(codes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first, last): stretches of windows (by their first word) that share an anchor, and its fingerprint.

    A window's anchor is, of the symbols that it determines, the one of least name (the leftmost of equals), so
    equal windows have equal anchors at equal places. A window that determines none, such as one inside a long run
    of a word, is its own anchor. Keys are fingerprints of the words that determine the anchor.
    """
    starts = _window_starts(bounds, size)
    none = np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64), none, none
    s = recompress(codes, bounds)
    inner = np.flatnonzero(s.low >= 0)
    sums = sums_of(codes)
    a = np.searchsorted(s.low[inner], starts)  # low and high ascend
    b = np.searchsorted(s.high[inner], starts + size, "right")
    own = a >= b
    pick = np.full(len(starts), -1, np.int64)
    some = ~own
    if some.any():
        pick[some] = _least(s.name[inner], a[some], b[some])
    # windows beside each other with one anchor are one stretch
    change = np.r_[True, (pick[1:] != pick[:-1]) | own[1:] | (starts[1:] != starts[:-1] + 1)]
    at = np.flatnonzero(change)
    first, last = starts[at], starts[np.r_[at[1:], len(starts)] - 1]
    symbol = inner[np.maximum(pick[at], 0)] if len(inner) else np.zeros(len(at), np.int64)
    alone = own[at]
    low = np.where(alone, first, s.low[symbol])
    high = np.where(alone, first + size, s.high[symbol])
    return between(sums, low, high), first, last


def _window_starts(bounds: np.ndarray, size: int) -> np.ndarray:
    n = np.maximum(np.diff(bounds) - size + 1, 0)
    ends = np.cumsum(n)
    return np.repeat(bounds[:-1] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)


def _least(name: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The place of the least name in each range a..b, the leftmost of equals, by doubling ranges."""
    out = np.empty(len(a), np.int64)
    best, span = np.arange(len(name)), 1
    length = b - a
    while True:
        now = np.flatnonzero((length >= span) & (length < 2 * span))
        if len(now):
            x, y = best[a[now]], best[b[now] - span]
            out[now] = np.where(name[y] < name[x], y, x)
        if 2 * span > length.max():
            return out
        x, y = best[:len(best) - span], best[span:]
        best = np.where(name[y] < name[x], y, x)
        span *= 2


def placed(docs: DataFrame) -> DataFrame:
    """(id, mark, text); ``mark``, a short hash of the text, tells texts apart that share a doc_id."""
    return rows(docs).select("id", F.hash("text").alias("mark"), "text")


def symbol_table(docs: DataFrame, size: int) -> DataFrame:
    """(id, mark, words, keys, first, length) of each text of at least ``size`` words: its anchors' stretches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in steps(batches):
            starts, ends, bounds = spans(data, offsets)
            codes = fingerprints(data, starts, ends)
            key, first, last = anchors(codes, bounds, size)
            at = np.searchsorted(first, bounds)
            local = (first - np.repeat(bounds[:-1], np.diff(at))).astype(np.int32)
            long = np.flatnonzero(np.diff(bounds) >= size)
            raw = codes.tobytes()
            digests = [hashlib.sha256(raw[8 * bounds[i]:8 * bounds[i + 1]]).digest() for i in long]
            lists = [pa.ListArray.from_arrays(pa.array(np.r_[at[long], at[-1]].astype(np.int32)), pa.array(x))
                     for x in (key.view(np.int64), local, (last - first + 1).astype(np.int32))]
            picked = batch.take(pa.array(long))
            yield pa.RecordBatch.from_arrays(
                [picked.column("id"), picked.column("mark"), pa.array(digests, pa.binary()), *lists],
                ["id", "mark", "words", "keys", "first", "length"])

    return placed(docs).mapInArrow(
        run, "id bigint, mark int, words binary, keys array<bigint>, first array<int>, length array<int>")


def content_table(docs: DataFrame, stretches: DataFrame, size: int) -> DataFrame:
    """(key, content, id, mark, first, length, windows) of the given stretches of each text.

    ``content`` is the fingerprint of all words of the stretch, ``windows`` has those of its windows, 8 bytes each.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in steps(batches):
            starts, ends, bounds = spans(data, offsets)
            sums = sums_of(fingerprints(data, starts, ends))
            row, first, length, key = _stretches_of(batch)
            place, total = first + bounds[row], np.r_[0, np.cumsum(length)]
            start = np.repeat(place - total[:-1], length) + np.arange(total[-1])
            raw = between(sums, start, start + size).tobytes()
            windows = [raw[8 * a:8 * b] for a, b in zip(total[:-1].tolist(), total[1:].tolist())]
            content = between(sums, place, place + length + size - 1)
            picked = batch.select(["id", "mark"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(content.view(np.int64)), picked.column("id"), picked.column("mark"),
                 pa.array(first.astype(np.int32)), pa.array(length.astype(np.int32)), pa.array(windows, pa.binary())],
                ["key", "content", "id", "mark", "first", "length", "windows"])

    both = placed(docs).join(stretches, ["id", "mark"]).select("id", "mark", "text", "stretches")
    return both.mapInArrow(run, "key bigint, content bigint, id bigint, mark int, first int, length int, windows binary")


def _stretches_of(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    column = batch.column("stretches")
    flat = column.flatten()
    row = np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))
    return (row, *(flat.field(n).to_numpy().astype(np.int64) for n in ("first", "length", "key")))


def first_places(contents: DataFrame) -> DataFrame:
    """(key, content, firsts): where each window of the given contents stands first, in the order of the windows.

    Only for anchors with several contents: a window that stands twice has one anchor, so with one content its
    first place follows from the content's.
    """
    size = F.octet_length("windows")
    codes = F.transform(F.sequence(F.lit(1), (size / 8).cast("int")), lambda k: F.substring("windows", k * 8 - 7, F.lit(8)))
    flat = contents.select("key", "content", "owner", F.posexplode(codes).alias("k", "code"))
    here = F.struct(F.col("owner.id").alias("id"), F.col("owner.mark").alias("mark"), (F.col("owner.first") + F.col("k")).alias("first"))
    flat = saved(flat.select("key", "content", "k", "code", here.alias("here")), "repeat-windows")
    least = flat.groupBy("key", "code").agg(F.min("here").alias("here"))
    return (flat.drop("here").join(least, ["key", "code"]).groupBy("key", "content")
            .agg(F.array_sort(F.collect_list(F.struct("k", "here"))).alias("w"))
            .select("key", "content", F.col("w.here").alias("firsts")))


def kept_texts(docs: DataFrame, gone: DataFrame, size: int) -> DataFrame:
    """(id, n_words, n_removed, kept) of each row; ``gone`` has the covering windows of a text, or all of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in steps(batches):
            starts, ends, bounds = spans(data, offsets)
            edge = np.zeros(len(starts) + 1, np.int64)
            column = batch.column("pos")
            pos = column.flatten().to_numpy().astype(np.int64)
            sizes = np.diff(column.offsets.to_numpy())
            place = pos + np.repeat(bounds[:-1], sizes)
            np.add.at(edge, place, 1)
            np.add.at(edge, place + size, -1)
            for i in np.flatnonzero(batch.column("whole").to_numpy(zero_copy_only=False)):
                edge[bounds[i]] += 1
                edge[bounds[i + 1]] -= 1
            keep = np.cumsum(edge[:-1]) == 0
            raw, s, e = data.tobytes(), starts[keep].tolist(), ends[keep].tolist()
            at = np.r_[0, np.cumsum(keep)][bounds]
            texts = [b" ".join([raw[s[k]:e[k]] for k in range(a, b)]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            n = np.diff(bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n), pa.array(n - np.diff(at)), pa.array(texts, pa.binary()).cast(pa.string())],
                ["id", "n_words", "n_removed", "kept"])

    both = placed(docs).join(gone, ["id", "mark"], "left").select(
        "id", "text", F.coalesce("pos", F.array().cast("array<int>")).alias("pos"),
        F.coalesce("whole", F.lit(False)).alias("whole"))
    return both.mapInArrow(run, "id bigint, n_words bigint, n_removed bigint, kept string")


def substring_dedup(docs: DataFrame, size: int = 20) -> DataFrame:
    """(doc_id, n_words, n_removed, kept), one row for each row of ``docs``.

    A word goes if a window of ``size`` words that covers it also starts earlier: in a smaller doc_id, or before in
    the same document. Windows are judged on the input. ``kept`` joins the words that stay by single spaces. Null
    and empty texts have no words. Equal rows are one document; texts that differ under one doc_id are
    compared in the order of a hash. A null doc_id counts as the largest; an empty table gives an empty result; other columns are ignored.

    1. Recompression names runs and pairs of words; each stretch of windows is known by an anchor symbol.
    2. Copies of a whole text leave at once, but for the smallest doc_id.
    3. Spark counts anchors; only stretches whose anchor stands elsewhere too go on.
    4. Stretches are compared as a whole. Where an anchor has different contents, each window of each content is held
       against the first place that it has in any.

    Tables that are no longer needed are deleted on the way.
    """
    table = saved(symbol_table(docs, size), "repeat-symbols")
    total = table.count()
    groups = saved(table.groupBy("words").agg(F.min(F.struct("id", "mark")).alias("owner"), F.count("*").alias("rows"))
                   .filter("rows > 1"), "repeat-copies")
    whole = saved(join_sized(table.select("id", "mark", "words"), groups, ["words"], "rows", total)
                  .filter("id <> owner.id").select("id", "mark").distinct(), "repeat-whole")
    single = table.join(whole, ["id", "mark"], "left_anti").drop("words").dropDuplicates(["id", "mark"])
    flat = saved(single.select("id", "mark", F.inline(F.arrays_zip("keys", "first", "length")))
                 .withColumnRenamed("keys", "key"), "repeat-anchors")
    discard(table, groups)
    # an anchor twice in one text counts too: rows are counted, not documents
    common = saved(flat.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1"), "repeat-common")
    part = saved(join_sized(flat, common, ["key"], "rows", flat.count()).groupBy("id", "mark").agg(
        F.collect_list(F.struct("first", "length", "key")).alias("stretches")), "repeat-stretches")
    discard(flat, common)
    found = saved(content_table(docs, part, size), "repeat-contents")
    discard(part)
    contents = saved(found.groupBy("key", "content").agg(
        F.min(F.struct("id", "mark", "first")).alias("owner"), F.count("*").alias("rows"),
        F.min("windows").alias("windows")), "repeat-owners")
    several = contents.groupBy("key").agg(F.count("*").alias("contents")).filter("contents > 1").select("key")
    firsts = first_places(contents.join(several, "key"))
    settled = saved(contents.select("key", "content", "owner", "rows").join(firsts, ["key", "content"], "left"), "repeat-firsts")
    here = lambda k: F.struct("id", "mark", (F.col("first") + k).alias("first"))
    places = F.sequence(F.lit(0), F.col("length") - 1)
    gone = F.when(F.col("firsts").isNull(), F.when(F.col("owner") < here(F.lit(0)), places)).otherwise(
        F.filter(places, lambda k: F.get("firsts", k) < here(k)))
    later = (join_sized(found.drop("windows"), settled, ["key", "content"], "rows", found.count())
             .select("id", "mark", F.transform(gone, lambda k: F.col("first") + k).alias("pos")).filter(F.size("pos") > 0)
             .groupBy("id", "mark").agg(F.flatten(F.collect_list("pos")).alias("pos")))
    later = saved(later, "repeat-gone")
    discard(found, contents, settled)
    gone = (later.withColumn("whole", F.lit(False))
            .unionByName(whole.withColumn("pos", F.array().cast("array<int>")).withColumn("whole", F.lit(True))))
    return kept_texts(docs, gone, size).select(doc_id(), "n_words", "n_removed", "kept")


SQL = r"""with w as materialized (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') ws from documents),
windows as materialized (
  select doc_id, s, md5(array_to_string(ws[s:s + 19], ' ')) h
  from (select doc_id, ws, unnest(range(1, len(ws) - 18)) s from w where len(ws) >= 20)),
later as (
  select doc_id, s from windows
  qualify row_number() over (partition by h order by doc_id, s) > 1),
gone as (select distinct doc_id, unnest(range(s, s + 20)) p from later),
words as (select doc_id, unnest(ws) word, generate_subscripts(ws, 1) p from w),
kept as (
  select doc_id, string_agg(word, ' ' order by p) kept, count(*) n
  from words anti join gone using (doc_id, p) group by doc_id)
select doc_id, len(ws)::bigint n_words, len(ws)::bigint - coalesce(n, 0) n_removed, sha256(coalesce(kept, '')) kept_sha256
from w left join kept using (doc_id)"""


def query(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
