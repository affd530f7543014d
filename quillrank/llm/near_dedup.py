"""Near duplicates: MinHash bands, sequential Bayesian pruning of candidates, exact verification."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import NO_ID, discard, doc_id, documents, join_sized, marked, saved
from .words import BLANK, LOWERED, fingerprints, mix, spans, steps, windows


class Settings(NamedTuple):
    words: int = 5            # in a shingle
    similarity: int = 85      # percent of the union that linked sets share at least
    bands: int = 25
    width: int = 5            # hashes in a band; at the similarity, all bands differ with probability 4e-7
    batch: int = 25           # hashes that one step of the sequential test compares
    miss: float = 1e-6        # posterior probability at which a candidate is given up
    growth: int = 8           # by which the pivots of a bucket grow from round to round
    bits: int = 2048          # of the map that bounds what two sets can share, a power of two

    @property
    def hashes(self) -> int:
        return self.bands * self.width


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed coefficients of n hash functions modulo 2**32, odd ones to multiply and others to add."""
    bits = mix(np.arange(1, 2 * n + 1, dtype=np.uint64))
    return (bits[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (bits[n:] >> np.uint64(32)).astype(np.uint32)


def signatures(shingles: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """MinHash of each non-empty slice of ``shingles``: uint32 of shape (slices, n)."""
    out = np.empty((len(bounds) - 1, n), np.uint32)
    scale, shift = _multipliers(n)
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    first = 0
    while first < len(bounds) - 1:  # blocks that stay in the cache
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + 30_000, "right")) - 1)
        part, at = low[bounds[first]:bounds[last]], bounds[first:last] - bounds[first]
        for k in range(n):
            out[first:last, k] = np.minimum.reduceat(part * scale[k] + shift[k], at)
        first = last
    return out


def sketches(docs: DataFrame, s: Settings) -> DataFrame:
    """(id, mark, digest, n_shingles, signature, keys) of each row.

    ``mark`` is the text's own digest, ``digest`` stands for the whole sequence of words, ``n_shingles`` is the size of the set, ``keys`` has a hash
    for each band; texts without words have no signature and no keys.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(1, s.bands + 1, dtype=np.uint64))
        for batch, data, offsets in steps(batches):
            data = LOWERED[data]
            starts, ends, bounds = spans(data, offsets)
            n_words = np.diff(bounds)
            codes = fingerprints(data, starts, ends)
            window, whole = windows(codes, bounds, s.words)
            # shingles of all texts in order; a text with fewer words is one shingle as a whole
            digests, sets = [], []
            clean = np.where(BLANK[data], 32, data).astype(np.uint8)
            for i in range(len(batch)):
                a, b = bounds[i], bounds[i + 1]
                line = b" ".join(clean[starts[a]:ends[b - 1]].tobytes().split()) if b > a else b""
                digests.append(hashlib.sha256(line).digest())
                if b - a >= s.words:
                    sets.append(np.unique(window[a:b - s.words + 1]))
                else:
                    sets.append(np.frombuffer(digests[-1][:8], np.uint64) if b > a else np.zeros(0, np.uint64))
            sizes = np.array([len(x) for x in sets], np.int64)
            some = np.flatnonzero(sizes)
            sig = signatures(np.concatenate([*sets, np.zeros(0, np.uint64)]), np.r_[0, np.cumsum(sizes[some])], s.hashes)
            bands = sig.reshape(len(some), s.bands, s.width).astype(np.uint64)
            keys = np.broadcast_to(salt, (len(some), s.bands)).copy()
            for k in range(s.width):
                keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k])
            blobs: list[bytes | None] = [None] * len(batch)
            lists: list[np.ndarray | None] = [None] * len(batch)
            for row, i in enumerate(some.tolist()):
                blobs[i], lists[i] = sig[row].tobytes(), keys[row].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("mark"), pa.array(digests, pa.binary()), pa.array(sizes),
                 pa.array(blobs, pa.binary()), pa.array(lists, pa.list_(pa.int64()))],
                ["id", "mark", "digest", "n_shingles", "signature", "keys"])

    return marked(docs).mapInArrow(
        run, "id bigint, mark binary, digest binary, n_shingles bigint, signature binary, keys array<bigint>")


def least_matches(s: Settings) -> list[tuple[int, int]]:
    """(hashes compared, fewest that must agree) after each batch.

    With m of n hashes equal and an even prior, the similarity follows Beta(m+1, n-m+1); its probability to reach
    the threshold is a binomial tail. Fewer matches than the bound leave less than ``miss``.
    """
    t, out = s.similarity / 100, []
    for n in range(s.batch, s.hashes + 1, s.batch):
        def above(m: int, n: int = n) -> float:  # P(similarity >= t) given m of n
            return sum(math.comb(n + 1, j) * t ** j * (1 - t) ** (n + 1 - j) for j in range(m + 1))
        out.append((n, next(m for m in range(n + 1) if above(m) >= s.miss)))
    return out


def bayes_survivors(pairs: DataFrame, sketch: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) that the sequential test of their signatures does not give up."""
    bounds = least_matches(s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(len(batch), s.hashes)
                    for c in ("sa", "sb"))
            alive, matches, done = np.arange(len(batch)), np.zeros(len(batch), np.int64), 0
            for n, least in bounds:
                matches = matches + (x[alive, done:n] == y[alive, done:n]).sum(axis=1)
                passed = matches >= least
                alive, matches, done = alive[passed], matches[passed], n
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(alive)) for c in ("a", "b")], ["a", "b"])

    side = sketch.select("id", "signature")
    both = (pairs.join(side.toDF("a", "sa"), "a").join(side.toDF("b", "sb"), "b").select("a", "b", "sa", "sb"))
    return both.mapInArrow(run, "a bigint, b bigint")


def shingle_set(text: str, words: int) -> frozenset:
    w = text.encode().lower().split()  # bytes: lower() changes A-Z alone, split() knows the six blanks
    return frozenset(zip(*(w[k:] for k in range(words)))) if len(w) >= words else frozenset([tuple(w)] if w else [])


def confirmed(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """The pairs whose full shingle sets are similar enough. Rows come sorted by a, whose set is made once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, frozenset()
        for batch in batches:
            keep = []
            a, ta, tb = (batch.column(c) for c in ("a", "ta", "tb"))
            for i in range(len(batch)):
                if a[i].as_py() != last:
                    last, mine = a[i].as_py(), shingle_set(ta[i].as_py(), s.words)
                other = shingle_set(tb[i].as_py(), s.words)
                common = len(mine & other)
                if common and 100 * common >= s.similarity * (len(mine) + len(other) - common):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")],
                                             ["a", "b"])

    both = pairs.join(texts.toDF("b", "tb"), "b").join(texts.toDF("a", "ta"), "a").select("a", "b", "ta", "tb")
    return both.mapInArrow(run, "a bigint, b bigint")


def bitmaps(texts: DataFrame, s: Settings) -> DataFrame:
    """(id, map): the set's shingles hashed to bits, as 64-bit words.

    Two maps differ in no more bits than their sets do in shingles. Of sets with n and m shingles whose maps differ in
    k bits, at most (n + m - k) / 2 shingles are common.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in steps(batches):
            data = LOWERED[data]
            starts, ends, bounds = spans(data, offsets)
            window, whole = windows(fingerprints(data, starts, ends), bounds, s.words)
            place = np.flatnonzero(whole)
            on = np.zeros((len(batch), s.bits), np.uint8)
            on[np.searchsorted(bounds, place, "right") - 1, (mix(window[place]) >> np.uint64(11)).astype(np.int64) & (s.bits - 1)] = 1
            maps = np.packbits(on, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(list(maps), pa.list_(pa.int64()))], ["id", "map"])

    return texts.mapInArrow(run, "id bigint, map array<bigint>")


def linkable(members: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """(key, id, size, component, u, n): members of buckets without those that no other member can be similar to.

    A document shares at most those shingles with another that more than one member holds: u of its n. With a
    document of m shingles its similarity is u / (n + m - u) at most, and m is at least the smallest of its bucket.
    Copies with many edits of their own and documents around a common passage leave here; no link is lost.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in steps(batches):
            data = LOWERED[data]
            starts, ends, bounds = spans(data, offsets)
            window, _ = windows(fingerprints(data, starts, ends), bounds, s.words)
            sets = [np.unique(window[a:max(a, b - s.words + 1)]) for a, b in zip(bounds, bounds[1:])]
            sizes = np.array([len(x) for x in sets])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(np.repeat(np.arange(len(batch)), sizes))),
                 pa.array(np.concatenate(sets).view(np.int64))], ["id", "shingle"])

    ids = members.select("id").distinct()
    held = saved(texts.join(ids, "id").mapInArrow(run, "id bigint, shingle bigint"), "near-shingles")
    often = saved(held.groupBy("shingle").agg(F.count("*").alias("holders")).filter("holders > 1"), "near-often")
    shared = join_sized(held, often, ["shingle"], "holders", held.count()).groupBy("id").agg(F.count("*").alias("u"))
    own = held.groupBy("id").agg(F.count("*").alias("n"))
    sized = members.join(own.join(shared, "id"), "id")
    least = sized.groupBy("key").agg(F.min("n").alias("m"))
    out = (sized.join(least, "key").filter(100 * F.col("u") >= s.similarity * (F.col("n") + F.col("m") - F.col("u")))
           .drop("m"))
    out = saved(out, "near-linkable")
    discard(held, often)
    return out


def near_links(sketch: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """Confirmed links (a, b) between the given sketches that connect all that similar pairs would connect.

    ``sketch`` has one row for each different sequence of words: id, a number of its own, and (first, mark), a row
    of ``docs`` with that text. The text with the smallest first row is the first pivot of a band bucket. In the first round each member
    meets the smallest pivot of its buckets, which settles groups of copies with one row a member; in the second it
    meets the pivots of buckets that still hold several components. Where they do after that, further rounds
    compare a growing share of the members (pivots, chosen by a hash) with all members of other components, until
    each pair of members is compared, connected or ruled out, by the shingles that they can share at most or by
    maps of their shingles. No bucket is capped, and none is gathered in one task.
    """
    members = sketch.select("id", "first", F.posexplode("keys").alias("band", "key"))
    buckets = saved(members.groupBy("key").agg(F.min(F.struct("first", "id")).alias("pivot"), F.count("*").alias("size"))
                    .filter("size > 1"), "near-buckets")
    members = saved(join_sized(members, buckets, ["key"], "size", s.bands * sketch.count()), "near-members")
    discard(buckets)
    chosen = sketch.join(members.select("id").distinct(), "id").select(F.col("id").alias("node"), F.col("first").alias("id"), "mark")
    texts = saved(marked(docs).join(chosen, ["id", "mark"]).dropDuplicates(["node"]).select(F.col("node").alias("id"), "text"),
                  "near-texts")

    def links(pairs: DataFrame) -> DataFrame:
        once = saved(pairs.distinct(), "near-pairs")
        alive = saved(bayes_survivors(once, sketch, s), "near-survivors")
        out = saved(confirmed(alive, texts, s), "near-links")
        discard(once, alive)
        return out

    def mixed(members: DataFrame, *old: DataFrame) -> DataFrame:
        """The members of buckets with several components, with theirs."""
        label = connected_components(found, u="a", v="b").toDF("id", "component")
        own = members.join(label, "id", "left").withColumn("component", F.coalesce("component", "id"))
        several = own.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y")
        out = saved(own.join(several.select("key"), "key"), "near-mixed")
        discard(*old)
        return out

    def more(pairs: DataFrame) -> DataFrame:
        new = links(pairs)
        out = saved(found.unionByName(new), "near-found")
        discard(found, new)
        return out

    pair = (F.least("pivot.id", "id").alias("a"), F.greatest("pivot.id", "id").alias("b"))
    nearest = members.groupBy("id").agg(F.min("pivot").alias("pivot"))
    found = links(nearest.filter("pivot.id <> id").select(*pair))
    members = mixed(members.select("key", "band", "id", "size", "pivot"), members)
    if members.isEmpty():
        return found
    settled = members.filter("id = pivot.id").select("key", F.col("component").alias("p_component"))
    found = more(members.join(settled, "key").filter("p_component <> component").select(*pair))
    members = mixed(members.filter("size > 2").select("key", "band", "id", "size"), members)
    if members.isEmpty():
        return found
    left = linkable(members, texts, s)
    discard(members)
    ids = left.select("id").distinct()
    maps = bitmaps(texts.join(ids, "id"), s)
    members = saved(left.join(sketch.select("id", "keys"), "id").join(maps, "id").drop("component"), "near-mapped")
    discard(left)
    # a member is a pivot of round r if its place, a hash times the bucket's size, is below growth**r
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / F.lit(float(1 << 40)) * F.col("size")
    low, high = 0.0, float(s.growth)
    while True:
        members = mixed(members.filter(place >= low).drop("component"), members)
        if members.filter(F.col("size") > low).isEmpty():
            return found
        pivot = members.filter(place < high).select("key", *(F.col(c).alias(f"p_{c}") for c in ("id", "component", "u", "n", "keys", "map")))
        apart = F.aggregate(F.zip_with("map", "p_map", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x)

        def enough(common):
            return 100 * common >= s.similarity * (F.col("n") + F.col("p_n") - common)

        # a pivot meets the members that are no pivots, and of two pivots the earlier meets the later; pairs meet in
        # the first band that they share, and only if their shared shingles may be enough
        # the join multiplies its input, so its tasks must not be merged by their size
        n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pairs = (pivot.repartition(n, "key").join(members.repartition(n, "key"), "key").filter(
            (F.col("p_component") != F.col("component")) & ((place >= high) | (F.col("p_id") < F.col("id")))
            & enough(F.least("u", "p_u"))
            & (F.array_position(F.zip_with("keys", "p_keys", lambda x, y: x == y), True) == F.col("band") + 1)
            & enough((F.col("n") + F.col("p_n") - apart) / 2))
            .select(F.least("p_id", "id").alias("a"), F.greatest("p_id", "id").alias("b")))
        found = more(pairs)
        low, high = high, high * s.growth


def same_ids(some: DataFrame, groups: DataFrame) -> DataFrame:
    """(a, b): links between different texts that rows of one doc_id hold. Rows without doc_id are not one document."""
    several = (some.filter(F.col("id") < NO_ID).groupBy("id").agg(F.min("digest").alias("x"), F.max("digest").alias("y"))
               .filter("x <> y").select("id"))
    held = some.select("id", "digest").join(several, "id").distinct().join(groups.select("digest", "node"), "digest")
    first = held.groupBy("id").agg(F.min("node").alias("a"))
    return held.join(first, "id").filter("a < node").select("a", F.col("node").alias("b"))


def near_duplicates(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of ``docs``.

    Words are lower-cased (A-Z); a text's set holds its different shingles of five words, or its whole sequence if
    it has fewer. Documents whose sets reach the similarity are linked; ``component_id`` is the smallest doc_id
    of the connected documents and ``kept`` marks the rows that carry it. Texts without words (null, empty) are
    linked with nothing. Rows with one doc_id are one document: the links of all their texts connect; a row without
    doc_id is a document of its own, larger than all others. An empty table gives an empty result; other columns are
    ignored.

    Equal word sequences are merged first: only one of a group of copies is compared. A pair is missed if all bands
    differ (4e-7 at the threshold, less above) or the sequential test gives it up (``miss``); each is then often
    connected through others.
    """
    s = settings or Settings()
    sketch = saved(sketches(docs, s), "near-sketches")
    some = sketch.filter("n_shingles > 0")
    chosen = saved(some.groupBy("digest").agg(
        F.min(F.struct("id", "mark")).alias("row"), F.count("*").alias("rows"), F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"), F.first("keys").alias("keys"))
        .select("digest", "rows", "n_shingles", "signature", "keys", F.col("row.id").alias("first"), F.col("row.mark").alias("mark"),
                F.monotonically_increasing_id().alias("node")), "near-chosen")
    links = near_links(chosen.withColumnRenamed("node", "id"), docs, s)
    groups = chosen.select("digest", "rows", "first", "node")
    label = connected_components(links.unionByName(same_ids(some, groups)), u="a", v="b").toDF("node", "label")
    groups = saved(groups.join(label, "node", "left").withColumn("label", F.coalesce("label", "node")), "near-labels")
    least = saved(groups.groupBy("label").agg(F.min("first").alias("component"), F.count("*").alias("texts")), "near-least")
    groups = join_sized(groups, least, ["label"], "texts", groups.count()).select("digest", "component", "rows")
    joined = join_sized(some.select("id", "digest", "n_shingles"), saved(groups, "near-groups"), ["digest"], "rows",
                        some.count())
    alone = sketch.filter("n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component"))
    return joined.select("id", "n_shingles", "component").unionByName(alone).select(
        doc_id(), "n_shingles", doc_id("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"))


SQL = r"""with recursive w as (
  select doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') ws
  from documents),
shingles as materialized (
  select distinct doc_id, md5(array_to_string(ws[s:s + 4], ' ')) h
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) s from w where len(ws) > 0)),
sizes as materialized (select doc_id, count(*) n from shingles group by doc_id),
shared as materialized (
  select a.doc_id u, b.doc_id v, count(*) n from shingles a join shingles b using (h) where a.doc_id < b.doc_id group by 1, 2),
links as materialized (
  select u, v from shared s join sizes a on a.doc_id = u join sizes b on b.doc_id = v where 100 * s.n >= 85 * (a.n + b.n - s.n)),
both_ways as materialized (select u, v from links union all select v, u from links),
reach(node, root) as (select doc_id, doc_id from w union select k.v, r.root from reach r join both_ways k on k.u = r.node),
least as (select node, min(root) root from reach group by 1)
select doc_id, coalesce(n, 0)::bigint n_shingles, root component_id, doc_id = root kept
from w join least on node = doc_id left join sizes using (doc_id)"""


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
