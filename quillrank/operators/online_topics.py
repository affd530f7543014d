"""Online variational Bayes for LDA (Hoffman et al. 2010) with updatable topics.

The topic-word weights are a table (word, weight array), not a driver-side
matrix. An update with later documents continues from the table and extends it
by their new words.

While documents are worked on, both sides are packed: some million words of
documents are a chunk, one row of bytes, and the words are dealt by a hash into
parts, each with its weights one row of bytes. In a step a part sends a chunk
the weights of the words that the chunk holds, once however many of its
documents hold them, and the chunk sends back the sums for these words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.packing import pack_columns, unpack_columns
from ..session import cut_lineage, delete_stored, free_shuffles, stored
from .keywords import COMMON_WORDS, pieces, term_frequency, word_counts


#: Words of documents that a task works on at once.
HELD_WORDS = 1 << 16

#: Words of documents in a chunk.
CHUNK_WORDS = 1 << 23

#: A part of the words: their weights, the sums of these, and of each chunk the places of its words.
STATE = "part int, words binary, weight binary, sums array<double>, chunks array<bigint>, places array<binary>"


def digamma(x: np.ndarray) -> np.ndarray:
    """Recurrence up to x >= 6, then the asymptotic series."""
    x = np.array(x, dtype=float)
    shift = np.zeros_like(x)
    for _ in range(6):
        small = x < 6
        shift[small] -= 1 / x[small]
        x[small] += 1
    r = 1 / (x * x)
    return shift + np.log(x) - 0.5 / x - r * (1 / 12 - r * (1 / 120 - r / 252))


def document_step(counts: np.ndarray, beta: np.ndarray, alpha: float, rounds: int = 50):
    """Topic weights gamma of one document and its expected topic-word counts."""
    gamma = np.ones(beta.shape[1])
    for _ in range(rounds):
        before = gamma
        theta = np.exp(digamma(gamma) - digamma(gamma.sum(keepdims=True)))
        norm = beta @ theta + 1e-100
        gamma = alpha + theta * ((counts / norm) @ beta)
        if np.abs(gamma - before).mean() < 1e-3:
            break
    theta = np.exp(digamma(gamma) - digamma(gamma.sum(keepdims=True)))
    return gamma, beta * theta * (counts / (beta @ theta + 1e-100))[:, None]


def documents_step(counts: np.ndarray, sizes: np.ndarray, beta: np.ndarray, alpha: float, rounds: int = 50):
    """:func:`document_step` of many documents, whose words stand one after the other, ``sizes`` of them each.

    A document rests once its weights have settled; the others go on without it.
    """
    topics = beta.shape[1]
    gamma = np.ones((len(sizes), topics))

    def shares(of: np.ndarray) -> np.ndarray:
        return np.exp(digamma(of) - digamma(of.sum(1, keepdims=True)))

    def norms(b: np.ndarray, theta: np.ndarray, own: np.ndarray) -> np.ndarray:
        return sum(b[k] * theta[:, k][own] for k in range(topics)) + 1e-100

    columns = np.ascontiguousarray(beta.T)  # a topic's numbers side by side
    live, size, c, b = np.arange(len(sizes)), sizes, counts, columns
    for _ in range(rounds):
        own, first = np.repeat(np.arange(len(live)), size), np.cumsum(size) - size
        theta = shares(gamma[live])
        ratio = c / norms(b, theta, own)
        new = alpha + theta * np.stack([np.add.reduceat(ratio * b[k], first) for k in range(topics)], axis=1)
        on = ~(np.abs(new - gamma[live]).mean(1) < 1e-3)
        gamma[live] = new
        if not on.any():
            break
        if not on.all():
            live, size, c, b = live[on], size[on], c[on[own]], b[:, on[own]]
    theta, own = shares(gamma), np.repeat(np.arange(len(sizes)), sizes)
    return gamma, beta * theta[own] * (counts / norms(columns, theta, own))[:, None]


def _documents(frame: pd.DataFrame, alpha: float):
    """(rows, gammas, expected counts of their words) for about ``HELD_WORDS`` words at a time."""
    sizes = frame["tf"].map(len).to_numpy()
    for _, part in frame.groupby(np.cumsum(sizes) // HELD_WORDS, sort=False):
        weight = np.stack([w for ws in part["weight"] for w in ws])
        beta = np.exp(digamma(weight) - digamma(np.asarray(part["total"].iloc[0])))
        yield part, *documents_step(np.concatenate(part["tf"].to_list()).astype(float), part["tf"].map(len).to_numpy(), beta, alpha)


class Bags:
    """Counted words of documents in chunks, in a stored table.

    Its rows of kind "docs" have the documents of a chunk, with words as places among the chunk's; its rows of kind
    "words" have the chunk's words in one part.
    """

    def __init__(self, words: DataFrame, apart: bool = False):
        """``apart`` keeps rows that share a doc_id apart; else they are one document."""
        spark = words.sparkSession
        self.parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
        self.kind = words.schema["doc_id"].dataType.simpleString()
        self.docs = words.count()
        rows = words.select("doc_id", "words", F.lit(None).cast("array<bigint>").alias("tf")) if apart else one_row_each(words)
        parts = self.parts

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n, chunk = [], 0, TaskContext.get().partitionId() << 24
            for piece in (p for batch in batches for p in pieces(batch)):
                held.append(piece)
                n += int(word_counts(piece).sum())
                if n >= CHUNK_WORDS:
                    yield chunk_rows(held, chunk, parts)
                    held, n, chunk = [], 0, chunk + 1
            if held:
                yield chunk_rows(held, chunk, parts)

        self.table = stored(rows.mapInArrow(packed, "kind string, chunk bigint, part int, block binary"), "bags", "kind")
        free_shuffles(spark)
        self.chunks = self.table.filter("kind = 'docs'").count()
        # a chunk's work follows its words, so tasks must not be merged by what they read
        self.tasks = max(1, min(4 * self.chunks, parts))

    def delete(self) -> None:
        delete_stored(self.table)


def one_row_each(words: DataFrame) -> DataFrame:
    """(doc_id, words, tf) with one row a document; tf is null where each word of the row counts once."""
    shared = cut_lineage(words.groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1").select(F.col("doc_id").alias("shared_id")))
    n = shared.count()
    plain = words.select("doc_id", "words", F.lit(None).cast("array<bigint>").alias("tf"))
    if not n:
        return plain
    if n <= COMMON_WORDS:
        shared = F.broadcast(shared)
    same = F.col("doc_id").eqNullSafe(F.col("shared_id"))
    counted = term_frequency(words.join(shared, same, "left_semi")).filter("word is not null")
    return plain.join(shared, same, "left_anti").unionByName(
        counted.groupBy("doc_id").agg(F.collect_list("word").alias("words"), F.collect_list("tf").alias("tf")))


def chunk_rows(held: list[pa.RecordBatch], chunk: int, parts: int) -> pa.RecordBatch:
    """(kind, chunk, part, block): the documents of a chunk and, part by part, its words."""
    size = np.concatenate([word_counts(b) for b in held])
    coded = pa.concat_arrays([b.column("words").flatten() for b in held]).dictionary_encode()
    vocabulary, code = coded.dictionary, pc.fill_null(coded.indices, -1).to_numpy().astype("int64")
    tf = np.concatenate([np.ones(n.sum(), "int64") if b.column("tf").null_count == len(n) else _filled(b, n) for b in held for n in (word_counts(b),)])
    doc = np.repeat(np.arange(len(size)), size)
    del coded
    part = (pd.util.hash_array(vocabulary.to_numpy(zero_copy_only=False), categorize=False) % np.uint64(parts)).astype("int64")
    order = np.argsort(part, kind="stable")
    rank = np.empty(len(order), "int64")
    rank[order] = np.arange(len(order))
    known, width = code >= 0, max(len(order), 1)
    key, weight = doc[known] * width + rank[code[known]], tf[known]
    del doc, code, tf
    by_key = np.argsort(key, kind="stable")
    key = key[by_key]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    n = np.add.reduceat(weight[by_key], first) if len(first) else weight
    doc, code = np.divmod(key[first], width)
    sizes = np.bincount(doc, minlength=len(size))
    step = np.diff(code, prepend=0)  # ascending in a document, so steps are small
    begins = (np.cumsum(sizes) - sizes)[sizes > 0]
    step[begins] = code[begins]
    blocks = [pack_columns({"doc_id": pa.concat_arrays([b.column("doc_id") for b in held]), "size": sizes.astype("int32"),
                            "step": step.astype("int32"), "n": n.astype("int32" if n.max(initial=0) < 1 << 31 else "int64")})]
    part = part[order]
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    blocks += [pack_columns({"word": vocabulary.take(pa.array(order[a:b]))}) for a, b in zip(starts, np.append(starts[1:], len(part)))]
    return pa.RecordBatch.from_arrays(
        [pa.array(["docs"] + ["words"] * len(starts)), pa.array([chunk] * len(blocks), pa.int64()), pa.array([None, *part[starts].tolist()], pa.int32()),
         pa.array(blocks, pa.binary())], ["kind", "chunk", "part", "block"])


def _filled(batch: pa.RecordBatch, size: np.ndarray) -> np.ndarray:
    """Counts of the words of a batch in which some rows have none and so count each word once."""
    given, out = np.repeat(batch.column("tf").is_valid().to_numpy(zero_copy_only=False), size), np.ones(size.sum(), "int64")
    out[given] = batch.column("tf").flatten().to_numpy()
    return out


def first_weights(words: list[str], topics: int, seed: str) -> np.ndarray:
    """Start values of words, the draws of :func:`uniform` plus a half."""
    draws = [[int(hashlib.md5(f"{seed}:{w}:{k}".encode()).hexdigest()[:8], 16) for k in range(topics)] for w in words]
    return np.array(draws, float).reshape(-1, topics) / 4294967296.0 + 0.5


def _state(bags: Bags, topics: int, weights: DataFrame | None, seed: str, grow: bool) -> DataFrame:
    """The parts of the words of ``weights`` and, with ``grow``, of new words; other words of the bags have no place."""
    parts = bags.parts
    rows = bags.table.filter("kind = 'words'").select("part", "chunk", F.col("block").alias("words"), F.lit(None).cast("binary").alias("weight"))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("word").is_valid())
            part = (pd.util.hash_array(batch.column("word").to_numpy(zero_copy_only=False), categorize=False) % np.uint64(parts)).astype("int64")
            weight = batch.column("weight").flatten().to_numpy().reshape(-1, topics)
            chosen = [(p, np.flatnonzero(part == p)) for p in np.unique(part)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(p) for p, _ in chosen], pa.int32()), pa.nulls(len(chosen), pa.int64()),
                 pa.array([pack_columns({"word": batch.column("word").take(pa.array(at))}) for _, at in chosen], pa.binary()),
                 pa.array([weight[at].tobytes() for _, at in chosen], pa.binary())], ["part", "chunk", "words", "weight"])

    if weights is not None:
        rows = rows.unionByName(weights.select("word", "weight").mapInArrow(dealt, "part int, chunk bigint, words binary, weight binary"))

    def placed(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches).to_pylist()
        old, new = [r for r in held if r["chunk"] is None], sorted((r for r in held if r["chunk"] is not None), key=lambda r: r["chunk"])
        words = [unpack_columns(r["words"])["word"] for r in old + new]
        coded = pa.concat_arrays(words).dictionary_encode()
        place, vocabulary = coded.indices.to_numpy(), coded.dictionary
        ends = np.cumsum([len(w) for w in words])
        known = int(ends[len(old) - 1]) if old else 0
        n = int(place[:known].max(initial=-1)) + 1
        if not grow:
            place, vocabulary = np.where(place < n, place, -1), vocabulary.slice(0, n)
        weight = np.empty((len(vocabulary), topics))
        weight[place[:known]] = np.frombuffer(b"".join(r["weight"] for r in old)).reshape(-1, topics)
        weight[n:] = first_weights(vocabulary.slice(n).to_pylist(), topics, seed)
        places = [place[end - len(w):end].astype("int32").tobytes() for w, end in zip(words[len(old):], ends[len(old):])]
        yield state_row(key[0].as_py(), pack_columns({"word": vocabulary}), weight, [r["chunk"] for r in new], places)

    return stored(rows.groupBy("part").applyInArrow(placed, STATE), "topics")


def state_row(part: int, words: bytes, weight: np.ndarray, chunks: list[int], places: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([words], pa.binary()), pa.array([weight.tobytes()], pa.binary()), pa.array([weight.sum(0).tolist()], pa.list_(pa.float64())),
         pa.array([chunks], pa.list_(pa.int64())), pa.array([places], pa.list_(pa.binary()))], ["part", "words", "weight", "sums", "chunks", "places"])


def _met(state: DataFrame, bags: Bags, topics: int) -> DataFrame:
    """(chunk, part, block): of a chunk its documents and, from each part, the weights of its words; NaN for those without a place."""
    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
            weight = np.concatenate([np.frombuffer(row["weight"]).reshape(-1, topics), np.full((1, topics), np.nan)])  # the last stands for no place
            for chunk, places in zip(row["chunks"], row["places"]):
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([row["part"]], pa.int32()),
                                                  pa.array([weight[np.frombuffer(places, "int32")].tobytes()], pa.binary())], ["chunk", "part", "block"])

    docs = bags.table.filter("kind = 'docs'").select("chunk", "part", "block")
    return state.mapInArrow(sent, "chunk bigint, part int, block binary").unionByName(docs).repartition(bags.tasks, "chunk").groupBy("chunk")


class Chunk:
    """A chunk that has met its weights: ``rows`` are the documents that have a word with weights."""

    def __init__(self, batches: Iterator[pa.RecordBatch], topics: int, total: np.ndarray):
        held = sorted(((p, b) for batch in batches for p, b in zip(batch.column("part").to_pylist(), batch.column("block").to_pylist())),
                      key=lambda x: -1 if x[0] is None else x[0])
        docs = unpack_columns(held[0][1])
        self.parts, self.doc_id = [p for p, _ in held[1:]], docs["doc_id"]
        weight = [np.frombuffer(b).reshape(-1, topics) for _, b in held[1:]]
        self.ends = np.cumsum([len(w) for w in weight])
        weight = np.concatenate([np.zeros((0, topics)), *weight])
        del held
        size, code, n = docs["size"].to_numpy().astype("int64"), docs["step"].to_numpy().cumsum(dtype="int64"), docs["n"].to_numpy()
        begin = (np.cumsum(size) - size)[size > 0]
        code -= np.repeat(code[begin] - docs["step"].to_numpy()[begin], size[size > 0])
        known = ~np.isnan(weight[:, 0])
        if not known.all():
            keep = known[code]
            size = np.bincount(np.repeat(np.arange(len(size)), size)[keep], minlength=len(size))
            code, n = code[keep], n[keep]
        self.rows = np.flatnonzero(size)
        self.size, self.code, self.n = size[self.rows], code, n
        self.beta = np.exp(digamma(weight) - digamma(total))

    def solved(self, alpha: float):
        """(first document, document after, gammas, words, expected counts) for about ``HELD_WORDS`` words at a time."""
        ends = np.cumsum(self.size)
        cuts = [0, *(np.flatnonzero(np.diff(ends // HELD_WORDS)) + 1), len(ends)] if len(ends) else []
        for a, b in zip(cuts, cuts[1:]):
            lo, hi = ends[a] - self.size[a], ends[b - 1]
            code = self.code[lo:hi]
            yield a, b, code, *documents_step(self.n[lo:hi].astype(float), self.size[a:b], self.beta[code], alpha)


def _total(state: DataFrame, topics: int) -> np.ndarray:
    found = state.agg(*[F.sum(F.col("sums")[k]) for k in range(topics)]).first()
    return np.array([x or 0.0 for x in found])


def _step(state: DataFrame, bags: Bags, topics: int, rate: float, scale: float) -> DataFrame:
    alpha = eta = 1.0 / topics
    total = _total(state, topics)

    def expected(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk(batches, topics, total)
        sums, words, stats, n = np.zeros_like(chunk.beta), [], [], 0

        def add() -> None:
            code = np.concatenate(words)
            for k in range(topics):
                sums[:, k] += np.bincount(code, weights=np.concatenate([s[:, k] for s in stats]), minlength=len(sums))

        for _, _, code, _, stat in chunk.solved(alpha):
            words.append(code)
            stats.append(stat)
            n += len(code)
            if n >= max(len(sums), 16 * HELD_WORDS):
                add()
                words, stats, n = [], [], 0
        if words:
            add()
        for part, end, start in zip(chunk.parts, chunk.ends, np.append(0, chunk.ends)):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([key[0].as_py()], pa.int64()), pa.array([sums[start:end].tobytes()], pa.binary())],
                                             ["part", "chunk", "block"])

    def moved(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches).to_pylist()
        row, stats = next(r for r in held if r["chunk"] is None), {r["chunk"]: r["block"] for r in held if r["chunk"] is not None}
        weight = np.frombuffer(row["weight"]).reshape(-1, topics)
        sums = np.zeros_like(weight)
        for chunk, places in zip(row["chunks"], row["places"]):  # in the order of chunks, which have a word once each
            sums[np.frombuffer(places, "int32")] += np.frombuffer(stats[chunk]).reshape(-1, topics)
        yield state_row(key[0].as_py(), row["words"], (1 - rate) * weight + rate * (eta + scale * sums), row["chunks"], row["places"])

    stats = stored(_met(state, bags, topics).applyInArrow(expected, "part int, chunk bigint, block binary"), "stats")
    free_shuffles(state.sparkSession)  # weights and sums need not be on disk at once
    new = stored(stats.unionByName(state, allowMissingColumns=True).groupBy("part").applyInArrow(moved, STATE), "topics")
    delete_stored(stats, state)
    free_shuffles(state.sparkSession)
    return new


def _steps(words: DataFrame | Bags, topics: int, weights: DataFrame | None, first: int, rounds: int, total_docs: int | None = None,
           offset: float = 1.0, decay: float = 0.5, seed: str = "lda") -> DataFrame:
    bags = words if isinstance(words, Bags) else Bags(words)
    state = _state(bags, topics, weights, seed, grow=True)
    for done in range(first, first + rounds):
        rate = (offset + done) ** -decay if done else 1.0
        state = _step(state, bags, topics, rate, (total_docs or bags.docs) / max(bags.docs, 1))
    if bags is not words:
        bags.delete()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
            word, weight = unpack_columns(row["words"])["word"], np.frombuffer(row["weight"])
            for at in range(0, len(word), HELD_WORDS):
                part = weight[at * topics:(at + HELD_WORDS) * topics]
                yield pa.RecordBatch.from_arrays([word.slice(at, HELD_WORDS), pa.ListArray.from_arrays(np.arange(0, len(part) + 1, topics, dtype="int32"), part)],
                                                 ["word", "weight"])

    out = state.select("words", "weight").mapInArrow(rows, "word string, weight array<double>")
    out.stored_at = state.stored_at
    return out


def update(words: DataFrame | Bags, topics: int, weights: DataFrame | None = None, updates: int = 0,
           total_docs: int | None = None, offset: float = 1.0, decay: float = 0.5) -> DataFrame:
    """(word, weight) after one step on ``words``; ``updates`` steps were made before."""
    return _steps(words, topics, weights, updates, 1, total_docs, offset, decay)


def train(words: DataFrame | Bags, topics: int, rounds: int = 10, weights: DataFrame | None = None, seed: str = "lda") -> DataFrame:
    """(word, weight) after ``rounds`` steps, each on all documents."""
    return _steps(words, topics, weights, 0, rounds, seed=seed) if rounds else weights


def infer(words: DataFrame | Bags, weights: DataFrame, topics: int, apart: bool = False) -> DataFrame:
    """(doc_id, topics): one distribution per document with a known word.

    With ``apart`` it is one per row, of zeros if the row has no known word.
    """
    bags = words if isinstance(words, Bags) else Bags(words, apart)
    state = _state(bags, topics, weights, "", grow=False)
    total = _total(state, topics)

    def mixtures(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk(batches, topics, total)
        found = np.zeros((len(chunk.doc_id), topics))
        for a, b, _, gamma, _ in chunk.solved(1.0 / topics):
            found[chunk.rows[a:b]] = gamma / gamma.sum(1, keepdims=True)
        rows = np.arange(len(found)) if apart else chunk.rows
        yield pa.RecordBatch.from_arrays(
            [chunk.doc_id.take(pa.array(rows)), pa.ListArray.from_arrays(np.arange(0, len(rows) * topics + 1, topics, dtype="int32"), found[rows].ravel())], ["doc_id", "topics"])

    out = stored(_met(state, bags, topics).applyInArrow(mixtures, f"doc_id {bags.kind}, topics array<double>"), "mixtures")
    delete_stored(state)
    if bags is not words:
        bags.delete()
    free_shuffles(out.sparkSession)
    return out
