"""Quality classifier: a factorisation machine over hashed words, structure figures and metadata."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, doc_id, documents
from .quality_rules import CAPITAL, LETTER, Texts, per_text
from .words import LOWERED, fingerprints, steps

BITS = 16
#: Labelled documents that the model is fitted on, about; with fewer, all of them.
FIT_ROWS = 12_000
RANK = 8
RATIOS = np.array([0.0, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7])
FIGURES = {"symbols": RATIOS, "lines": RATIOS, "repeats": RATIOS, "capitals": RATIOS, "echoes": RATIOS, "loud": RATIOS,
           "different": RATIOS, "length": np.array([2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 10.0]),
           "words": np.array([0.5, 5, 20, 50, 100, 200, 500, 1000, 3000, 10000]),
           "chars": np.array([0.5, 50, 200, 500, 1000, 3000, 10000, 50000])}
WIDTH = 16  # places that each figure has behind the words' places
FEATURES = (1 << BITS) + WIDTH * len(FIGURES)


class Rows(NamedTuple):
    """Sparse rows: row i has the features at[i]:at[i+1]."""
    index: np.ndarray
    value: np.ndarray
    at: np.ndarray


def features(data: np.ndarray, offsets: np.ndarray, chars: np.ndarray) -> Rows:
    """Different words of each text, weighted so that their squares add up to 1, and one place for each figure.

    ``chars`` is the number of characters that the metadata tells, NaN if it does not.
    """
    t = Texts(data, offsets).measure()
    n, words = len(offsets) - 1, np.maximum(t.n_words, 1)
    codes = fingerprints(LOWERED[data], t.starts, t.ends)
    text = np.repeat(np.arange(n), t.n_words)
    places = np.unique((text << BITS) | (codes >> np.uint64(64 - BITS)).astype(np.int64))
    found = np.bincount(places >> BITS, minlength=n)
    exact = fingerprints(data, t.starts, t.ends)
    echo = np.r_[False, exact[1:] == exact[:-1]]
    echo[t.bounds[:-1][t.n_words > 0]] = False
    loud = (data == 33) | (data == 63)
    two = loud[t.ends - 1] & loud[np.maximum(t.ends - 2, 0)] & (t.ends - t.starts >= 2)
    told = {"symbols": t.base["n_symbols"] / words, "lines": t.base["n_dup_lines"] / (per_text(data == 10, offsets) + 1),
            "repeats": t.base["n_repeat_words"] / words,
            "capitals": per_text(CAPITAL[data], offsets) / np.maximum(per_text(LETTER[data], offsets), 1),
            "echoes": per_text(echo, t.bounds) / words, "loud": per_text(two, t.bounds) / words,
            "different": found / words, "length": t.base["word_chars"] / words, "words": t.n_words, "chars": chars}
    kinds = [(1 << BITS) + WIDTH * k + np.where(np.isnan(told[f]), WIDTH - 1, np.searchsorted(edges, told[f], "left"))
             for k, (f, edges) in enumerate(FIGURES.items())]
    # words first, then the figures, row by row
    at = np.r_[0, np.cumsum(found + len(kinds))]
    index, value = np.empty(at[-1], np.int32), np.ones(at[-1], np.float32)
    row = places >> BITS
    spot = np.arange(len(places)) + row * len(kinds)
    index[spot] = places & ((1 << BITS) - 1)
    value[spot] = 1 / np.sqrt(found[row])
    for k, kind in enumerate(kinds):
        index[at[1:] - len(kinds) + k] = kind
    return Rows(index, value, at)


class Machine(NamedTuple):
    bias: float
    linear: np.ndarray   # (features,)
    factors: np.ndarray  # (features, rank)

    def logits(self, x: Rows) -> np.ndarray:
        """Half the square of the sum less the sum of the squares: pairs in time linear in the features."""
        weighted = self.factors[x.index] * x.value[:, None]
        total = np.add.reduceat(weighted, x.at[:-1], axis=0)
        squares = np.add.reduceat(weighted * weighted, x.at[:-1], axis=0)
        first = np.add.reduceat(self.linear[x.index] * x.value, x.at[:-1])
        return self.bias + first + 0.5 * (total * total - squares).sum(axis=1)


def train(x: Rows, y: np.ndarray, epochs: int = 6, least: int = 600, batch: int = 64, rate: float = 0.05, decay: float = 1e-5) -> Machine:
    """Logistic loss by minibatches with adaptive steps; rows in a fixed order, so the same rows give one model.

    Few rows are gone through more often, for at least about ``least`` steps in all.
    """
    rng = np.random.default_rng(7)
    m = Machine(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), np.zeros(FEATURES, np.float32),
                rng.normal(0, 0.02, (FEATURES, RANK)).astype(np.float32))
    seen = np.full((FEATURES, RANK + 1), 1e-6, np.float32)
    for _ in range(max(epochs, -(-least * batch // max(1, len(y))))):
        order = rng.permutation(len(y))
        for k in range(0, len(order), batch):
            mine = order[k:k + batch]
            sizes = x.at[mine + 1] - x.at[mine]
            at = np.r_[0, np.cumsum(sizes)]
            pick = np.repeat(x.at[mine] - at[:-1], sizes) + np.arange(at[-1])
            part, row = Rows(x.index[pick], x.value[pick], at), np.repeat(np.arange(len(mine)), sizes)
            error = 1 / (1 + np.exp(-np.clip(m.logits(part), -30, 30))) - y[mine]
            weighted = m.factors[part.index] * part.value[:, None]
            total = np.add.reduceat(weighted, at[:-1], axis=0)
            slope = np.empty((len(row), RANK + 1), np.float32)
            slope[:, 0] = part.value
            slope[:, 1:] = part.value[:, None] * (total[row] - weighted)
            slope *= (error[row] / len(mine))[:, None].astype(np.float32)
            by = np.argsort(part.index, kind="stable")
            new = np.flatnonzero(np.r_[True, np.diff(part.index[by]) > 0])
            f, g = part.index[by][new], np.add.reduceat(slope[by], new, axis=0)
            seen[f] += g * g
            step = rate * g / np.sqrt(seen[f])
            m.linear[f] -= step[:, 0] + decay * m.linear[f]
            m.factors[f] -= step[:, 1:] + decay * m.factors[f]
    return m


def _chars(docs: DataFrame):
    return (F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)).cast("double").alias("chars")


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Machine | None:
    """A model of ``labels`` (doc_id, label), fitted on about ``fit_rows`` of them, drawn by a hash of doc_id.

    The drawn labels are few, so they are broadcast and the documents stay where they are; the features of these
    documents (some kB each) go to the driver. None if there is nothing to learn from.
    """
    told = labels.filter("label is not null and doc_id is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    share = min(1.0, fit_rows / max(1, told.count()))
    drawn = told.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(max(1, round(share * 1e6))))
    known = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _chars(docs))
             .join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "chars", "label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in steps(batches):
            x = features(data, offsets, batch.column("chars").to_numpy(zero_copy_only=False).astype(float))
            at = pa.array(x.at.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.ListArray.from_arrays(at, pa.array(x.index)),
                 pa.ListArray.from_arrays(at, pa.array(x.value))], ["doc_id", "label", "index", "value"])

    table = (known.withColumn("label", F.col("label").cast("int"))
             .mapInArrow(run, "doc_id bigint, label int, index array<int>, value array<float>").toArrow())
    if not len(table):
        return None
    table = table.sort_by("doc_id").combine_chunks()
    index, value = (table.column(c).combine_chunks() for c in ("index", "value"))
    at = np.r_[0, np.cumsum(index.value_lengths().to_numpy())]
    return train(Rows(index.flatten().to_numpy(), value.flatten().to_numpy(), at), table.column("label").to_numpy().astype(float))


def score(docs: DataFrame, model: Machine | None) -> DataFrame:
    """(doc_id, score): the probability of label 1 for each row, 0.5 without a model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch, data, offsets in steps(batches):
            if m is None:
                out = np.full(len(batch), 0.5)
            else:
                x = features(data, offsets, batch.column("chars").to_numpy(zero_copy_only=False).astype(float))
                out = 1 / (1 + np.exp(-np.clip(m.logits(x).astype(float), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out)], ["id", "score"])

    given = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"),
                        F.coalesce("text", F.lit("")).alias("text"), _chars(docs))
    return given.mapInArrow(run, "id bigint, score double").select(doc_id(), "score")


def quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, score), one row for each row of ``docs``: how likely label 1 is, between 0 and 1.

    Inputs of a score are the text and n_chars. Null and empty texts are scored by their figures; several labels of
    a document count as the largest; null labels are left out; repeated rows score alike; without labels every
    score is 0.5; an empty table gives an empty result; other columns are ignored. No shuffle of texts.
    """
    return score(docs, fit(docs, labels, fit_rows))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out()).select(
        "doc_id", F.col("quality").alias("label"))
    return quality(documents(spark, sf_dir), labels).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
