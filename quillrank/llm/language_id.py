"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_id, documents, rows, saved
from .words import mix, steps

ORDERS = (1, 2, 3)
BITS = 15
#: Labelled documents that the model is fitted on, about; with fewer, all of them.
FIT_ROWS = 40_000
#: Bytes of the largest matrix that is broadcast: languages x n-gram buckets x 4.
MATRIX_BYTES = 256 << 20


def folded(text: str) -> np.ndarray:
    """Code points of the lower-cased text; stretches of anything but letters are one space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    top = int(codes.max(initial=0)) + 1
    letter = _LETTER[:top] if top <= len(_LETTER) else _letters(top)
    solid = letter[codes]
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    return np.where(solid, codes, 32)[keep].astype(np.uint64)


def _letters(top: int) -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(top)), bool, top)


_LETTER = _letters(0x3000)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every n-gram of all texts, n-grams of each text in one stretch: bounds)."""
    buckets, bounds = [], [0]
    for text in texts:
        codes = np.concatenate([np.full(1, 32, np.uint64), folded(text), np.full(1, 32, np.uint64)])
        n, size = 0, bounds[-1]
        for order in ORDERS:
            key = np.full(max(0, len(codes) - order + 1), order, np.uint64)
            for k in range(order):
                key = key * np.uint64(0x9E3779B97F4A7C15) + codes[k:k + len(key)]
            buckets.append((mix(key) >> np.uint64(64 - BITS)).astype(np.int32))
            n += len(key)
        bounds.append(size + n)
    return (np.concatenate(buckets) if buckets else np.zeros(0, np.int32)), np.array(bounds, np.int64)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def fit(docs: DataFrame, learn: Column, fit_rows: int = FIT_ROWS) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities of shape (buckets, languages)) from the rows where ``learn`` holds.

    Rows are drawn by a hash of their text, about ``fit_rows`` of them. Tasks count n-grams by language and
    bucket; only sums leave them. Languages are equally likely beforehand.
    """
    told = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    total = docs.count()
    share = min(1.0, fit_rows / max(1, total))
    drawn = told.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.lit(max(1, round(share * 1e6))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch, _, _ in steps(batches):
            buckets, bounds = grams(batch.column("text").to_pylist())
            for i, lang in enumerate(batch.column("lang").to_pylist()):
                part = np.bincount(buckets[bounds[i]:bounds[i + 1]], minlength=1 << BITS)
                counts[lang] = counts[lang] + part if lang in counts else part
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                              pa.array(c[at].astype(np.int64))], ["lang", "bucket", "n"])

    sums = saved(drawn.mapInArrow(run, "lang string, bucket int, n bigint")
                 .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    languages = [r[0] for r in sums.select("lang").distinct().orderBy("lang")
                 .limit(MATRIX_BYTES // (4 << BITS) + 1).collect()]
    if len(languages) * (4 << BITS) > MATRIX_BYTES:
        raise ValueError(f"more than {MATRIX_BYTES // (4 << BITS)} languages: use fewer buckets")
    counts = np.full((1 << BITS, len(languages)), 0.1)
    number = {x: i for i, x in enumerate(languages)}
    table = sums.toArrow()
    at = table.column("bucket").to_numpy()
    counts[at, [number[x] for x in table.column("lang").to_pylist()]] += table.column("n").to_numpy()
    return languages, np.log(counts / counts.sum(axis=0, keepdims=True)).astype(np.float32)


class Reader:
    """Reads the language of texts with a fitted model."""

    def __init__(self, languages: list[str], logs: np.ndarray):
        self.languages, self.logs = languages, logs

    def read(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(most likely languages, posterior probabilities)."""
        label, score = ["und"] * len(texts), np.zeros(len(texts))
        some = [i for i, t in enumerate(texts) if t and has_letter(t)] if self.languages else []
        if some:
            buckets, bounds = grams([texts[i] for i in some])
            logit = np.empty((len(some), len(self.languages)))
            for k in range(len(self.languages)):
                logit[:, k] = np.add.reduceat(self.logs[:, k][buckets], bounds[:-1], dtype=np.float64)
            best = logit.argmax(axis=1)
            score[some] = 1 / np.exp(logit - logit[np.arange(len(some)), best][:, None]).sum(axis=1)
            for i, k in zip(some, best.tolist()):
                label[i] = self.languages[k]
        return label, score


def predict(docs: DataFrame, languages: list[str], logs: np.ndarray) -> DataFrame:
    """(id, lang_pred, score): the most likely language and its posterior probability."""
    shared = docs.sparkSession.sparkContext.broadcast(Reader(languages, np.asfortranarray(logs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in steps(batches):
            label, score = shared.value.read(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(label, pa.string()), pa.array(score)],
                                             ["id", "lang_pred", "score"])

    return rows(docs).mapInArrow(run, "id bigint, lang_pred string, score double")


def accepted(docs: DataFrame, learn: Column, least: float = 0.5, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is told with a score of at least ``least``.

    Texts without a letter go. Rows are judged where they are: no shuffle, no join.
    """
    languages, logs = fit(docs, learn, fit_rows)
    shared = docs.sparkSession.sparkContext.broadcast(Reader(languages, np.asfortranarray(logs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = batch.column("text").fill_null("")
            for part, _, _ in steps(iter([pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(batch))), told], ["row", "text"])])):
                label, score = shared.value.read(part.column("text").to_pylist())
                good = np.array([x != "und" for x in label], bool) & (score >= least)
                yield batch.take(part.column("row").filter(pa.array(good)))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, learn: Column, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, lang_pred, score), one row for each row of ``docs``.

    Learns from text and lang of the rows where ``learn`` holds, then reads texts alone. Null texts and texts
    without a letter are ``und`` with score 0, and so is everything if there is nothing to learn from. Of equally
    likely languages the first by name wins. Repeated rows get the same answer; an empty table gives an empty
    result; other columns are ignored.
    """
    languages, logs = fit(docs, learn, fit_rows)
    return predict(docs, languages, logs).select(doc_id(), "lang_pred", "score")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir), ~held_out()).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")
