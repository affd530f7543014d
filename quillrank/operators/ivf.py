"""Approximate nearest neighbours by cosine: an inverted file over a coarse quantiser, residuals as product codes.

The quantisers are fitted on a bounded sample; every vector is indexed. A query meets the entries of the lists whose
centres are nearest, by codes of a few bytes; the best of them are ranked again by their exact cosine. Work grows with
queries x probes x list length, never with queries x vectors. Long lists and lists that many queries probe are split.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import dot
from ..session import delete_stored, stored
from .vectors import best_of_block, nearest, unit_rows

ENTRY = "list int, id bigint, codes binary"
#: Numbers that a task makes at once out of the rows it is given.
HELD = 1 << 21
#: Least rows of a list's part where vectors meet; a strip of their products is held at a time.
EXACT = 4096


@dataclass
class Quantiser:
    """``centres`` of the lists and, for each part of the residual, a book of code words."""

    centres: np.ndarray   # (lists, width)
    books: np.ndarray     # (parts, words, width / parts)

    def residual_tables(self, residuals: np.ndarray) -> np.ndarray:
        """Squared distances (rows, parts, words) from each part of the residuals to all code words."""
        parts, _, width = self.books.shape
        split = residuals.reshape(len(residuals), parts, width)
        return ((split ** 2).sum(2)[:, :, None] + (self.books ** 2).sum(2)[None]
                - 2 * np.einsum("npw,pcw->npc", split, self.books))

    def encode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(list, codes) of unit vectors."""
        own = _closest(rows, self.centres, 1)[:, 0]
        return own, self.residual_tables(rows - self.centres[own]).argmin(2).astype(np.uint8)


@dataclass
class Index:
    quantiser: Quantiser
    entries: DataFrame     # (list, id, codes), stored
    vectors: DataFrame     # (id, features), what exact ranking reads

    def sizes(self) -> dict[int, int]:
        return {r["list"]: r["count"] for r in self.entries.groupBy("list").count().collect()}

    def extended(self, more: DataFrame) -> Index:
        """The index with further vectors, whose quantisers stay as they are."""
        return Index(self.quantiser, stored(self.entries.unionByName(_encoded(more, self.quantiser)), "ivf"),
                     self.vectors.unionByName(more.select("id", "features")))

    def save(self, path: str) -> None:
        spark, q = self.entries.sparkSession, self.quantiser
        rows = [("centre", k, 0, c.tolist()) for k, c in enumerate(q.centres)]
        rows += [("book", p, k, w.tolist()) for p, book in enumerate(q.books) for k, w in enumerate(book)]
        spark.createDataFrame(rows, "kind string, a int, b int, x array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/quantiser")
        self.entries.write.mode("overwrite").parquet(f"{path}/entries")

    @classmethod
    def load(cls, spark: SparkSession, path: str, vectors: DataFrame) -> Index:
        rows = sorted(spark.read.parquet(f"{path}/quantiser").collect(), key=lambda r: (r.kind, r.a, r.b))
        centres = np.array([r.x for r in rows if r.kind == "centre"])
        books = [np.array([r.x for r in rows if r.kind == "book" and r.a == p]) for p in sorted({r.a for r in rows if r.kind == "book"})]
        return cls(Quantiser(centres, np.stack(books)), spark.read.parquet(f"{path}/entries"), vectors)


def _strips(frame: pd.DataFrame, width: int):
    """Parts of a frame whose rows, with ``width`` numbers made of each, stay below ``HELD`` numbers."""
    step = max(1, HELD // max(width, 1))
    for k in range(0, len(frame), step):
        yield frame.iloc[k:k + step]


def _closest(rows: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centres of each row, nearest first; ties to the smaller number."""
    out = np.empty((len(rows), n), np.int64)
    step = min(4096, max(1, HELD // len(centres)))
    for k in range(0, len(rows), step):
        far = (centres ** 2).sum(1)[None] - 2 * rows[k:k + step] @ centres.T
        out[k:k + step] = np.argsort(far, axis=1, kind="stable")[:, :n]
    return out


def _lloyd(rows: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """k-means centres. Starts from rows spread over the (hash-ordered) sample; an empty centre stays where it was."""
    k = min(k, len(rows))
    centres = rows[np.linspace(0, len(rows) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = _closest(rows, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        count = np.bincount(own, minlength=k)
        centres[count > 0] = sums[count > 0] / count[count > 0, None]
    return centres


def fit(vectors: DataFrame, lists: int | None = None, parts: int = 16, words: int = 256, sample: int = 65_536,
        rounds: int = 10) -> Quantiser:
    """Quantisers from at most ``sample`` vectors, chosen by a hash of their ids.

    ``lists`` defaults to the square root of the number of vectors, 4,096 at most. ``parts`` must divide the width.
    The centres are fitted in one task over the bounded sample, the books in a task each.
    """
    lists = lists or min(4096, max(1, math.isqrt(vectors.count())))
    chosen = (vectors.filter(F.size("features") > 0).withColumn("place", F.xxhash64("id")).orderBy("place", "id").limit(sample)
              .select("place", "id", "features"))

    def centres(frame: pd.DataFrame) -> pd.DataFrame:
        found = _lloyd(unit_rows(frame.sort_values(["place", "id"])["features"]), lists, rounds)
        return pd.DataFrame({"a": np.arange(len(found)), "x": list(found)})

    def book(frame: pd.DataFrame) -> pd.DataFrame:
        p, rows = int(frame["part"].iloc[0]), np.stack(frame.sort_values(["place", "id"])["x"].to_numpy())
        found = _lloyd(rows, words, rounds)
        return pd.DataFrame({"a": p, "b": np.arange(len(found)), "x": list(found)})

    kept = stored(chosen, "ivf-sample")
    top = np.array([r.x for r in kept.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(centres, "a int, x array<double>").orderBy("a").collect()])
    width = top.shape[1] // parts

    def residuals(batches):
        for frame in batches:
            if frame.empty:
                continue
            rows = unit_rows(frame["features"])
            rest = rows - top[_closest(rows, top, 1)[:, 0]]
            for p in range(parts):
                yield pd.DataFrame({"part": p, "place": frame["place"], "id": frame["id"], "x": list(rest[:, p * width:(p + 1) * width])})

    split = kept.mapInPandas(residuals, "part int, place bigint, id bigint, x array<double>")
    rows = split.groupBy("part").applyInPandas(book, "a int, b int, x array<double>").orderBy("a", "b").collect()
    size = min(sum(r.a == p for r in rows) for p in range(parts))
    books = np.array([[r.x for r in rows if r.a == p][:size] for p in range(parts)])
    delete_stored(kept)
    return Quantiser(top, books)


def _encoded(vectors: DataFrame, q: Quantiser) -> DataFrame:
    def encode(batches):
        for batch in batches:
            for frame in _strips(batch, q.books.shape[0] * q.books.shape[1]):
                own, codes = q.encode(unit_rows(frame["features"]))
                yield pd.DataFrame({"list": own.astype("int32"), "id": frame["id"], "codes": [c.tobytes() for c in codes]})
    return vectors.select("id", "features").mapInPandas(encode, ENTRY)


def build(vectors: DataFrame, quantiser: Quantiser | None = None, **fitting) -> Index:
    """Every vector (id, features) in its list, as a code of one byte a part."""
    q = quantiser or fit(vectors, **fitting)
    return Index(q, stored(_encoded(vectors, q), "ivf"), vectors)


def search(index: Index, queries: DataFrame, k: int = 10, probes: int = 8, rerank: int = 200, limit: int = 2048) -> DataFrame:
    """(id, neighbour, sim, rank): the k best of the probed lists for each query (id, features), itself left out.

    The ``rerank`` entries with the nearest codes are compared exactly. If these are all entries there are, codes rule
    nothing out: then vectors meet in the lists, and a block, of 4,096 rows a side at least, hands on the k best of each query. A list above ``limit`` entries, and the
    queries of a list above ``limit``, are split, so that no task meets more than limit x limit of them at once.
    """
    q, sizes = index.quantiser, index.sizes()
    exactly = rerank >= sum(sizes.values())
    limit = max(limit, EXACT) if exactly else limit
    probes = min(probes, len(q.centres))

    def probe(batches):
        for batch in batches:
            for frame in _strips(batch, probes * q.centres.shape[1]):
                rows = unit_rows(frame["features"])
                found = _closest(rows, q.centres, probes)
                yield pd.DataFrame({"list": found.ravel().astype("int32"), "id": np.repeat(frame["id"].to_numpy(), probes),
                                    "unit": [x for x in rows for _ in range(probes)]})

    asked = queries.select("id", "features").mapInPandas(probe, "list int, id bigint, unit array<double>")
    asking = {r["list"]: r["count"] for r in asked.groupBy("list").count().collect()}
    spark = queries.sparkSession
    parts = spark.createDataFrame([(n, max(1, math.ceil(sizes[n] / limit)), max(1, math.ceil(asking.get(n, 1) / limit)))
                                   for n in sizes] or [(0, 1, 1)], "list int, e_parts int, q_parts int")  # a row a list
    left = asked.join(F.broadcast(parts), "list").select(
        "list", "id", "unit", F.pmod(F.xxhash64("id"), "q_parts").cast("int").alias("qp"),
        F.explode(F.sequence(F.lit(0), F.col("e_parts") - 1)).alias("ep"))
    right = index.entries.join(F.broadcast(parts), "list").select(
        "list", "id", "codes", F.pmod(F.xxhash64("id"), "e_parts").cast("int").alias("ep"),
        F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)).alias("qp"))

    def meet(key, qs: pd.DataFrame, es: pd.DataFrame) -> pd.DataFrame:
        if qs.empty or es.empty:
            return pd.DataFrame({"id": [], "neighbour": [], "far": []})
        es = es.sort_values("id")
        codes = np.frombuffer(b"".join(es["codes"]), np.uint8).reshape(len(es), -1)
        names, out = es["id"].to_numpy(), []
        for start in range(0, len(qs), 256):
            part = qs.iloc[start:start + 256]
            tables = q.residual_tables(np.stack(part["unit"].to_numpy()) - q.centres[key[0]])
            far = sum(tables[:, p, :][:, codes[:, p]] for p in range(codes.shape[1]))
            ids = part["id"].to_numpy()
            far[ids[:, None] == names[None, :]] = np.inf
            n = min(rerank, len(names))
            best = np.argpartition(far, n - 1, axis=1)[:, :n]
            far = np.take_along_axis(far, best, 1)
            out.append(pd.DataFrame({"id": np.repeat(ids, n), "neighbour": names[best].ravel(), "far": far.ravel()}))
        out = pd.concat(out)
        return out[np.isfinite(out["far"])]

    order = W.partitionBy("id").orderBy(F.desc("sim"), "neighbour")
    if exactly:
        def meet_exactly(qs: pd.DataFrame, es: pd.DataFrame) -> pd.DataFrame:
            if qs.empty or es.empty:
                return pd.DataFrame({"id": [], "neighbour": [], "sim": []})
            return best_of_block(qs["id"].to_numpy(), unit_rows(qs["features"]), es["id"].to_numpy(), unit_rows(es["features"]), k)

        asks = left.select("list", "id", "qp", "ep").join(queries.select("id", "features"), "id")
        held = right.select("list", "id", "qp", "ep").join(index.vectors.select("id", "features"), "id")
        exact = asks.groupBy("list", "ep", "qp").cogroup(held.groupBy("list", "ep", "qp")).applyInPandas(
            meet_exactly, "id bigint, neighbour bigint, sim double")
        return exact.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    met = left.groupBy("list", "ep", "qp").cogroup(right.groupBy("list", "ep", "qp")).applyInPandas(
        meet, "id bigint, neighbour bigint, far double")
    near = met.withColumn("place", F.row_number().over(W.partitionBy("id").orderBy("far", "neighbour"))).filter(F.col("place") <= rerank)

    def unit(df: DataFrame, name: str, column: str) -> DataFrame:
        size = F.sqrt(dot(F.col("features"), F.col("features")))
        return df.select(F.col("id").alias(name), F.transform("features", lambda v: v.cast("double") / F.greatest(size, F.lit(1e-300))).alias(column))

    exact = (near.select("id", "neighbour").join(unit(index.vectors, "neighbour", "e"), "neighbour")
             .join(unit(queries, "id", "x"), "id").select("id", "neighbour", F.round(dot(F.col("x"), F.col("e")), 6).alias("sim")))
    return exact.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def recall(index: Index, queries: DataFrame, k: int = 10, **searching) -> float:
    """Share of the exact k best that a search finds; a neighbour as near as the exact k-th counts."""
    exact = nearest(queries, index.vectors, k).groupBy("id").agg(F.min("sim").alias("edge"), F.count("*").alias("n"))
    found = search(index, queries, k, **searching).join(exact.select("id", "edge"), "id").filter(F.col("sim") >= F.col("edge"))
    hits, wanted = found.count(), exact.agg(F.sum("n")).first()[0]
    return hits / wanted if wanted else 1.0


def probes_for(index: Index, target: float = 0.95, k: int = 10, queries: int = 64, **searching) -> int:
    """The fewest probes, by doubling, whose recall on ``queries`` sampled vectors reaches the target."""
    some = stored(index.vectors.orderBy(F.xxhash64("id"), "id").limit(queries), "ivf-queries")
    probes = 1
    while probes < len(index.quantiser.centres) and recall(index, some, k, probes=probes, **searching) < target:
        probes *= 2
    delete_stored(some)
    return min(probes, len(index.quantiser.centres))
