"""Dense vectors: inner products and exact nearest neighbours."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import dot


def dot_products(left: DataFrame, right: DataFrame, key: str, features: str = "features") -> DataFrame:
    """(key, dot) of the vectors with the same key."""
    return (left.select(key, F.col(features).alias("__a"))
            .join(right.select(key, F.col(features).alias("__b")), key)
            .select(key, dot(F.col("__a"), F.col("__b")).alias("dot")))


#: Rows of a block that are compared at once.
STRIP = 256


def unit_rows(features: pd.Series) -> np.ndarray:
    m = np.stack(features.to_numpy()).astype("float64")
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def best_of_block(ids: np.ndarray, rows: np.ndarray, names: np.ndarray, others: np.ndarray, k: int) -> pd.DataFrame:
    """(id, neighbour, sim): for each row at least its k best of the others by inner product, rows of its own id left out.

    The k-th best is at least the k-th of the maxima of more than k groups of columns, so that only what lies above
    that bound is rounded and handed on. A strip of rows is held at a time.
    """
    found, width = [], len(names)
    starts = np.arange(0, width, max(1, width // (8 * k)))
    for at in range(0, len(ids), STRIP):
        own, sims = ids[at:at + STRIP], rows[at:at + STRIP] @ others.T
        sims[(own[:, None] == names[None, :]) | np.isnan(sims)] = -np.inf
        if k < width:
            edge = -np.partition(-np.maximum.reduceat(sims, starts, axis=1), k - 1, axis=1)[:, k - 1:k]
            row, col = np.nonzero((sims >= edge - 2e-6) & (sims > -np.inf))
        else:
            row, col = np.nonzero(sims > -np.inf)
        found.append(pd.DataFrame({"id": own[row], "neighbour": names[col], "sim": np.round(sims[row, col], 6)}))
    return pd.concat(found)


def nearest(queries: DataFrame, vectors: DataFrame, k: int = 10, block: int = 4096,
            id_type: str = "bigint") -> DataFrame:
    """(id, neighbour, sim, rank): exact top-k by cosine, the vector itself left out.

    Both inputs are ``(id, features)``. They are hashed into blocks of about
    ``block`` rows; every query block meets every vector block as one matrix
    product whose k best columns per query leave the task, never the pairs.
    """
    nq, nv = queries.count(), vectors.count()
    q_blocks, v_blocks = max(1, math.ceil(nq / block)), max(1, math.ceil(nv / block))

    def blocks(df: DataFrame, mine: str, n: int, other: str, m: int) -> DataFrame:
        return (df.select("id", "features",
                          F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias(mine),
                          F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other)))

    q = blocks(queries, "qb", q_blocks, "vb", v_blocks).groupBy("qb", "vb")
    v = blocks(vectors, "vb", v_blocks, "qb", q_blocks).groupBy("qb", "vb")

    def best(qs: pd.DataFrame, vs: pd.DataFrame) -> pd.DataFrame:
        if qs.empty or vs.empty:
            return pd.DataFrame({"id": [], "neighbour": [], "sim": []})
        return best_of_block(qs.id.to_numpy(), unit_rows(qs.features), vs.id.to_numpy(), unit_rows(vs.features), k)

    found = q.cogroup(v).applyInPandas(best, f"id {id_type}, neighbour {id_type}, sim double")
    order = W.partitionBy("id").orderBy(F.desc("sim"), "neighbour")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
