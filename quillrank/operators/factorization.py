"""Matrix factorisation: implicit ALS, gradient descent, stratified SGD, BPR triples."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dot, uniform
from ..functions.linalg import solve, symmetric
from ..functions.running import running
from ..session import cut_lineage, delete_stored, stored


def init_factors(ids: DataFrame, column: str, k: int, seed: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """(id, features): reproducible uniform start vectors of the distinct ids."""
    return ids.select(F.col(column).alias("id")).distinct().select("id", F.array(*[
        uniform(seed, F.col("id"), c) * (high - low) + low for c in range(k)]).alias("features"))


def confidence(ratings: DataFrame, alpha: float = 40.0) -> DataFrame:
    """(user_id, item_id, preference, confidence): p = 1 where rated, C = 1 + alpha r."""
    return ratings.select("user_id", "item_id", (F.col("rating") != 0).cast("double").alias("preference"),
                          (1 + alpha * F.col("rating")).alias("confidence"))


def _cells(k: int):
    return [(i, j) for i in range(k) for j in range(i, k)]


def gramian(factors: DataFrame, k: int) -> DataFrame:
    """One row (g): the flattened k x k matrix of summed outer products."""
    f = F.col("features")
    sums = factors.agg(*[F.sum(f[i] * f[j]).alias(f"g{i}_{j}") for i, j in _cells(k)])
    return sums.select(symmetric(lambda i, j: F.col(f"g{i}_{j}"), k).alias("g"))


def normal_equations(ratings: DataFrame, factors: DataFrame, k: int, solve_for: str = "user_id",
                     given: str = "item_id", alpha: float = 40.0, lam: float = 10.0) -> DataFrame:
    """(id, a, b): A = Y'Y + sum of (C-1) y y' + lambda I and b = sum of C p y.

    The sums run over the rated cells only and are combined map-side, so an
    active user or a popular item is a short partial row per task.
    """
    rated = confidence(ratings, alpha).filter("preference > 0")
    cells = rated.join(factors.select(F.col("id").alias(given), "features"), given)
    y, extra = F.col("features"), F.col("confidence") - 1
    sums = [F.sum(extra * y[i] * y[j]).alias(f"a{i}_{j}") for i, j in _cells(k)]
    sums += [F.sum(F.col("confidence") * y[i]).alias(f"b{i}") for i in range(k)]
    grouped = cells.groupBy(F.col(solve_for).alias("id")).agg(*sums).withColumn("g", gramian(factors, k).scalar())
    a = symmetric(lambda i, j: F.col(f"a{i}_{j}") + F.col("g")[i * k + j] + F.lit(lam if i == j else 0.0), k)
    return grouped.select("id", a.alias("a"), F.array(*[F.col(f"b{i}") for i in range(k)]).alias("b"))


def als_step(ratings: DataFrame, factors: DataFrame, k: int, **args) -> DataFrame:
    """(id, features): one half sweep, the other side's factors given."""
    return normal_equations(ratings, factors, k, **args).select("id", solve("a", "b").alias("features"))


def als_train(ratings: DataFrame, k: int = 10, sweeps: int = 100, alpha: float = 40.0, lam: float = 10.0,
              seed: str = "als") -> tuple[DataFrame, DataFrame]:
    """(user_factors, item_factors) with plain lambda; each sweep is written to the shared folder.

    Repeated ratings of a cell count as their mean.
    """
    cells = ratings.groupBy("user_id", "item_id").agg(F.avg("rating").alias("rating"))
    ratings = cut_lineage(cells)  # read in every half sweep
    items = init_factors(ratings, "item_id", k, seed, -0.5, 0.5)
    users = None
    for _ in range(sweeps):
        users = cut_lineage(als_step(ratings, items, k, alpha=alpha, lam=lam))
        items = cut_lineage(als_step(ratings, users, k, solve_for="item_id", given="user_id", alpha=alpha, lam=lam))
    return users, items


def als_builtin(ratings: DataFrame, k: int = 10, sweeps: int = 10, alpha: float = 40.0, lam: float = 10.0,
                seed: int = 7):
    """Spark's own implicit ALS; it scales lambda by the number of ratings. Ids must fit an int."""
    return ALS(rank=k, maxIter=sweeps, alpha=alpha, regParam=lam, implicitPrefs=True, seed=seed,
               userCol="user_id", itemCol="item_id", ratingCol="rating").fit(ratings)


def predict(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """The pairs with ``prediction`` = x_u y_i."""
    return (pairs.join(users.select(F.col("id").alias("user_id"), F.col("features").alias("__x")), "user_id")
            .join(items.select(F.col("id").alias("item_id"), F.col("features").alias("__y")), "item_id")
            .withColumn("prediction", dot(F.col("__x"), F.col("__y"))).drop("__x", "__y"))


def rmse(ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    error = F.col("rating") - F.col("prediction")
    return predict(ratings, users, items).agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def gradient_round(ratings: DataFrame, users: DataFrame, items: DataFrame, k: int, step: float = 0.01,
                   lam: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """One full-batch gradient step of both sides on the squared error."""
    cells = (ratings.join(users.select(F.col("id").alias("user_id"), F.col("features").alias("x")), "user_id")
             .join(items.select(F.col("id").alias("item_id"), F.col("features").alias("y")), "item_id")
             .withColumn("error", F.col("rating") - dot(F.col("x"), F.col("y"))))

    def move(old: DataFrame, key: str, other: str) -> DataFrame:
        sums = cells.groupBy(F.col(key).alias("id")).agg(
            F.count("*").alias("n"), *[F.sum(F.col("error") * F.col(other)[i]).alias(f"g{i}") for i in range(k)])
        f = F.col("features")
        return old.join(sums, "id").select("id", F.array(*[
            f[i] + step * (F.col(f"g{i}") - lam * F.col("n") * f[i]) for i in range(k)]).alias("features"))

    return move(users, "user_id", "y"), move(items, "item_id", "x")


def batch_gd(ratings: DataFrame, k: int = 2, rounds: int = 100, step: float = 0.01, lam: float = 0.01,
             seed: str = "mf", checkpoint_every: int = 2) -> tuple[DataFrame, DataFrame]:
    ratings = cut_lineage(ratings.select("user_id", "item_id", "rating"))  # read in every round
    users = init_factors(ratings, "user_id", k, seed + ":u")
    items = init_factors(ratings, "item_id", k, seed + ":i")
    for r in range(rounds):
        users, items = gradient_round(ratings, users, items, k, step, lam)
        if (r + 1) % checkpoint_every == 0 and r + 1 < rounds:
            users, items = cut_lineage(users), cut_lineage(items)
    return users, items


def waves(user: np.ndarray, item: np.ndarray):
    """Row numbers in waves without a common user or item, so that each wave moves as arrays.

    A row goes once it is the earliest that is left of its user and of its item: the waves give what a pass over
    the rows one after the other would give.
    """
    by_user, by_item = np.argsort(user, kind="stable"), np.argsort(item, kind="stable")
    edge = np.searchsorted(user[by_user], np.arange(user.max(initial=-1) + 2))
    at_user, end = edge[:-1].copy(), edge[1:]
    at_item = np.searchsorted(item[by_item], np.arange(item.max(initial=-1) + 1))
    active = np.arange(len(end))
    while len(active := active[at_user[active] < end[active]]):
        head = by_user[at_user[active]]
        ready = by_item[at_item[item[head]]] == head
        yield head[ready]
        at_user[active[ready]] += 1
        at_item[item[head[ready]]] += 1


def sgd_pass(x: np.ndarray, y: np.ndarray, user: np.ndarray, item: np.ndarray, value: np.ndarray, step: float, lam: float) -> None:
    """One pass over the ratings; an item moves towards its user's new vector."""
    for now in waves(user, item):
        u, i = user[now], item[now]
        error = (value[now] - (x[u] * y[i]).sum(1))[:, None]
        x[u] += step * (error * y[i] - lam * x[u])
        y[i] += step * (error * x[u] - lam * y[i])


def stratified_sgd(ratings: DataFrame, k: int = 20, epochs: int = 100, step: float = 0.01, lam: float = 0.01,
                   seed: str = "sgd", blocks: int | None = None, block_rows: int = 1_000_000):
    """(user_factors, item_factors) by sequential SGD inside blocks (Gemulla et al. 2011); ids of any type.

    Users and items are hashed into B blocks each. In every sub-epoch B blocks
    without a common user or item are updated in parallel, each in one task
    with about ratings / B^2 rows. A popular item's ratings are split over the
    B user blocks, so B also bounds its share of a task. The cells of each
    sub-epoch lie in a folder of their own, which is all that it reads. Blocks
    go through their cells in the order of a hash, whatever the cluster.
    """
    if blocks is None:
        blocks = max(4, math.ceil(math.sqrt(ratings.count() / block_rows)))
    kinds = {c: ratings.schema[c].dataType for c in ("user_id", "item_id")}

    def block(col: str):
        return F.pmod(F.xxhash64(F.col(col).cast("string")), F.lit(blocks)).cast("int")

    ub, ib = block("user_id"), block("item_id")
    cells = stored(ratings.select(
        ub.alias("ub"), F.pmod(ib - ub, F.lit(blocks)).cast("int").alias("stratum"), F.col("user_id").cast("string").alias("id"),
        F.col("item_id").cast("string").alias("other"), F.col("rating").cast("double").alias("value"),
        F.xxhash64(F.lit(seed), F.col("user_id").cast("string"), F.col("item_id").cast("string")).alias("place"))
        .repartition("stratum", "ub"), "cells", "stratum")

    def start(col: str, kind: str) -> DataFrame:
        return init_factors(ratings, col, k, f"{seed}:{kind}").select(
            F.lit(kind).alias("kind"), F.col("id").cast("string").alias("id"), "features")

    state = stored(start("user_id", "u").unionByName(start("item_id", "i")), "sgd")

    def sweep(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches)
        rows = held.filter(pc.equal(held["kind"], "r")).select(["id", "other", "value", "place"])
        sides = []
        for kind in ("u", "i"):
            own = held.filter(pc.equal(held["kind"], kind)).select(["id", "features"]).sort_by("id").combine_chunks()
            sides.append((own["id"], own["features"].combine_chunks().flatten().to_numpy().astype("float64").reshape(-1, k)))
        del held
        if len(rows):
            order = pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in ("place", "id", "other")]).to_numpy()
            value = rows["value"].to_numpy()[order]
            # ids become numbers before the ratings are put in order: strings are held once
            user, item = (pc.index_in(rows[c], value_set=names.combine_chunks()).to_numpy()[order] for c, (names, _) in zip(("id", "other"), sides))
            del rows, order
            sgd_pass(sides[0][1], sides[1][1], user, item, value, step, lam)
        for kind, (names, m) in zip(("u", "i"), sides):
            if len(names):
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(kind, len(names)), names.combine_chunks(), pa.ListArray.from_arrays(np.arange(0, m.size + 1, k, dtype="int32"), m.ravel())],
                    ["kind", "id", "features"])

    for shift in range(epochs * blocks):
        s = shift % blocks
        # the item block that meets user block b in this sub-epoch is b + s
        homed = state.select(
            F.when(F.col("kind") == "u", block("id")).otherwise(F.pmod(block("id") - s, F.lit(blocks))).cast("int").alias("ub"),
            "kind", "id", F.lit(None).cast("string").alias("other"), F.lit(None).cast("double").alias("value"),
            F.lit(None).cast("bigint").alias("place"), "features")
        mine = cells.filter(F.col("stratum") == s).select(
            "ub", F.lit("r").alias("kind"), "id", "other", "value", "place", F.lit(None).cast("array<double>").alias("features"))
        moved = stored(homed.unionByName(mine).groupBy("ub").applyInArrow(
            sweep, "kind string, id string, features array<double>"), "sgd")
        delete_stored(state)
        state = moved
    delete_stored(cells)
    return tuple(state.filter(F.col("kind") == kind).select(F.col("id").cast(kinds[col]).alias("id"), "features")
                 for kind, col in (("u", "user_id"), ("i", "item_id")))


def bpr_triples(ratings: DataFrame, draws: int = 1, seed: str = "bpr") -> DataFrame:
    """(user_id, pos, neg): for each rating ``draws`` items drawn evenly from those that the user has not rated.

    Users who rated everything have none. Items get dense numbers in hash order, and a draw k stands for the k-th
    unrated number: k plus the rated numbers before it. A rated number counts once its own number less its place
    among the user's rated ones is at most k, so one running count over both, split at its quantiles, tells all
    draws of all users; no list of a user's items is made.
    """
    ratings = cut_lineage(ratings.select("user_id", "item_id").distinct())
    items = ratings.select("item_id").distinct().withColumn("u", uniform(F.col("item_id")))
    items = cut_lineage(running(items, "u", sums={"number": F.lit(1)}, ties=("item_id",), inclusive=False).drop("u"))
    n = items.agg(F.count("*")).scalar()
    rated = ratings.join(items, "item_id")
    placed = running(rated, "number", sums={"place": F.lit(1)}, keys=("user_id",), ties=("item_id",), inclusive=False)
    gaps = placed.select("user_id", (F.col("number") - F.col("place")).alias("at"), F.lit(0).alias("draw"),
                         F.col("item_id").alias("pos"))
    left = ratings.groupBy("user_id").agg((n - F.count("*")).alias("left")).filter(F.col("left") > 0)
    drawn = (ratings.join(left, "user_id").withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
             .select("user_id", F.floor(uniform(seed, F.col("draw"), F.col("user_id"), F.col("item_id")) * F.col("left"))
                     .alias("at"), "draw", F.col("item_id").alias("pos")))
    both = cut_lineage(gaps.unionByName(drawn))
    swept = running(both, "at", sums={"before": (F.col("draw") == 0).cast("bigint")}, keys=("user_id",),
                    ties=("draw", "pos"))
    return (swept.filter("draw > 0").withColumn("number", F.col("at") + F.col("before"))
            .join(items.select("number", F.col("item_id").alias("neg")), "number").select("user_id", "pos", "neg"))
