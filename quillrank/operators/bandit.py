"""Multi-armed bandits evaluated on logged pulls (arm, reward)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import uniform
from ..functions.running import SLICE, default_slices, running, slice_by_quantile
from ..session import cut_lineage, stored
from .arms import with_arm_blocks


def arm_stats(pulls: DataFrame, arm: str = "arm") -> DataFrame:
    """(arm, wins, losses, trials, mean)."""
    return pulls.groupBy(arm).agg(
        F.sum("reward").alias("wins"), F.sum(1 - F.col("reward")).alias("losses"),
        F.count("*").alias("trials"), F.avg("reward").alias("mean"))


def ucb_score(mean: Column, trials: Column, all_trials: Column) -> Column:
    return mean + F.sqrt(2 * F.log(1 + all_trials) / (1 + trials))


def ucb_select(pulls: DataFrame) -> DataFrame:
    """(arm, mean, trials, ucb, chosen): UCB1 after the whole log."""
    stats = arm_stats(pulls)
    scored = stats.select("arm", "mean", "trials", F.round(ucb_score(
        F.col("mean"), F.col("trials"), stats.agg(F.sum("trials")).scalar()), 6).alias("ucb"))
    choice = scored.agg(F.min(F.struct((-F.col("ucb")).alias("key"), "arm"))["arm"]).scalar()
    return scored.withColumn("chosen", F.col("arm") == choice)


def numbered_arms(stats: DataFrame) -> DataFrame:
    """Arms with dense numbers from 0, in the order of a hash of the arm."""
    keyed = stats.withColumn("u", uniform(F.col("arm").cast("string")))
    return running(keyed, "u", sums={"number": F.lit(1)}, ties=("arm",), inclusive=False).drop("u")


def epsilon_greedy(requests: DataFrame, pulls: DataFrame, epsilon: float = 0.05, min_trials: int = 0,
                   order: str = "event_id", seed: str = "eg") -> DataFrame:
    """(event_id, explored, arm) for every request.

    Explores with probability ``epsilon`` and for the first ``min_trials``
    requests: a uniform arm by its number. Otherwise the arm with the best mean.
    """
    arms = numbered_arms(arm_stats(pulls))
    n = arms.agg(F.count("*")).scalar()
    best = arms.agg(F.max_by("arm", F.struct(F.round("mean", 6), -F.col("number")))).scalar()
    asked = running(requests.select("event_id", order), order, sums={"t": F.lit(1)},
                    ties=("event_id",), inclusive=False)
    explore = (uniform(seed, F.col("event_id")) < epsilon) | (F.col("t") < min_trials)
    draw = F.floor(uniform(seed + ":arm", F.col("event_id")) * n)
    asked = asked.select("event_id", explore.alias("explored"), F.when(explore, draw).alias("number"))
    asked = cut_lineage(asked)  # read for either kind
    # only the requests that explore meet the arms: the others would share one null key
    explored = asked.filter("explored").join(arms.select("number", "arm"), "number").select("event_id", "explored", "arm")
    return explored.unionByName(asked.filter("not explored").select("event_id", "explored", best.alias("arm")))


def thompson_posterior(pulls: DataFrame) -> DataFrame:
    """(arm, alpha, beta, mean, variance) of the Beta(1 + wins, 1 + losses) posteriors."""
    a, b = F.col("alpha"), F.col("beta")
    return (arm_stats(pulls).select("arm", (1 + F.col("wins")).alias("alpha"), (1 + F.col("losses")).alias("beta"))
            .withColumn("mean", a / (a + b))
            .withColumn("variance", a.cast("double") * b / ((a + b) * (a + b) * (a + b + 1))))


def _bound(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def gamma_draw(shape: Column, *key, tries: int = 8) -> Column:
    """A Gamma(shape >= 1) draw that is a function of its key, by the Marsaglia-Tsang rejection.

    Each try has uniforms of its own, counted off by md5, and accepts with over 95 %; after ``tries`` of them
    (4e-11) the mode's neighbourhood stands in.
    """
    d = shape - F.lit(1.0) / 3

    def positive(j: int, part: str) -> Column:
        return uniform(*key, j, part) + 2.0 ** -33

    def attempt(j: int) -> Column:
        normal = F.sqrt(-2 * F.log(positive(j, "r"))) * F.cos(2 * math.pi * positive(j, "t"))

        def judge(x: Column) -> Column:
            return _bound(F.pow(1 + x / F.sqrt(9 * d), F.lit(3.0)), lambda v: F.when(
                (v > 0) & (F.log(positive(j, "u")) < 0.5 * x * x + d - d * v + d * F.log(v)), d * v))
        return _bound(normal, judge)

    return F.coalesce(*[attempt(j) for j in range(tries)], d)


def thompson_select(requests: DataFrame, pulls: DataFrame, seed: str = "ts") -> DataFrame:
    """(event_id, arm, draw): the arm with the largest posterior draw per request.

    A Beta draw is a quotient of two Gamma draws keyed by (seed, request, arm): no generator, no state, and the same
    number in any engine.
    """
    def draw(a: Column) -> Column:
        wins, losses = (gamma_draw(a[n].cast("double"), seed, F.col("event_id"), a["arm"], n) for n in ("alpha", "beta"))
        return F.struct(_bound(wins, lambda w: _bound(losses, lambda v: w / (w + v))).alias("draw"), a["arm"].alias("arm"))

    asked = with_arm_blocks(requests.select("event_id"), thompson_posterior(pulls), "arm", "alpha", "beta")
    best = asked.select("event_id", F.array_max(F.transform("arms", draw)).alias("b"))
    return best.groupBy("event_id").agg(F.max("b").alias("b")).select("event_id", "b.arm", "b.draw")


def replay_ucb(pulls: DataFrame, order: str = "t", slice_rows: int = 50_000) -> DataFrame:
    """(event_id, arm, ucb_arm, ucb): what UCB1 would pull at each logged event, ties to the smallest arm.

    The state holds only earlier events. The log is cut into slices along ``order``; sums of (slice, arm) are added up
    over the earlier slices, and each slice starts from that state, an array over the arms, and is scanned once.
    """
    log = pulls.select("event_id", "arm", "reward", F.col(order).alias("at"))
    slices = max(default_slices(log), -(-log.count() // slice_rows))
    log = stored(slice_by_quantile(log, "at", slices, "event_id").withColumnRenamed(SLICE, "slice"), "replay")
    names = sorted(r[0] for r in log.select("slice").distinct().collect())  # at most about twice ``slices`` numbers
    sums = log.groupBy("slice", "arm").agg(F.count("*").alias("n"), F.coalesce(F.sum("reward"), F.lit(0)).cast("double").alias("w"))
    grid = log.select("arm").distinct().select("arm", F.explode(F.array(*[F.lit(x) for x in names])).alias("slice"))
    before = W.partitionBy("arm").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    state = grid.join(sums, ["slice", "arm"], "left").select(
        F.col("slice").alias("of"), F.col("arm").alias("name"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).cast("double").alias(c) for c in ("n", "w")])
    kinds = {f.name: f.dataType.simpleString() for f in log.schema}

    def scan(rows: pd.DataFrame, arms: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({c: [] for c in ("event_id", "arm", "ucb_arm", "ucb")})
        rows, arms = rows.sort_values(["at", "event_id"]), arms.sort_values("name")
        names, n, w = arms["name"].to_numpy(), arms["n"].to_numpy().copy(), arms["w"].to_numpy().copy()
        pulled, reward = np.searchsorted(names, rows["arm"].to_numpy()), rows["reward"].fillna(0).to_numpy("float64")
        best, score, first = np.empty(len(rows), np.int64), np.empty(len(rows)), n.sum()
        for t, (k, r) in enumerate(zip(pulled.tolist(), reward.tolist())):
            ucb = np.round(w / np.maximum(n, 1) + np.sqrt(2 * math.log(1 + first + t) / (1 + n)), 6)
            best[t] = ucb.argmax()
            score[t] = ucb[best[t]]
            n[k] += 1
            w[k] += r
        return pd.DataFrame({"event_id": rows["event_id"], "arm": rows["arm"], "ucb_arm": names[best], "ucb": score + 0.0})

    return log.groupBy("slice").cogroup(state.groupBy("of")).applyInPandas(
        scan, f"event_id {kinds['event_id']}, arm {kinds['arm']}, ucb_arm {kinds['arm']}, ucb double")


def cumulative_regret(pulls: DataFrame, order: str = "t", keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys..., event_id, arm, regret, cumulative_regret) along the log.

    An arm's probability is its mean reward over the whole log.
    """
    stats = arm_stats(pulls).select("arm", "mean")
    best = stats.agg(F.max("mean")).scalar()
    loss = stats.select("arm", (best - F.col("mean")).alias("regret"))
    steps = pulls.select(*keys, "event_id", "arm", order).join(loss, "arm")
    return (running(steps, order, sums={"cumulative_regret": F.col("regret")}, keys=keys, ties=("event_id",))
            .select(*keys, "event_id", "arm", "regret", "cumulative_regret"))
