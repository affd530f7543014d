"""The ways taken beyond one block, one slice or one group must give the same rows."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillrank.functions.pairs import grouped_pairs
from quillrank.functions.products import pair_sums
from quillrank.functions.running import SLICE, running, slice_by_quantile
from quillrank.operators import (arms, bandit, cofiba, factorization, graph, keywords, linucb, similarity, slope_one,
                                 vectors)


def rows(df, digits=6):
    return sorted(tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """User 0 rated everything and so holds more than a third of all rows."""
    rng = random.Random(3)
    cells = {(0, i): rng.randint(1, 5) for i in range(40)}
    cells |= {(u, rng.randrange(40)): rng.randint(1, 5) for u in range(1, 12) for _ in range(6)}
    data = [(u, i, float(r)) for (u, i), r in cells.items()]
    return data, spark.createDataFrame(data, "user_id bigint, item_id bigint, rating double").persist()


def test_hot_group_is_split_without_losing_pairs(skewed):
    data, df = skewed
    want = sorted((u, i, j, a, b) for (u, i, a), (v, j, b) in combinations(sorted(data), 2) if u == v)
    assert rows(grouped_pairs(df, "user_id", "item_id", "rating", tile=4)) == want
    assert rows(grouped_pairs(df, "user_id", "item_id", "rating")) == want


@pytest.mark.parametrize("args", [{}, {"item_block": 7}, {"item_block": 2, "shard": 3}, {"item_block": 20, "shard": 2}])
def test_block_products_equal_pair_by_pair(skewed, args):
    data, df = skewed
    plain, weighted = {}, {}
    for (u, i, a), (v, j, b) in combinations(sorted(data), 2):
        if u == v:
            n, diff = plain.get((i, j), (0, 0.0))
            plain[i, j] = n + 1, diff + a - b
            weighted[i, j] = weighted.get((i, j), 0.0) + a * b
    got = pair_sums(df, "user_id", "item_id", "rating", **args)
    assert {(r.i, r.j): (r.n, r["diff"]) for r in got.collect()} == plain
    got = pair_sums(df.withColumn("e", F.col("item_id") * 2.0), "user_id", "item_id", "rating", "e", **args)
    assert {(r.i, r.j): r.dot for r in got.collect()} == weighted
    assert got.filter("ei <> 2 * i or ej <> 2 * j").isEmpty()


@pytest.mark.parametrize("top", [None, 3])
def test_slope_one_over_many_tiles(skewed, top):
    _, df = skewed
    whole = rows(slope_one.recommend(df, top=top))
    assert rows(slope_one.recommend(df, top=top, user_block=3, item_block=7)) == whole
    assert rows(slope_one.recommend(df, top=top, user_block=3)) == whole


def test_running_totals_equal_one_window(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") * 7919 % 97).alias("t"), (F.col("id") % 3).alias("k"),
                                 (F.hash("id") % 10).alias("v"))
    for keys in ((), ("k",)):
        for inclusive in (True, False):
            w = W.partitionBy(*keys).orderBy("t", "id").rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
            want = df.select("id", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("s"), F.max("v").over(w).alias("m"))
            got = running(df, "t", {"s": F.col("v")}, {"m": F.col("v")}, keys, ("id",), inclusive, slices=13)
            assert got.select("id", "s", "m").exceptAll(want).isEmpty()


def test_running_totals_split_a_hot_order_value(spark):
    """Half of the rows share one order value and are cut by the tie column."""
    df = spark.range(400).select("id", F.when(F.col("id") % 2 == 0, 50).otherwise(F.col("id") % 97).alias("t"),
                                 F.lit(1).alias("v"))
    cut = slice_by_quantile(df, "t", 10, "id")
    assert cut.groupBy(SLICE).count().agg(F.max("count")).first()[0] <= 100
    w = W.orderBy("t", "id").rowsBetween(W.unboundedPreceding, 0)
    want = df.select("id", F.sum("v").over(w).alias("s"))
    got = running(df, "t", {"s": F.col("v")}, ties=("id",), slices=10)
    assert got.select("id", "s").exceptAll(want).isEmpty()


def test_arm_blocks_and_salted_join(spark, monkeypatch):
    requests = spark.range(30).select("id", F.array(F.col("id") / 7.0, F.col("id") % 5 * 1.0).alias("x"))
    state = spark.range(25).select(F.col("id").alias("arm"), F.array(
        F.lit(2.0), F.lit(0.5), F.lit(0.5), 1.0 + F.col("id")).alias("a"),
        F.array(F.sin("id"), F.cos("id")).alias("b"))
    want = rows(linucb.linucb_select(requests, "id", state))
    monkeypatch.setattr(arms, "ARM_BLOCK", 4)
    assert rows(linucb.linucb_select(requests, "id", state)) == want
    monkeypatch.setattr(arms, "BROADCAST_BLOCKS", 0)
    assert rows(linucb.linucb_select(requests, "id", state)) == want


def test_replay_in_several_slices(spark):
    pulls = spark.range(200).select(F.col("id").alias("event_id"), F.col("id").alias("t"),
                                    (F.hash("id") % 7).cast("string").alias("arm"), (F.hash("id") % 2 == 0).cast("long").alias("reward"))
    assert rows(bandit.replay_ucb(pulls)) == rows(bandit.replay_ucb(pulls, slice_rows=9))


def test_nearest_neighbours_over_blocks(spark):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(60, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id bigint, features array<double>")
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, 6)
    want = sorted((i, j, sims[i, j], r + 1) for i in range(60) for r, j in enumerate(
        sorted((j for j in range(60) if j != i), key=lambda j: (-sims[i, j], j))[:4]))
    assert rows(vectors.nearest(df, df, k=4, block=16)) == [tuple(map(float, w)) for w in want]


def brute_components(nodes, edges):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for u, v in edges:
            low = min(label[u], label[v])
            if label[u] != low or label[v] != low:
                label[u] = label[v] = low
                changed = True
    return sorted(label.items())


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(60)],
    [(0, i) for i in range(1, 40)] + [(50, 51)],
    [(random.Random(s).randrange(80), random.Random(s + 1000).randrange(80)) for s in range(60)]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    nodes = {n for e in edges for n in e}
    assert rows(graph.connected_components(df)) == brute_components(nodes, edges)


def test_interval_graph_equals_edge_by_edge(spark):
    rng = np.random.default_rng(11)
    spans = [(i, u, float(lo), float(lo + w)) for i in range(3) for u, (lo, w) in enumerate(
        zip(rng.uniform(0, 10, 25), rng.exponential(0.3, 25)))]
    df = spark.createDataFrame(spans, "item_id bigint, user_id bigint, lo double, hi double")
    edges = {(i, u): {v for j, v, lo2, hi2 in spans if j == i and v != u and lo2 <= hi and hi2 >= lo}
             for i, u, lo, hi in spans}
    found = cofiba.user_edges(df).collect()
    assert {(r.item_id, r.user_id): r.neighbours for r in found} == {k: len(v) for k, v in edges.items()}
    same = {}
    for r in found:
        same.setdefault((r.user_id, r.signature), set()).add(frozenset(edges[r.item_id, r.user_id]))
    assert all(len(s) == 1 for s in same.values())

    got = {(r.item_id, r.user_id): r.cluster for r in cofiba.user_clusters(df).collect()}
    for i in range(3):
        labels = dict(brute_components(range(25), [(u, v) for (j, u), vs in edges.items() if j == i for v in vs]))
        assert len(set(labels.values())) > 3
        for u, v in combinations(range(25), 2):
            assert (got[i, u] == got[i, v]) == (labels[u] == labels[v])


def test_narrow_text_plans_have_no_shuffle(spark):
    words = spark.createDataFrame([(1, ["aa", "bb", "cc"])], "doc_id bigint, words array<string>")
    for df in (keywords.textrank_keywords(words), keywords.textrank_edges(words)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block", [1536, 7, 1])
def test_answers_do_not_depend_on_blocks(spark, block):
    """Repeated cells, both signs, similarities of zero."""
    data = [(u, i, float((u * 7 + i * 3) % 5 - 2)) for u in range(9) for i in range(8) if (u + i) % 3]
    data += [(1, 1, 2.0), (1, 1, -1.0), (4, 3, 5.0), (0, 1, 1.0), (0, 2, -1.0)]
    df = spark.createDataFrame(data, "user_id bigint, item_id bigint, rating double")
    cells = {}
    for u, i, r in data:
        cells.setdefault((u, i), []).append(r)
    mean = {k: sum(v) / len(v) for k, v in cells.items()}
    total = {k: sum(v) for k, v in cells.items()}
    devs, dots = {}, {}
    for (u, i), (v, j) in combinations(sorted(mean), 2):
        if u == v:
            n, d = devs.get((i, j), (0, 0.0))
            devs[i, j] = n + 1, d + mean[u, i] - mean[v, j]
            dots[j, i] = dots.get((j, i), 0.0) + total[u, i] * total[v, j]
    got = slope_one.deviations(df, item_block=block)
    assert rows(got.select("i", "j", "common", "total")) == sorted((i, j, n, round(d, 6)) for (i, j), (n, d) in devs.items())
    found = similarity.cosine(df, rows="item_id", cols="user_id", threshold=-1.0, block=block)
    norm = {i: sum(t * t for (_, k), t in total.items() if k == i) ** 0.5 for i in range(8)}
    assert rows(found) == sorted((i, j, round(d / norm[i] / norm[j], 6) + 0.0) for (i, j), d in dots.items()
                                 if norm[i] > 1e-4 and norm[j] > 1e-4)
    assert rows(slope_one.recommend(df, top=3, item_block=block)) == rows(slope_one.recommend(df, top=3))


def test_pairs_with_a_condition_on_the_first(skewed):
    data, df = skewed
    want = sorted((u, i, j, a, b) for (u, i, a), (v, j, b) in combinations(sorted(data), 2) if u == v and a > 2)
    assert rows(grouped_pairs(df, "user_id", "item_id", "rating", tile=4, first=F.col("rating") > 2)) == want
    assert rows(grouped_pairs(df, "user_id", "item_id", "rating", first=F.col("rating") > 2)) == want


def test_bpr_draws_are_unrated_and_complete(skewed):
    data, df = skewed
    rated = {(u, i) for u, i, _ in data}
    got = factorization.bpr_triples(df, draws=2).collect()
    assert all((r.user_id, r.pos) in rated and (r.user_id, r.neg) not in rated for r in got)
    assert len(got) == 2 * sum(u != 0 for u, _ in rated)  # user 0 has rated everything


def test_edges_of_users_with_equal_intervals(spark):
    spans = [(1, u, 0.0, 1.0) for u in range(40)] + [(1, 100, 1.0, 2.0), (1, 101, 1.5, 3.0), (1, 102, 5.0, 5.0)]
    df = spark.createDataFrame(spans, "item_id bigint, user_id bigint, lo double, hi double")
    near = {u: {v for _, v, a, b in spans if v != u and a <= hi and b >= lo} for _, u, lo, hi in spans}
    assert {r.user_id: r.neighbours for r in cofiba.user_edges(df).collect()} == {u: len(v) for u, v in near.items()}
