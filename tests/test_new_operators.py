"""Leaf-limited trees, the inverted file and the prefix-filtered similarity join against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillrank.functions.pairs import grouped_pairs
from quillrank.operators import bandit, cofiba, factorization, ivf, keywords, leaf_trees, linucb, metrics, similarity, similarity_join
from quillrank.streaming.sink import LatestRows


@pytest.fixture(scope="module")
def samples(spark):
    rng = random.Random(2)
    rows = []
    for k in range(900):
        x, y, z = rng.randrange(8), rng.random(), rng.choice([None, 1.0, 2.0])
        rows.append((k, int(rng.random() < (0.85 if (x > 3) == (y > 0.4) else 0.15)), x, y, z))
    return spark.createDataFrame(rows, "sample_id long, label int, x int, y double, z double").persist()


EDGES = [[1, 2, 3, 4, 5, 6, 7], [0.2, 0.4, 0.6, 0.8], [2.0]]


def plain_tree(rows, how, prior):
    """Leaves as (rows, value) of one tree, grown best-first."""
    def bins(r):
        return [0 if v is None else sum(e <= v for e in edges) for v, edges in zip((r.x, r.y, r.z), EDGES)]
    p = 1 / (1 + math.exp(-prior))
    cells = [(bins(r), r.label - p, p * (1 - p)) for r in rows]

    def score(part):
        return sum(c[1] for c in part) ** 2 / (sum(c[2] for c in part) + how.penalty)

    def best(part, depth):
        found = None
        for f in range(3):
            for b in sorted({c[0][f] for c in part})[:-1]:
                low, high = [c for c in part if c[0][f] <= b], [c for c in part if c[0][f] > b]
                gain = round(score(low) + score(high) - score(part), 9)
                if depth < how.depth and gain > 0 and (found is None or gain > found[0]):
                    found = (gain, low, high)
        return found

    leaves = [(cells, 0)]
    while len(leaves) < how.leaves:
        offers = [(best(part, depth), k) for k, (part, depth) in enumerate(leaves)]
        offers = [(o, k) for o, k in offers if o]
        if not offers:
            break
        (_, low, high), k = max(offers, key=lambda o: o[0][0])
        depth = leaves.pop(k)[1] + 1
        leaves += [(low, depth), (high, depth)]
    return sorted((len(part), round(sum(c[1] for c in part) / (sum(c[2] for c in part) + how.penalty), 6)) for part, _ in leaves)


@pytest.mark.parametrize("leaves, depth", [(2, 2), (3, 2), (5, 9), (12, 4)])
def test_trees_grow_best_first(samples, leaves, depth):
    how = leaf_trees.Growth(trees=1, leaves=leaves, depth=depth)
    booster = leaf_trees.boost(samples, ["x", "y", "z"], how, edges=EDGES)
    got = sorted((x.n, round(x.value, 6)) for x in booster.trees[0] if x.feature is None)
    assert got == plain_tree(samples.collect(), how, booster.prior) and len(got) <= leaves
    counts = {r.leaf0: r["count"] for r in booster.leaves(samples).groupBy("leaf0").count().collect()}
    assert counts == {x.leaf: x.n for x in booster.trees[0] if x.feature is None}


def nodes(booster, spark):
    return sorted(booster.table(spark).collect(), key=lambda r: (r.tree, r.node))


def test_boosting_repeats_saves_and_learns(spark, samples, tmp_path):
    how = leaf_trees.sampled(trees=12, leaves=4, depth=3, rate=0.3, columns=0.7)
    booster = leaf_trees.boost(samples, ["x", "y", "z"], how)
    again = leaf_trees.boost(samples.repartition(5, "y"), ["x", "y", "z"], how, edges=booster.edges)
    assert nodes(again, spark) == nodes(booster, spark)
    booster.save(spark, str(tmp_path / "trees"))
    loaded = leaf_trees.Booster.load(spark, str(tmp_path / "trees"))
    assert nodes(loaded, spark) == nodes(booster, spark)
    scored = booster.predict(samples)
    assert sorted(map(tuple, loaded.predict(samples).collect())) == sorted(map(tuple, scored.collect()))
    assert {r.metric: r.value for r in metrics.binary_metrics(scored).collect()}["auc"] > 0.8
    for tree in booster.trees:
        assert len({x.feature for x in tree} - {None}) <= 2 and sum(x.feature is None for x in tree) <= 4


def test_trees_of_odd_tables(spark, samples):
    one_class = leaf_trees.boost(samples.filter("label = 1"), ["x"], leaf_trees.Growth(trees=2))
    assert one_class.predict(samples).filter("prediction <> 1").isEmpty()
    flat = leaf_trees.boost(samples.withColumn("x", F.lit(None).cast("int")), ["x"], leaf_trees.Growth(trees=2))
    assert all(len(t) == 1 for t in flat.trees)
    none = leaf_trees.boost(samples.limit(0), ["x"], leaf_trees.Growth(trees=1))
    assert none.predict(samples).count() == 900
    model = leaf_trees.LeavesAndLinear(["x", "y", "z"], leaf_trees.Growth(trees=4, leaves=6, depth=4)).fit(samples)
    assert {r.metric: r.value for r in metrics.binary_metrics(model.predict(samples)).collect()}["auc"] > 0.75


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    rows = [(k, (centres[k % 12] + 0.35 * rng.normal(size=16)).tolist()) for k in range(1500)]
    rows += [(2000 + k, rows[0][1]) for k in range(600)]  # a list with many copies
    rows += [(5000, [0.0] * 16)]
    return spark.createDataFrame(rows, "id long, features array<double>").persist()


def test_neighbours_of_the_inverted_file(spark, vectors, tmp_path):
    index = ivf.build(vectors, lists=24, parts=8, words=32, sample=1000)
    assert index.entries.count() == vectors.count() == sum(index.sizes().values())
    queries = vectors.filter("id % 20 = 0")
    assert ivf.recall(index, queries, probes=24, rerank=1 << 20) == 1.0
    few = {p: ivf.recall(index, queries, probes=p) for p in (1, 8)}
    assert few[8] >= 0.9 and few[1] <= few[8]
    assert ivf.recall(index, queries, probes=ivf.probes_for(index, 0.9)) >= 0.85
    # lists cut into small parts give the same neighbours
    want = sorted(map(tuple, ivf.search(index, queries, probes=24, rerank=1 << 20).collect()))
    assert sorted(map(tuple, ivf.search(index, queries, probes=24, rerank=1 << 20, limit=37).collect())) == want
    index.save(str(tmp_path / "ivf"))
    loaded = ivf.Index.load(spark, str(tmp_path / "ivf"), vectors)
    assert sorted(map(tuple, ivf.search(loaded, queries, probes=24, rerank=1 << 20).collect())) == want


def test_an_index_takes_further_vectors(vectors):
    old = vectors.filter("id < 1000")
    index = ivf.build(old, lists=10, parts=4, words=16).extended(vectors.filter("id >= 1000"))
    assert index.entries.count() == vectors.count()
    assert ivf.recall(index, vectors.filter("id between 1000 and 1040"), probes=10, rerank=1 << 20) == 1.0


@pytest.mark.parametrize("threshold", [0.2, 0.7, 0.95])
def test_similarity_join_equals_the_exact_cosine(spark, threshold):
    rng = random.Random(7)
    cells = [(u, min(int(rng.expovariate(0.05)), 60) if u % 3 else rng.randrange(4), float(rng.randrange(-2, 6)))
             for u in range(90) for _ in range(rng.randrange(1, 15))]
    cells += [(100, 1, 2.0), (101, 1, 5.0), (102, 999, 0.0)]
    ratings = spark.createDataFrame(cells, "user_id long, item_id long, rating double")

    def rounded(found):
        return sorted((r.i, r.j, round(r.sim, 6)) for r in found.collect())
    assert rounded(similarity_join.cosine_join(ratings, threshold=threshold)) == rounded(similarity.cosine(ratings, threshold=threshold))


def test_similarity_join_forms_few_pairs(spark):
    """Popular columns stand last in every row, and hardly any prefix reaches them."""
    rng = random.Random(8)
    cells = {(u, c): float(rng.randrange(1, 6)) for u in range(300) for c in [*rng.sample(range(5), 4), *(10 + rng.randrange(4000) for _ in range(20))]}
    ratings = spark.createDataFrame([(u, c, v) for (u, c), v in cells.items()], "user_id long, item_id long, rating double")
    rows = similarity_join.weighted_cells(ratings, "user_id", "item_id", "rating").persist()
    shared = rows.groupBy("c").count().selectExpr("sum(count * (count - 1) / 2)").first()[0]
    met = grouped_pairs(similarity_join.prefixes(rows, 0.8), "c", "r", "p").count()
    assert met < shared / 50
    with pytest.raises(ValueError):
        similarity_join.cosine_join(ratings, threshold=0.0)


@pytest.fixture(scope="module")
def pulls(spark):
    rng = np.random.default_rng(9)
    rows = [(k, k % 7, f"arm{k % 5}", int(rng.random() < 0.4), rng.normal(size=12).tolist()) for k in range(400)]
    return spark.createDataFrame([*rows, (900, 3, "arm1", 1, None), (901, 3, "arm1", None, [1.0] * 12)],
                                 "event_id long, user_id long, arm string, reward int, x array<double>").persist()


def test_ridge_sums_of_any_layout(pulls):
    """Pulls without x only count, pulls without reward leave b alone."""
    rows = pulls.collect()
    for frame in (pulls.repartition(1), pulls.repartition(9, "event_id")):
        for r in linucb.ridge_sums(frame, "arm", 12, 0.5).collect():
            own = [p for p in rows if p.arm == r.arm]
            a = sum((np.outer(p.x, p.x) for p in own if p.x), 0.5 * np.eye(12))
            b = sum(np.array(p.x) * (p.reward or 0) for p in own if p.x)
            assert r.n == len(own) and r.a == pytest.approx(a.ravel().tolist()) and r.b == pytest.approx(b.tolist())


def test_linucb_in_blocks_equals_the_broadcast(pulls):
    state = linucb.linucb_state(pulls.filter("x is not null"), 12)
    asked = pulls.filter("x is not null")
    one = sorted(map(tuple, linucb.linucb_select(asked, "event_id", state).collect()))
    assert sorted(map(tuple, linucb.linucb_select(asked, "event_id", state, broadcast_bytes=0).collect())) == one


def test_cluster_sums_are_those_of_the_members(spark, pulls):
    state = cofiba.user_state(pulls, 12)
    users = {r.user_id: r for r in state.collect()}
    members = [(item, u, (u * item) % 3) for item in range(40) for u in users]
    clusters = spark.createDataFrame(members, "item_id long, user_id long, cluster long")
    got = cofiba.cluster_state(clusters, state, 12).collect()
    assert len(got) == len({(i, c) for i, _, c in members})
    for r in got:
        own = [users[u] for i, u, c in members if (i, c) == (r.item_id, r.cluster)]
        a = sum(np.array(u.a) - 0.1 * np.eye(12).ravel() for u in own) + 0.1 * np.eye(12).ravel()
        assert r.users == len(own) and r.a == pytest.approx(a.tolist()) and r.b == pytest.approx(sum(np.array(u.b) for u in own).tolist())


def plain_replay(log):
    """What UCB1 would pull, one event after the other."""
    arms = sorted({p.arm for p in log})
    n, w, out = dict.fromkeys(arms, 0), dict.fromkeys(arms, 0.0), []
    for t, p in enumerate(sorted(log, key=lambda p: (p.t, p.event_id))):
        score = {a: round((w[a] / n[a] if n[a] else 0.0) + math.sqrt(2 * math.log(1 + t) / (1 + n[a])), 6) for a in arms}
        best = max(arms, key=lambda a: (score[a], [-ord(c) for c in a]))
        out.append((p.event_id, p.arm, best, score[best]))
        n[p.arm] += 1
        w[p.arm] += p.reward or 0
    return sorted(out)


def test_replay_in_slices_equals_the_sequence(spark):
    rng = random.Random(4)
    rows = [(k, rng.randrange(40), f"arm{rng.randrange(12):02d}", rng.choice([0, 1, None])) for k in range(700)]
    log = spark.createDataFrame(rows, "event_id long, t long, arm string, reward int").persist()
    want = plain_replay(log.collect())
    for size in (50_000, 40):
        got = sorted(map(tuple, bandit.replay_ucb(log, slice_rows=size).collect()))
        assert [g[:3] for g in got] == [x[:3] for x in want] and [g[3] for g in got] == pytest.approx([x[3] for x in want], abs=2e-6)


def test_replay_with_thousands_of_arms(spark):
    log = spark.range(6000).select(F.col("id").alias("event_id"), F.col("id").alias("t"), (F.col("id") % 5000).alias("arm"),
                                   (F.col("id") % 3 == 0).cast("int").alias("reward"))
    got = {r.event_id: (r.ucb_arm, r.ucb) for r in bandit.replay_ucb(log).collect()}
    assert len(got) == 6000 and got[0] == (0, 0.0)
    # once the bonus outweighs a reward, an arm never pulled comes first until all have been pulled
    assert all(got[t][0] == t for t in range(400, 5000))


def test_gamma_draws_have_their_moments(spark):
    draws = spark.range(20_000).select(*[bandit.gamma_draw(F.lit(a), "t", F.col("id"), a).alias(f"g{k}") for k, a in enumerate((1.0, 4.5, 300.0))])
    for k, a in enumerate((1.0, 4.5, 300.0)):
        x = draws.agg(F.avg(f"g{k}").alias("m"), F.var_samp(f"g{k}").alias("v"), F.min(f"g{k}").alias("low")).first()
        assert x.m == pytest.approx(a, rel=0.03) and x.v == pytest.approx(a, rel=0.08) and x.low > 0


def batches(spark, n):
    return [spark.createDataFrame([(k, b) for k in ("a", f"k{b % 7}", f"own{b}")], "key string, value int") for b in range(n)]


def folders(path):
    return {name: sorted(x.name for x in (path / name).iterdir() if x.name.startswith("n=")) for name in ("rows", "snapshots", "commits")}


def want_of(n):
    return dict([(f"k{b % 7}", b) for b in range(n)] + [(f"own{b}", b) for b in range(n)] + [("a", n - 1)])


def test_a_compacted_table_stays_small(spark, tmp_path):
    table = LatestRows(spark, str(tmp_path), ["key"], every=4)
    for number, batch in enumerate(batches(spark, 18)):
        table.write(batch, number)
    assert folders(tmp_path) == {"rows": ["n=16", "n=17"], "snapshots": ["n=15"], "commits": ["n=15"]}
    assert {r.key: r.value for r in table.rows().collect()} == want_of(18)
    table.write(batches(spark, 1)[0], 9)  # repeated after its snapshot: nothing changes
    assert {r.key: r.value for r in table.rows().collect()} == want_of(18)


@pytest.mark.parametrize("when", ["before the commit", "after the commit"])
def test_a_kill_during_compaction_loses_nothing(spark, tmp_path, when):
    class Killed(LatestRows):
        def commit(self, number):
            if when == "after the commit":
                super().commit(number)
            raise KeyboardInterrupt

    rows = batches(spark, 10)
    table = LatestRows(spark, str(tmp_path), ["key"], every=5)
    for number in range(9):
        table.write(rows[number], number)
    with pytest.raises(KeyboardInterrupt):
        Killed(spark, str(tmp_path), ["key"], every=5).write(rows[9], 9)
    assert {r.key: r.value for r in table.rows().collect()} == want_of(10)
    table.write(rows[9], 9)  # the batch is repeated after the restart
    assert {r.key: r.value for r in table.rows().collect()} == want_of(10)
    assert table.committed() == 9


def test_stop_words_are_a_table(spark):
    docs = spark.createDataFrame([(1, ["aa", "bb", "aa"]), (2, ["aa", "cc"]), (3, ["aa"]), (4, [])], "doc_id long, words array<string>")
    stop = keywords.common_words(docs, 0.5)
    assert {tuple(r) for r in stop.collect()} == {("aa", 3)}
    left = keywords.without_stop_words(keywords.term_frequency(docs), stop)
    assert {tuple(r) for r in left.collect()} == {(1, "bb", 1), (2, "cc", 1)}


def test_waves_give_what_the_sequence_gives():
    rng = np.random.default_rng(3)
    user, item = np.minimum(rng.integers(0, 30, 500), 25), np.minimum(rng.geometric(0.1, 500), 40)
    value, x, y = rng.normal(size=500), rng.normal(size=(30, 4)), rng.normal(size=(41, 4))
    a, b = x.copy(), y.copy()
    for u, i, r in zip(user, item, value):
        error = r - a[u] @ b[i]
        a[u] += 0.05 * (error * b[i] - 0.1 * a[u])
        b[i] += 0.05 * (error * a[u] - 0.1 * b[i])
    factorization.sgd_pass(x, y, user, item, value, 0.05, 0.1)
    assert x == pytest.approx(a) and y == pytest.approx(b)
    seen = np.concatenate(list(factorization.waves(user, item)))
    assert sorted(seen.tolist()) == list(range(500))
    for now in factorization.waves(user, item):
        assert len(set(user[now])) == len(now) == len(set(item[now]))


def test_sgd_takes_string_ids_on_any_number_of_workers(spark):
    ratings = spark.range(400).select(F.concat(F.lit("u"), F.col("id") % 23).alias("user_id"), F.concat(F.lit("i"), F.hash("id") % 11).alias("item_id"),
                                      (F.col("id") % 5).cast("double").alias("rating")).dropDuplicates(["user_id", "item_id"]).persist()
    one, many = (factorization.stratified_sgd(frame, k=3, epochs=1, blocks=3) for frame in (ratings.coalesce(1), ratings.repartition(7)))
    for mine, other in zip(one, many):
        got = {r.id: list(r.features) for r in mine.collect()}
        assert got == {r.id: list(r.features) for r in other.collect()} and all(isinstance(k, str) for k in got)
    assert one[0].count() == 23
