"""Invariants of trained models."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillrank.functions import network
from quillrank.functions.network import Shape
from quillrank.operators import bandit, factorization as mf, metrics, online_topics, topics, trainer

SHAPES = [Shape(12, 3, k=2, ffm=True), Shape(12, 3, k=2, fm=True, layers=(5, 4)),
          Shape(12, 3, k=2, fm=True, layers=(5,), batch_norm=True),
          Shape(12, 3, k=2, linear=False, numeric=2, wide=9, layers=(6, 3))]


@pytest.mark.parametrize("shape", SHAPES)
def test_gradient_matches_differences(shape):
    rng = np.random.default_rng(1)
    batch = {"idx": rng.integers(0, 4, (7, 3)) + np.arange(3) * 4, "val": rng.random((7, 3)),
             "wide": rng.integers(0, 9, (7, 2)), "num": rng.normal(size=(7, 2)), "label": rng.integers(0, 2, 7).astype(float)}
    p = {n: a + rng.normal(0, 0.3, a.shape) for n, a in network.init(shape).items()}
    _, grad = network.run(p, shape, **batch)
    for name in p:
        if network.statistic(name):
            continue
        at = tuple(rng.integers(0, s) for s in p[name].shape) if name != "w" else (int(batch["idx"][0, 0]),)
        losses = []
        for h in (1e-5, -1e-5):
            moved = {n: a.copy() for n, a in p.items()}
            moved[name][at] += h
            losses.append(network.run(moved, shape, **batch)[0])
        assert grad[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-3, abs=1e-5), name


@pytest.fixture(scope="module")
def clicks(spark):
    """Label depends on an interaction of two fields."""
    a, b = F.col("id") % 4, F.floor(F.col("id") / 4) % 4
    return spark.range(2000).select(
        F.col("id").alias("sample_id"), ((a < 2) == ((b < 2) == (F.hash("id") % 10 != 0))).cast("int").alias("label"),
        F.array(a.cast("int"), (b + 4).cast("int"), F.lit(8)).alias("idx"), F.array(*[F.lit(1.0)] * 3).alias("val"),
        F.array((a * 2).cast("int")).alias("wide"), F.array(a * 0.1, b * 0.1).alias("num"))


@pytest.mark.parametrize("shape, rate", [
    (Shape(12, 3, k=2, ffm=True, l2=1e-4), 0.1),
    (Shape(12, 3, k=4, fm=True, layers=(8,), batch_norm=True, dropout=0.1), 0.1),
    (Shape(12, 3, k=4, linear=False, numeric=2, wide=9, layers=(10, 5)), 0.02)])
def test_training_lowers_loss_and_ranks(spark, clicks, shape, rate):
    model = trainer.train(clicks, shape, batch=500, epochs=4, how=trainer.Adam(rate=rate))
    assert model.steps == len(model.losses) >= 12 and np.mean(model.losses[-4:]) < np.mean(model.losses[:4]) - 0.03
    scored = trainer.score(clicks, model)
    assert scored.count() == 2000 and scored.filter("probability < 0 or probability > 1").isEmpty()
    values = {r.metric: r.value for r in metrics.binary_metrics(scored).collect()}
    assert values["auc"] > 0.7 and math.isfinite(values["logloss"])


DEEP = Shape(12, 3, k=3, fm=True, ffm=True, numeric=2, wide=9, layers=(6, 4), batch_norm=True, dropout=0.2, l2=1e-3)


def parameters(model):
    return {(r["name"], r["key"]): (r["n"], tuple(r["values"]), tuple(r["m1"])) for r in model.rows().collect()}


def test_models_do_not_depend_on_the_layout(spark, clicks):
    """Partitions, Arrow batches, shards and compaction change nothing, not even the last bit."""
    def trained(rows, **more):
        return parameters(trainer.train(rows, DEEP, batch=700, chunk=128, epochs=1, **more))

    one = trained(clicks.coalesce(1), shards=1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        assert trained(clicks.repartition(7, "label"), shards=5, compact=2) == one
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {n for n, _ in one} >= {"f", "x", "bias", "W0", "W2", "gamma1", "var0"} and len(one) > 30


def test_small_models_stay_with_the_driver_and_are_the_same(spark, clicks, monkeypatch):
    """A step of a small model is one job; the table's way gives the same bits, from the start and continued."""
    def trained(batch=700, **more):
        return trainer.train(clicks, DEEP, batch=batch, chunk=128, **more)

    spark.sparkContext.setJobGroup("steps", "steps")
    many = trained(batch=100)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert many.steps == 20 and len(spark.sparkContext.statusTracker().getJobIdsForGroup("steps")) < 2 * many.steps
    whole = trained()
    more = trained(start=whole)
    monkeypatch.setattr(trainer, "RESIDENT", 0)
    table = trained(shards=5, compact=2)
    assert parameters(whole) == parameters(table) and whole.losses == table.losses
    assert parameters(more) == parameters(trained(start=table)) and parameters(whole) == parameters(table)


def test_a_saved_model_goes_on_as_if_it_had_not_stopped(spark, clicks, tmp_path):
    whole = trainer.train(clicks, DEEP, batch=3000, epochs=2, chunk=3000)
    half = trainer.train(clicks, DEEP, batch=3000, chunk=3000)
    half.save(str(tmp_path / "model"))
    again = trainer.Model.load(spark, str(tmp_path / "model"))
    assert again.shape == DEEP and again.steps == 1 and again.losses == half.losses
    assert parameters(again) == parameters(half)
    # one batch holds all samples, so the epochs differ in nothing but their number
    more = trainer.train(clicks, DEEP, batch=3000, chunk=3000, start=again)
    assert {k: v[0] for k, v in parameters(more).items()} == {k: v[0] for k, v in parameters(whole).items()}
    assert parameters(more) == parameters(whole) and parameters(again) == parameters(half)
    scores = {r.sample_id: r.logit for r in trainer.score(clicks, whole).collect()}
    assert {r.sample_id: r.logit for r in trainer.score(clicks.repartition(3), more, chunk=100).collect()} == pytest.approx(scores)


def test_features_have_no_bound(spark):
    """Ids beyond any array, seen in training or only in scoring."""
    shape = Shape(0, 2, k=2, fm=True)
    rows = spark.range(60).select(F.col("id").alias("sample_id"), (F.col("id") % 2).cast("int").alias("label"),
                                  F.array(F.col("id") * 10 ** 15, F.lit(-5)).alias("idx"), F.array(F.lit(1.0), F.lit(0.5)).alias("val"))
    model = trainer.train(rows.filter("sample_id < 40"), shape, batch=16)
    assert model.rows().filter("name = 'f'").count() == 41
    assert trainer.score(rows, model).filter("probability between 0 and 1").count() == 60


def test_counted_normals():
    x = network.normals(3, np.arange(20000)[:, None], np.arange(5)[None, :])
    assert abs(x.mean()) < 0.02 and abs(x.std() - 1) < 0.02 and len(np.unique(x)) == x.size
    assert np.array_equal(x[17:19, 2], network.normals(3, np.array([17, 18]), 2))


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.range(600).select((F.col("id") % 30).alias("user_id"), (F.hash("id") % 20 + 20).alias("item_id").cast("bigint"),
                                   F.lit(1.0).alias("one")).groupBy("user_id", "item_id").agg(
        (F.pmod(F.hash("user_id", "item_id"), F.lit(5)) + 1).cast("double").alias("rating")).persist()


def test_als_step_solves_the_ridge_problem(ratings):
    items = mf.init_factors(ratings, "item_id", 3, "t", -0.5, 0.5)
    got = {r.id: r.features for r in mf.als_step(ratings, items, 3).collect()}
    y = {r.id: np.array(r.features) for r in items.collect()}
    cells = ratings.collect()
    for u in list(got)[:5]:
        a = sum(np.outer(v, v) for v in y.values()) + 10 * np.eye(3)
        b = np.zeros(3)
        for r in cells:
            if r.user_id == u:
                a, b = a + 40 * r.rating * np.outer(y[r.item_id], y[r.item_id]), b + (1 + 40 * r.rating) * y[r.item_id]
        assert got[u] == pytest.approx(list(np.linalg.solve(a, b)))


def test_sgd_lowers_rmse(ratings):
    start = mf.init_factors(ratings, "user_id", 4, "sgd:u"), mf.init_factors(ratings, "item_id", 4, "sgd:i")
    before = mf.rmse(ratings, *start).first()[0]
    users, items = mf.stratified_sgd(ratings, k=4, epochs=2, step=0.02, blocks=2)
    assert mf.rmse(ratings, users, items).first()[0] < before
    assert users.count() == ratings.select("user_id").distinct().count()


def test_bpr_negatives_are_unrated(ratings):
    triples = mf.bpr_triples(ratings, draws=3)
    assert triples.join(ratings.selectExpr("user_id", "item_id neg"), ["user_id", "neg"]).isEmpty()
    assert triples.count() > 0


@pytest.fixture(scope="module")
def two_themes(spark):
    themes = (["goal", "ball", "team", "match"], ["chip", "code", "disk", "byte"])
    docs = [(d, [themes[d % 2][(k + k // 3 * d) % 4] for k in range(12)]) for d in range(40)]
    return spark.createDataFrame(docs, "doc_id bigint, words array<string>")


def test_online_topics_separate_themes_and_grow(spark, two_themes):
    weights = online_topics.train(two_themes, 2, rounds=6)
    mixed = {r.doc_id: r.topics for r in online_topics.infer(two_themes, weights, 2).collect()}
    assert all(sum(t) == pytest.approx(1.0) for t in mixed.values())
    sides = {d % 2: int(np.argmax(t)) for d, t in mixed.items()}
    assert sides[0] != sides[1] and all(int(np.argmax(t)) == sides[d % 2] for d, t in mixed.items())
    more = spark.createDataFrame([(99, ["goal", "newword"])], "doc_id bigint, words array<string>")
    grown = online_topics.update(more, 2, weights, updates=6)
    assert {r.word for r in grown.collect()} == {r.word for r in weights.collect()} | {"newword"}


def test_digamma():
    x = np.array([0.1, 1.0, 3.5, 20.0])
    h = 1e-5
    want = [(math.lgamma(v + h) - math.lgamma(v - h)) / (2 * h) for v in x]
    assert online_topics.digamma(x) == pytest.approx(want, rel=1e-6)


def test_builtin_lda_and_word2vec(spark, two_themes, tmp_path):
    model = topics.train_lda(two_themes, topics=2, rounds=5)
    rows = topics.infer_topics(model, two_themes).collect()
    assert all(sum(r.topics) == pytest.approx(1.0) for r in rows)
    assert topics.topic_words(model, 3).count() == 6
    path = str(tmp_path / "lda")
    model.write().overwrite().save(path)
    assert topics.infer_topics(type(model).load(path), two_themes).count() == 40
    vectors = topics.train_embedding(two_themes, size=4, min_count=1, epochs=1)
    assert topics.similar_words(vectors, "goal", 3).count() == 3
    vectors.write().overwrite().save(str(tmp_path / "w2v"))
    from pyspark.ml.feature import Word2VecModel
    assert Word2VecModel.load(str(tmp_path / "w2v")).getVectors().count() == 8


def test_thompson_draws_repeat_and_prefer_the_better_arm(spark):
    pulls = spark.range(200).select((F.col("id") % 2).cast("string").alias("arm"),
                                    (F.col("id") % 4 != 1).cast("long").alias("reward"))
    requests = spark.range(100).select(F.col("id").alias("event_id"))
    first = bandit.thompson_select(requests, pulls).toPandas().sort_values("event_id")
    again = bandit.thompson_select(requests.repartition(5), pulls).toPandas().sort_values("event_id")
    assert first.arm.tolist() == again.arm.tolist()
    assert (first.arm == "0").mean() > 0.9
