"""Small hand-checked results."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from quillrank.operators import metrics, similarity, slope_one, tags
from quillrank.operators.keywords import textrank_keywords, tfidf_keywords

MATRIX = [(0, 0, 5.0), (0, 2, 2.0), (1, 1, 4.0), (1, 2, 3.0), (2, 0, 3.0), (2, 1, 3.0), (2, 2, 5.0)]


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.createDataFrame(MATRIX, "user_id bigint, item_id bigint, rating double")


def rows(df, digits=6):
    return sorted(tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_deviations(ratings):
    assert rows(slope_one.deviations(ratings).select("i", "j", "dev", "common")) == [
        (0, 1, 0.0, 1), (0, 2, 0.5, 2), (1, 2, -0.5, 2)]


def test_recommendations(ratings):
    assert rows(slope_one.recommend(ratings)) == [(0, 1, 2.666667, 1), (1, 0, 3.666667, 1)]


def test_recommendations_with_rated(ratings):
    got = {(u, i): s for u, i, s, _ in rows(slope_one.recommend(ratings, include_rated=True))}
    assert got[1, 1] == 2.5 and got[1, 2] == 4.5 and got[1, 0] == 3.666667


@pytest.mark.parametrize("form", [similarity.cosine, similarity.dimsum])
def test_row_cosine(ratings, form):
    assert rows(form(ratings)) == [(1, 0, 0.222834), (2, 0, 0.707957), (2, 1, 0.823492)]


def test_duplicate_cells_are_added(spark, ratings):
    halves = ratings.selectExpr("user_id", "item_id", "rating / 2 rating")
    assert rows(similarity.cosine(halves.unionAll(halves))) == rows(similarity.cosine(ratings))


@pytest.mark.parametrize("samples, area", [
    ([("1", .6), ("0", .1)], 1.0),
    ([("1", .9), ("0", .9), ("1", .4), ("0", .2), ("0", .4)], 0.666667),
    ([("1", .3), ("1", .2)], 0.5)])
def test_auc(spark, samples, area):
    got = metrics.auc(spark.createDataFrame(samples, "label string, score double")).first()
    assert round(got.auc, 6) == area


def test_auc_agrees_with_the_exact_evaluator(spark):
    df = spark.range(500).selectExpr("cast(pmod(hash(id), 3) = 0 as double) label", "cast(pmod(hash(id, 1), 40) as double) score")
    exact = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert metrics.auc(df, positive=1.0).first().auc == pytest.approx(exact)


@pytest.fixture(scope="module")
def corpus(spark):
    lines = [("sport", ["ball", "goal"]), ("sport", ["ball"]), ("tech", ["chip"]), ("tech", ["chip", "ball"])]
    return spark.createDataFrame([(k, *line) for k, line in enumerate(lines)],
                                 "doc_id bigint, category string, tags array<string>")


def test_information_gain(corpus):
    assert rows(tags.info_gain(corpus)) == [("ball", 0.215762), ("chip", 0.693147), ("goal", 0.215762)]


def test_chi_square(corpus):
    assert rows(tags.chi_square(corpus)) == [
        ("sport", "ball", 1.333333), ("sport", "goal", 1.333333), ("tech", "ball", 1.333333), ("tech", "chip", 4.0)]


def test_tag_in_every_document_has_no_chi(spark):
    both = spark.createDataFrame([(1, "a", ["x"]), (2, "b", ["x"])], "doc_id bigint, category string, tags array<string>")
    assert [r.chi for r in tags.chi_square(both).collect()] == [None, None]
    assert rows(tags.info_gain(both)) == [("x", 0.0)]


def test_unknown_word_gets_mean_idf(spark):
    words = spark.createDataFrame([(1, ["aa", "aa", "bb", "zz"])], "doc_id bigint, words array<string>")
    lexicon = spark.createDataFrame([("aa", 1.0), ("bb", 3.0)], "word string, idf double")
    assert rows(tfidf_keywords(words, lexicon)) == [(1, "aa", 2.0, 2), (1, "bb", 3.0, 1), (1, "zz", 2.0, 3)]


def test_textrank_two_words(spark):
    words = spark.createDataFrame([(1, ["aa", "bb"]), (2, ["solo"]), (3, [])], "doc_id bigint, words array<string>")
    assert rows(textrank_keywords(words)) == [(1, "aa", 1.0, 1), (1, "bb", 1.0, 2), (2, "solo", 0.15, 1)]
