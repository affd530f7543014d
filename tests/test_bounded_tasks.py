"""What a task holds at once, and what it moves, does not grow with the batch or the table it is given."""

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from quillrank.functions.columns import uniform
from quillrank.operators import cofiba, ctr_features, ivf, keywords, linucb, online_topics, topics, vectors


class Captured:
    """Stands for a table of documents and keeps the function that the operator gives to it."""

    def __init__(self, spark):
        self.schema = spark.createDataFrame([], "doc_id bigint, words array<string>").schema

    def select(self, *_):
        return self

    def mapInArrow(self, work, schema):
        self.work = work
        return self


def batch(docs):
    return pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs], pa.int64()), pa.array([w for _, w in docs], pa.list_(pa.string()))],
                                      ["doc_id", "words"])


def test_textrank_hands_on_few_rows_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(keywords, "HELD_ROWS", 50)
    docs = [(d, [f"w{(d + k * k) % 9}" for k in range(12)]) for d in range(40)]
    for operator in (keywords.textrank_edges, lambda words: keywords.textrank_weights(words, 8, 0.85, 10, None)):
        table = Captured(spark)
        operator(table)
        sizes = [b.num_rows for b in table.work(iter([batch(docs)]))]
        assert len(sizes) > 3
        assert max(sizes) <= 50 + 72  # the rows of one document more


def test_textrank_of_missing_and_long_words(spark):
    long = ["x" * 300_000] + [f"w{k}" for k in range(5000)]
    words = spark.createDataFrame([(1, None), (2, ["a", None, "b"]), (3, long), (4, ["tail", "tail\0"])], "doc_id bigint, words array<string>")
    edges = {(r.doc_id, r.src, r.dst): r.weight for r in keywords.textrank_edges(words).filter("doc_id <> 3").collect()}
    assert edges == {(2, "a", "b"): 1.0, (2, "b", "a"): 1.0, (4, "tail", "tail\0"): 1.0, (4, "tail\0", "tail"): 1.0}
    assert sorted({r.doc_id for r in keywords.textrank_keywords(words).collect()}) == [2, 3, 4]


def test_textrank_keeps_words_that_rounding_makes_equal(spark):
    """More words than ``top`` share the last weight; the smaller word goes first."""
    docs = [[f"w{k}" for k in range(30)], [f"w{(k * k) % 13}" for k in range(60)], ["b", "a"] * 4 + ["c"]]
    words = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, words array<string>")
    every = sorted(map(tuple, keywords.textrank_keywords(words, top=None).collect()))
    for top in (1, 2, 5):
        assert sorted(map(tuple, keywords.textrank_keywords(words, top=top).collect())) == [r for r in every if r[3] <= top]


def test_rare_keys_travel_as_they_are(spark, monkeypatch):
    """A batch in which each key has one pull hands on its vectors, not a matrix a key; a frequent key becomes one row."""
    steps, kind = [], type(spark.range(1))
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, work, schema, **more: steps.append(work) or plain(self, work, schema, **more))
    d = 16
    rows = [(k if k < 300 else None if k < 310 else -1, [float((k * j) % 7) for j in range(d)], float(k % 2)) for k in range(600)]
    rows += [(None, None, 1.0), (5, None, None), (6, [1.0] * d, None)]
    pulls = spark.createDataFrame(rows, "user_id bigint, x array<double>, reward double").coalesce(1)
    got = {r.user_id: r for r in linucb.ridge_sums(pulls, "user_id", d, 0.5).collect()}
    assert set(got) == {r[0] for r in rows}
    for key, r in got.items():
        own = [p for p in rows if p[0] == key]
        a = sum((np.outer(p[1], p[1]) for p in own if p[1]), 0.5 * np.eye(d))
        b = sum((np.array(p[1]) * (p[2] or 0) for p in own if p[1]), np.zeros(d))
        assert r.n == len(own) and np.allclose(r.a, a.ravel()) and np.allclose(r.b, b)
    given = pa.RecordBatch.from_arrays([pa.array([p[0] for p in rows], pa.int64()), pa.array([p[1] for p in rows], pa.list_(pa.float64())),
                                        pa.array([p[2] for p in rows], pa.float64())], ["k", "x", "r"])
    handed = list(steps[0](iter([given])))
    assert sum(b.nbytes for b in handed) < 1.5 * given.nbytes
    assert sum(b.num_rows - b.column("sums").null_count for b in handed) == 2  # the frequent keys: -1 and null


def test_clusters_do_not_depend_on_blocks(spark, monkeypatch):
    rows = [(u, [float((u * j) % 5) for j in range(6)], float(u % 2)) for u in range(30)]
    state = cofiba.user_state(spark.createDataFrame(rows, "user_id bigint, x array<double>, reward double"), 6).persist()
    clusters = spark.createDataFrame([(i, u, (u * i) % 3) for i in range(9) for u in range(30)], "item_id bigint, user_id bigint, cluster bigint")
    found = []
    for size in (64, 4):
        monkeypatch.setattr(cofiba, "BLOCK", size)
        found.append(sorted((r.item_id, r.cluster, r.users, np.round(r.a, 9).tolist(), np.round(r.b, 9).tolist())
                            for r in cofiba.cluster_state(clusters, state, 6).collect()))
    assert found[0] == found[1] and len(found[0]) == len({(i, (u * i) % 3) for i in range(9) for u in range(30)})


def brute(ids, rows, names, others, k):
    found = []
    for i, x in zip(ids, rows):
        near = sorted((-round(float(x @ y), 6), int(n)) for n, y in zip(names, others) if n != i and not np.isnan(x @ y))
        found += [(int(i), n, -s) for s, n in near[:k]]
    return sorted(found)


def test_blocks_of_neighbours_are_compared_in_strips():
    """The k best with ties and missing numbers; few rows more leave a block, and its products are never held as a whole."""
    rng = np.random.default_rng(3)
    others = rng.integers(-2, 3, (300, 4)).astype(float)
    others[7, 1] = np.nan
    names = np.arange(300)
    for k in (1, 5, 299, 400):
        got = vectors.best_of_block(names, others, names, others, k).sort_values(["id", "sim", "neighbour"], ascending=[True, False, True])
        got = got.groupby("id").head(k)
        assert sorted(zip(got.id, got.neighbour, got.sim)) == brute(names, others, names, others, k)
    wide = rng.normal(size=(4096, 16))
    tracemalloc.start()
    got = vectors.best_of_block(np.arange(2048), wide[:2048], np.arange(4096), wide, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6 and len(got) < 2048 * 20  # the products of the block alone would take 67 MB


def test_nearest_has_the_neighbours_of_all_blocks(spark):
    rng = np.random.default_rng(5)
    rows = [(k, x.tolist()) for k, x in enumerate(rng.integers(-3, 4, (60, 3)).astype(float))]
    frame = spark.createDataFrame(rows, "id bigint, features array<double>")
    unit = vectors.unit_rows(pd.Series([np.array(x) for _, x in rows]))
    got = sorted((r.id, r.neighbour, r.sim) for r in vectors.nearest(frame, frame, k=4, block=16).collect())
    assert got == brute(np.arange(60), unit, np.arange(60), unit, 4)


def test_inverted_file_makes_few_numbers_at_once(spark, monkeypatch):
    monkeypatch.setattr(ivf, "HELD", 1 << 10)
    frame = pd.DataFrame({"id": range(100)})
    parts = list(ivf._strips(frame, 64))
    assert max(map(len, parts)) == 16 and pd.concat(parts).equals(frame) and max(map(len, ivf._strips(frame, 1 << 20))) == 1


def test_full_reranking_hands_on_no_pairs(spark):
    """With all entries ranked again only the final ranking is left; repeated ids count as before."""
    rng = np.random.default_rng(6)
    rows = [(k, x.tolist()) for k, x in enumerate(rng.normal(size=(80, 4)))]
    frame = spark.createDataFrame(rows, "id bigint, features array<double>")
    index = ivf.build(frame, lists=5, parts=2, words=8)
    found = ivf.search(index, frame.filter("id % 4 = 0"), k=3, probes=5, rerank=1 << 30, limit=10)
    unit = vectors.unit_rows(pd.Series([np.array(x) for _, x in rows]))
    assert sorted((r.id, r.neighbour, r.sim) for r in found.collect()) == brute(np.arange(0, 80, 4), unit[::4], np.arange(80), unit, 3)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Window ") == 1
    twice = ivf.build(frame.unionByName(frame), index.quantiser)
    few = ivf.search(twice, frame.filter("id = 8"), k=6, probes=5, rerank=1 << 30).orderBy("rank").collect()
    (_, first, _), (_, second, _) = sorted(brute([8], unit[8:9], np.arange(80), unit, 2), key=lambda r: -r[2])
    assert [r.neighbour for r in few] == [first] * 4 + [second] * 2


def test_vocabulary_reads_the_text_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(n):
        read.add(1)
        return [f"w{n % 7}", f"v{n}"]

    texts = spark.range(40).coalesce(1).select((F.col("id") < 10).alias("old"), F.udf(seen, "array<string>")("id").alias("words"))
    first = topics.vocabulary(texts.filter("old"))
    rows = topics.extend_vocabulary(first, texts).collect()
    assert sorted(r.id for r in rows) == list(range(47)) and len({r.word for r in rows}) == 47
    assert {r.word for r in rows if r.id < 17} == {f"w{n}" for n in range(7)} | {f"v{n}" for n in range(10)}
    assert read.value <= 2 * 50


def test_documents_are_solved_together_as_one_by_one(monkeypatch):
    """Each document settles in its own number of rounds; a task holds a bounded number of words."""
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 60, 50)
    weight, counts = rng.gamma(0.4, 3.0, (sizes.sum(), 4)) + 0.01, rng.integers(1, 9, sizes.sum()).astype(float)
    total = weight.sum(0)
    beta = np.exp(online_topics.digamma(weight) - online_topics.digamma(total))
    gamma, stats = online_topics.documents_step(counts, sizes, beta, 0.25)
    ends = np.cumsum(sizes)
    for d, (a, b) in enumerate(zip(ends - sizes, ends)):
        one, own = online_topics.document_step(counts[a:b], beta[a:b], 0.25)
        assert np.allclose(gamma[d], one, rtol=1e-9) and np.allclose(stats[a:b], own, rtol=1e-9)
    monkeypatch.setattr(online_topics, "HELD_WORDS", 100)
    frame = pd.DataFrame([(d, counts[a:b], list(weight[a:b]), total) for d, (a, b) in enumerate(zip(ends - sizes, ends))],
                         columns=["doc_id", "tf", "weight", "total"])
    parts = list(online_topics._documents(frame, 0.25))
    assert len(parts) > 5 and max(len(s) for _, _, s in parts) <= 160
    assert np.allclose(np.concatenate([g for _, g, _ in parts]), gamma) and np.allclose(np.concatenate([s for _, _, s in parts]), stats)


def solved_by_hand(docs, weights, topics, rate):
    """(weights, mixtures) of one step of online topics, document by document."""
    total = np.sum(list(weights.values()), axis=0)
    stats, mixed = {w: np.zeros(topics) for w in weights}, {}
    for d, words in docs.items():
        named = sorted(set(words))
        beta = np.exp(online_topics.digamma(np.array([weights[w] for w in named])) - online_topics.digamma(total))
        gamma, own = online_topics.document_step(np.array([words.count(w) for w in named], float), beta, 1 / topics)
        mixed[d] = gamma / gamma.sum()
        for w, s in zip(named, own):
            stats[w] += s
    return {w: (1 - rate) * weights[w] + rate * (1 / topics + stats[w]) for w in weights}, mixed


def test_topics_of_many_chunks_and_parts_are_those_of_single_documents(spark, monkeypatch):
    """All documents take part in each step; rows that share their id are one document, but apart if asked for."""
    rng = np.random.default_rng(6)
    rows = [(d % 25, [f"w{k}" for k in rng.integers(0, 40, rng.integers(0, 30))]) for d in range(30)]
    docs = {}
    for d, words in rows:
        docs[d] = docs.get(d, []) + words
    docs = {d: words for d, words in docs.items() if words}
    monkeypatch.setattr(online_topics, "HELD_WORDS", 50)
    df = spark.createDataFrame(rows, "doc_id bigint, words array<string>").repartition(3)
    weights = {w: online_topics.first_weights([w], 3, "lda:7")[0] for w in {w for words in docs.values() for w in words}}
    for done in range(2):
        weights, _ = solved_by_hand(docs, weights, 3, (1.0 + done) ** -0.5)
    _, mixed = solved_by_hand(docs, weights, 3, 1.0)
    first = spark.createDataFrame([("lda:7", w, k) for w in weights for k in range(3)], "s string, w string, k int").select(
        "w", "k", (uniform(F.col("s"), F.col("w"), F.col("k")) + 0.5).alias("u"))
    assert {(r.w, r.k): r.u for r in first.collect()} == {(w, k): online_topics.first_weights([w], 3, "lda:7")[0][k] for w in weights for k in range(3)}
    got = topics.train_lda(df, topics=3, rounds=2)
    found = {r.word: r.weight for r in got.weights.collect()}
    assert found.keys() == weights.keys()
    assert all(np.allclose(found[w], weights[w], rtol=1e-9) for w in weights)
    assert {r.doc_id: tuple(np.round(r.topics, 9)) for r in online_topics.infer(df, got.weights, 3).collect()} == {d: tuple(np.round(m, 9)) for d, m in mixed.items()}
    every = topics.infer_topics(got, df.unionByName(spark.createDataFrame([(99, ["other"]), (99, [])], df.schema))).collect()
    assert sorted(r.doc_id for r in every) == sorted([d for d, _ in rows] + [99, 99])
    assert all(r.topics == [0.0] * 3 for r in every if r.doc_id == 99)


def test_a_chunk_asks_once_for_the_weights_of_a_word(monkeypatch):
    """What travels follows the distinct words of a chunk, not the words of its documents."""
    held = [pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array([["a", "b", "b", None]] * 50), pa.nulls(50, pa.list_(pa.int64()))], ["doc_id", "words", "tf"])]
    rows = online_topics.chunk_rows(held, 7, 4).to_pylist()
    assert sum(len(online_topics.unpack_columns(r["block"])["word"]) for r in rows if r["kind"] == "words") == 2
    docs = online_topics.unpack_columns(rows[0]["block"])
    assert docs["size"].to_pylist() == [2] * 50 and sorted(docs["n"].to_pylist()) == [1] * 50 + [2] * 50


def shuffles(df):
    """Exchanges in the plan but those that broadcast."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange" in line and "Broadcast" not in line for line in plan.split("== Initial Plan ==")[-1].splitlines())


def test_ffm_moves_the_rows_of_a_sample_once(spark, monkeypatch):
    features = spark.createDataFrame([(s, f, 10 * f + s % 3, 1.0 + s) for s in range(12) for f in range(3)], "sample_id long, field int, feature int, value double")
    vectors = spark.createDataFrame([(x, t, [x * 0.1, t - 0.5]) for x in range(30) for t in range(3)], "feature int, target int, v array<double>")
    want = {s: sum(((10 * f + s % 3) * 0.01 * (10 * g + s % 3) + (g - 0.5) * (f - 0.5)) * (1 + s) ** 2 for f in range(3) for g in range(f + 1, 3))
            for s in range(12)}
    for numbers, moves in ((1 << 21, 1), (0, 3)):
        monkeypatch.setattr(ctr_features, "BROADCAST_NUMBERS", numbers)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = ctr_features.ffm_score(features, vectors, 2)
        assert shuffles(got) == moves
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        scores = {r.sample_id: r.score for r in got.collect()}
        assert scores.keys() == want.keys()
        assert all(abs(scores[s] - want[s]) < 1e-9 * max(1, abs(want[s])) for s in want)


def test_ratings_are_made_in_slices_of_bounded_size(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from quillrank import session
    from quillrank.plans import fixtures as fx
    lines = spark.range(3000).select((F.col("id") % 700).alias("l_orderkey"), (F.col("id") * 7 % 13).alias("l_suppkey"),
                                     (F.col("id") % 50 + 1).cast("double").alias("l_quantity"))
    lines.unionByName(lines.limit(5).withColumn("l_suppkey", F.lit(None).cast("bigint"))).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(700).select(F.col("id").alias("o_orderkey"), (F.col("id") % 40).alias("o_custkey")).write.parquet(f"{tmp_path}/orders.parquet")
    whole = fx.ratings(spark, str(tmp_path))
    monkeypatch.setattr(fx, "slices", lambda df: session.slices(df, 100))
    cut = fx.ratings(spark, str(tmp_path))
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))
    assert cut.rdd.getNumPartitions() == 31 > whole.rdd.getNumPartitions()
    assert session.slices(spark.range(10), 100) == 0


def test_a_block_of_sgd_holds_no_python_strings(spark, monkeypatch):
    """100,000 ratings of one block; ids without a value are ids like others."""
    from pyspark.sql.group import GroupedData

    from quillrank.operators import factorization as mf
    rng = np.random.default_rng(5)
    n, k = 100_000, 4
    ratings = pd.DataFrame({"user_id": rng.integers(0, 900, n), "item_id": rng.integers(0, 70, n), "rating": rng.integers(1, 6, n).astype(float)})
    kept = []

    def captured(self, work, schema):
        kept.append(work)
        return self.count().select(F.lit("u").alias("kind"), F.lit("1").alias("id"), F.array(F.lit(0.0)).alias("features"))

    monkeypatch.setattr(GroupedData, "applyInArrow", captured)
    mf.stratified_sgd(spark.createDataFrame(ratings.head(100)), k=k, epochs=1, blocks=1)
    names = {"u": [None, *map(str, range(900))], "i": list(map(str, range(70)))}
    start = {kind: rng.random((len(ids), k)) for kind, ids in names.items()}
    user = [None if u == 0 else str(u) for u in ratings.user_id]
    none = [None] * n
    batches = [pa.RecordBatch.from_pydict({"kind": ["r"] * n, "id": user, "other": list(map(str, ratings.item_id)), "value": ratings.rating,
                                           "place": pa.array(range(n), pa.int64()), "features": pa.array(none, pa.list_(pa.float64()))})]
    batches += [pa.RecordBatch.from_pydict({"kind": [kind] * len(ids), "id": ids, "other": pa.array([None] * len(ids), pa.string()), "value": pa.array([None] * len(ids), pa.float64()),
                                            "place": pa.array([None] * len(ids), pa.int64()), "features": pa.array(list(start[kind]))}) for kind, ids in names.items()]
    tracemalloc.start()
    got = {(kind, i): f for b in kept[0]((), iter(batches)) for kind, i, f in zip(*(b.column(c).to_pylist() for c in ("kind", "id", "features")))}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * n
    x, y = start["u"].copy(), start["i"].copy()
    at = {i: row for row, i in enumerate(names["u"])}
    mf.sgd_pass(x, y, np.array([at[u] for u in user]), ratings.item_id.to_numpy(), ratings.rating.to_numpy(), 0.01, 0.01)
    assert len(got) == 971
    np.testing.assert_allclose(got["u", None], x[0])
    np.testing.assert_allclose(got["i", "7"], y[7])


def test_tfidf_moves_only_words_that_may_lead(spark, monkeypatch):
    """Equal to ranking every word, with documents that share an id, words the lexicon lacks or has twice, and ties."""
    monkeypatch.setattr(keywords, "COMMON_WORDS", 6)
    monkeypatch.setattr(keywords, "HELD_WORDS", 100)
    rng = np.random.default_rng(3)
    rows = [(d, [f"w{int(w)}" for w in rng.zipf(1.4, 60) % 90]) for d in [*range(30), 3, 3, 7]]
    rows += [(None, ["w1", "w80"]), (None, ["w80"]), (40, None), (41, []), (42, ["w2", None, None])]
    words = spark.createDataFrame(rows, "doc_id bigint, words array<string>").repartition(3)
    lexicon = keywords.idf_lexicon(words).filter("word <> 'w5'").unionByName(
        spark.createDataFrame([("w9", 0.25), ("w9", 7.0), ("w11", None), ("w12", -1.0), ("absent", 0.0)], "word string, idf double"))
    every = keywords.tfidf_keywords(words, lexicon, top=None)
    for top in (1, 4, 0):
        got = keywords.tfidf_keywords(words, lexicon, top=top)
        assert sorted(map(str, got.collect())) == sorted(map(str, every.filter(F.col("rank") <= top).collect()))
    unique = words.filter("doc_id between 8 and 29")
    monkeypatch.setattr(keywords, "COMMON_WORDS", 1000)
    assert keywords.leading_terms(unique, keywords.idf_lexicon(words), 4).count() < 0.6 * keywords.term_frequency(unique).count()
    nothing = lexicon.limit(0)
    assert keywords.tfidf_keywords(words, nothing, top=2).filter("score is not null").count() == 0


def test_skipgram_pairs_travel_in_blocks(spark, monkeypatch):
    """Counted in small blocks and many parts, pairs equal those of a plain count; what is shuffled are blocks."""
    from collections import Counter
    monkeypatch.setattr(topics, "PAIR_WORDS", 50)
    monkeypatch.setattr(topics, "PART_BYTES", 1 << 22)
    rng = np.random.default_rng(8)
    rows = [(d % 50, [f"wört{int(w)}" for w in rng.zipf(1.5, int(rng.integers(0, 40))) % 25]) for d in range(60)] + [(1, None), (2, []), (3, ["once"]), (None, ["a", "a", "b"])]
    words = spark.createDataFrame(rows, "doc_id bigint, words array<string>").repartition(3)
    want = Counter()
    for _, own in rows:
        for at, a in enumerate(own or []):
            for b in (own[at + 1:at + 4]):
                want[a, b] += 1
                want[b, a] += 1
    pairs = topics.skipgram_pairs(words, window=3)
    assert {(r.center, r.context): r.n for r in pairs.collect()} == want
    assert pairs.count() == len(want)
    assert "block#" in pairs._jdf.queryExecution().toString()
    assert topics.skipgram_pairs(words.filter("false")).count() == 0
