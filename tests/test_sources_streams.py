"""Readers, writers and streams."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from quillrank.operators import linucb, online_topics, tags
from quillrank.operators.bandit import arm_stats
from quillrank.sources import corpus, matrix, samples
from quillrank.streaming import bandit_streams as st


def rows(df, digits=6):
    return sorted(tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect())


def text_file(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_coo_readers(spark, tmp_path):
    path = text_file(tmp_path, "m", "0 0 5\n\n 1  2 3.5 \nbad\n2 x 1\n3 4\n")
    assert rows(matrix.read_coo(spark, path)) == [(0, 0, 5.0), (1, 2, 3.5)]
    assert rows(matrix.read_coo(spark, path, "string")) == [("0", "0", 5.0), ("1", "2", 3.5), ("2", "x", 1.0)]
    headed = text_file(tmp_path, "h", "2 3 2\n0 0 5\n1 2 3\n")
    assert rows(matrix.read_coo_with_header(spark, headed)) == [(0, 0, 5.0), (1, 2, 3.0)]


def test_corpus_readers(spark, tmp_path):
    path = text_file(tmp_path, "c", "sport ball  goal\n\ntech\ntech chip\n")
    assert rows(corpus.read_labelled(spark, path)) == [("sport", ["ball", "goal"]), ("tech", ["chip"])]
    assert corpus.read_sentences(spark, path).count() == 3
    idf = text_file(tmp_path, "i", "goal 1.5\nball 2\nbroken\n")
    assert rows(corpus.read_idf(spark, idf)) == [("ball", 2.0), ("goal", 1.5)]
    assert corpus.read_documents(spark, text_file(tmp_path, "d", "  a b\nc ")).first().text == "a b\nc"


def test_words_drop_short_lines_before_stop_words(spark):
    docs = spark.createDataFrame([(1, "aa b cc\naa bb\n\tdd  stop ee ")], "doc_id bigint, text string")
    got = corpus.words_of_lines(docs, min_line=3, stop_words=("stop",)).first()
    assert got.words == ["aa", "cc", "dd", "ee"]


def test_libffm_decides_per_feature(spark, tmp_path):
    path = text_file(tmp_path, "f", "1 0:3:1.5 7:2\n0\n\n")
    got = samples.read_libffm(spark, path).orderBy("label").collect()
    assert [r.label for r in got] == [0.0, 1.0] and got[0].features == []
    assert [tuple(f) for f in got[1].features] == [(0, 3, 1.5), (None, 7, 2.0)]


def test_census_csv(spark, tmp_path):
    line = "39, State-gov, 77516, Bachelors, 13, Never-married, Adm-clerical, Not-in-family, White, Male, 2174, 0, 40, United-States, >50K"
    path = text_file(tmp_path, "a.csv", "header\n" + line + "\n" + line.replace(" White,", ",") + "\n")
    got = samples.read_csv(spark, path).withColumn("label", samples.label_contains("income_bracket", ">50K"))
    assert [(r.workclass, r.age, r.label) for r in got.collect()] == [("State-gov", 39.0, 1)]


def test_factor_files(spark, tmp_path):
    factors = spark.createDataFrame([(1, [0.25, -1.5]), (2, [3.0, 1e-7])], "id bigint, features array<double>")
    for text in (True, False):
        path = str(tmp_path / f"factors{text}")
        matrix.write_factors(factors, path, text)
        assert sorted(matrix.read_factors(spark, path, text).collect()) == sorted(factors.collect())


def test_report_files(spark, tmp_path):
    sims = spark.createDataFrame([(1, 0, 0.126)], "i bigint, j bigint, sim double")
    matrix.write_similarity(sims, str(tmp_path / "s"))
    assert spark.read.text(str(tmp_path / "s")).first().value == "1 0 0.13"
    gains = spark.createDataFrame([("a", 0.1), ("b", 0.7)], "word string, ig double")
    tags.write_info_gain(gains, str(tmp_path / "g"), sort=True)
    assert [r.value for r in spark.read.text(str(tmp_path / "g")).collect()] == ["b 0.70", "a 0.10"]
    chi = spark.createDataFrame([("sport", "ball", 1.333)], "category string, tag string, chi double")
    tags.write_chi(chi, str(tmp_path / "x"))
    assert [r.value for r in spark.read.text(str(tmp_path / "x" / "category=sport")).collect()] == ["sport ball 1.33"]


def test_streams_over_many_batches_equal_batch(spark, tmp_path):
    pulls = spark.range(90).select(
        F.col("id").alias("event_id"), F.concat(F.lit("a"), F.col("id") % 3).alias("arm"), (F.col("id") % 2).alias("reward"),
        (F.col("id") % 7).alias("user_id"), (F.col("id") * 3_600_000_000).alias("t"), F.array(F.sin("id"), F.lit(1.0)).alias("x"))
    path = str(tmp_path / "pulls")
    pulls.repartition(4).write.parquet(path)

    def stream():
        return spark.readStream.schema(pulls.schema).option("maxFilesPerTrigger", 1).parquet(path)

    assert rows(st.stream_arm_stats(stream())) == rows(arm_stats(pulls))
    for got, want in ((st.stream_linucb_state(stream(), 2), linucb.linucb_state(pulls, 2)),
                      (st.stream_user_state(stream(), 2), linucb.ridge_sums(pulls, "user_id", 2, 0.1))):
        def flat(df):
            return df.select(df.columns[0], "n", *[F.round(F.col("a")[i], 9) for i in range(4)],
                             *[F.round(F.col("b")[i], 9) for i in range(2)])
        assert rows(flat(got)) == rows(flat(want))


def test_daily_stream(spark, tmp_path):
    pulls = spark.range(60).select((F.col("id") * 3_600_000_000).alias("t"), F.lit("a").alias("arm"), F.lit(1).alias("reward"))
    path = str(tmp_path / "daily")
    pulls.coalesce(1).write.parquet(path)
    got = st.stream_arm_daily(spark.readStream.schema(pulls.schema).parquet(path))
    assert rows(got) == [("1970-01-01", "a", 24, 24), ("1970-01-02", "a", 24, 24), ("1970-01-03", "a", 12, 12)]


def test_topic_stream(spark, tmp_path):
    docs = spark.createDataFrame([(1, ["aa", "bb"]), (2, ["cc"])], "doc_id bigint, words array<string>")
    path = str(tmp_path / "docs")
    docs.repartition(2, "doc_id").write.parquet(path)
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(path)
    weights = st.stream_topics(stream, 2)
    assert {r.word for r in weights.collect()} == {"aa", "bb", "cc"}
    assert online_topics.infer(docs, weights, 2).count() == 2


def test_headed_matrices_with_any_blanks_and_odd_feature_words(spark, tmp_path):
    headed = text_file(tmp_path, "blanks", "3 3 5\n0 0 5\n1  2 3\n 2\t1\t4.5\n2 2 1 \nbroken\n")
    assert rows(matrix.read_coo_with_header(spark, headed)) == [(0, 0, 5.0), (1, 2, 3.0), (2, 1, 4.5), (2, 2, 1.0)]
    odd = text_file(tmp_path, "odd", "1 2:3:0.5 word 4:1\n")
    got = samples.read_libffm(spark, odd).first().features
    assert [tuple(f) for f in got] == [(2, 3, 0.5), (None, None, None), (None, 4, 1.0)]


def test_queries_run_from_another_folder(tmp_path):
    """Executors get the package from the driver, wherever that was started."""
    code = """
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
import __spark_entry__ as contract
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4").config(
    "spark.ui.enabled", "false").getOrCreate()
assert contract.entry(spark).count() > 0
assert contract.queries()["textrank_keywords"](spark, "/root/testdata/sf0.001").count() > 0
print("done")
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith("SPARK")}
    run = subprocess.run([sys.executable, "-c", code.format(root=root)], cwd=tmp_path, env=clean, capture_output=True,
                         text=True, timeout=600)
    assert "done" in run.stdout, run.stderr[-2000:]
