"""Queries that run as streams over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import out
from ..operators import online_topics
from ..session import delete_stored
from ..sources.corpus import words_of_lines
from ..streaming import bandit_streams as st
from ..streaming import user_models
from . import fixtures as fx
from .bandit_queries import cells_sql, flat_sql, flat_state, inverse_sql
from .fixtures import PULLS, VECTOR_PULLS, WIDTH
from .registry import ORACLES, query


def pulls(spark, sf):
    """The logged pulls as a stream."""
    return fx.pulls_of(st.read_table_stream(spark, sf, "events"))


def vector_pulls(spark, sf):
    """The pulls joined to the static user vectors."""
    return pulls(spark, sf).join(fx.user_vectors(spark, sf), "user_id")


@query("stream_arm_stats", ORACLES["arm_stats"])
def stream_arm_stats(spark, sf):
    return st.stream_arm_stats(pulls(spark, sf)).withColumn("mean", F.round("mean", 6))


@query("stream_linucb_state", ORACLES["linucb_state"])
def stream_linucb_state(spark, sf):
    return flat_state(st.stream_linucb_state(vector_pulls(spark, sf), WIDTH), ["arm", "n"])


@query("stream_user_state", f"""with {VECTOR_PULLS},
{cells_sql("s", "user_id", "pulls", 0.1, "reward")}
{flat_sql("user_id, n", "s")}""")
def stream_user_state(spark, sf):
    return flat_state(st.stream_user_state(vector_pulls(spark, sf), WIDTH), ["user_id", "n"])


@query("stream_user_models", f"""with recursive {VECTOR_PULLS},
{cells_sql("s", "user_id", "pulls", 0.1, "reward")},
{inverse_sql("solved", "user_id", "s")},
counted as (select user_id, count(*) n from pulls group by 1)
select user_id, n, unnest(range(1, {WIDTH + 1})) i, round(unnest(theta), 6) + 0.0 theta from solved join counted using (user_id)""")
def stream_user_models(spark, sf):
    """Inverse matrices are kept as state and moved by each batch."""
    models = user_models.stream_user_models(vector_pulls(spark, sf), WIDTH)
    return models.select("user_id", "n", F.posexplode("theta").alias("i", "theta")).select(
        "user_id", "n", (F.col("i") + 1).cast("bigint").alias("i"), out(F.col("theta")).alias("theta"))


@query("stream_arm_daily", f"""with {PULLS}
select strftime(ts, '%Y-%m-%d') as "day", arm, count(*) trials, sum(reward)::bigint wins from pulls group by 1, 2""")
def stream_arm_daily(spark, sf):
    return st.stream_arm_daily(pulls(spark, sf))


@query("stream_topics")
def stream_topics(spark, sf):
    docs = st.read_table_stream(spark, sf, "documents").select("doc_id", "text")
    return st.stream_topics(words_of_lines(docs), topics=4)


@query("lda_online")
def lda_online(spark, sf):
    """Trained on the English documents, updated with all, then inferred for all."""
    words = fx.labelled(spark, sf).select("doc_id", "category", F.col("tags").alias("words"))
    first = online_topics.train(words.filter(F.col("category") == "en"), 4, rounds=2)
    every = online_topics.Bags(words)
    weights = online_topics.update(every, 4, first, updates=2)
    delete_stored(first)
    found = online_topics.infer(every, weights, 4)
    delete_stored(weights)
    every.delete()
    return found
