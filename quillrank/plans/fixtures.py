"""Input tables of the registered queries, built from the given tables.

Every fixture exists twice: as a DataFrame and as the text of an SQL common
table expression, so that a query and its oracle start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import uniform
from ..session import sliced, slices, spread
from ..sources.corpus import words_of_lines


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def sql_uniform(expr: str) -> str:
    return f"(('0x'||substr(md5({expr}),1,8))::BIGINT/4294967296.0)"


# ratings(user_id, item_id, rating): unique pairs, ratings 1..5

def ratings(spark: SparkSession, sf: str) -> DataFrame:
    lineitem = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    n = slices(lineitem)  # tasks that sort and hash as many rows however large the tables are
    met = sliced(lineitem, n, "l_orderkey").join(sliced(orders, n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return (sliced(met.select("o_custkey", "l_suppkey", "l_quantity"), n, "o_custkey", "l_suppkey")
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_suppkey").alias("item_id"))
            .agg(F.ceil(F.avg("l_quantity") / 10.0).cast("double").alias("rating")))


RATINGS = """ratings as materialized (
  select o_custkey user_id, l_suppkey item_id, cast(ceil(avg(l_quantity)/10.0) as double) rating
  from lineitem join orders on l_orderkey = o_orderkey group by o_custkey, l_suppkey)"""


# tokens: words of lines with at least 8 words, and words of all lines

def docs(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


def ranked_words(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, words array) of lines with at least 8 words."""
    return words_of_lines(docs(spark, sf), min_line=8)


def all_words(spark: SparkSession, sf: str) -> DataFrame:
    return words_of_lines(docs(spark, sf), min_line=1)


def _tokens_sql(name: str, min_line: int) -> str:
    return f"""{name} as materialized (
  select doc_id, word, row_number() over (partition by doc_id order by ln, p) - 1 pos
  from (select doc_id, ln, unnest(ws) word, generate_subscripts(ws, 1) p
        from (select doc_id, ln, list_filter(string_split_regex(line, '[ \\t\\r\\f]+'), lambda x: x <> '') ws
              from (select doc_id, unnest(string_split(text, chr(10))) line,
                           generate_subscripts(string_split(text, chr(10)), 1) ln
                    from documents))
        where len(ws) >= {min_line})
  where length(word) > 1)"""


TOKENS = _tokens_sql("tokens", 8)
WORDS = _tokens_sql("words", 1)


# labelled corpus: one line per document, category first

def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, category, tags array): language and the words of all lines."""
    lang = spread(table(spark, sf, "documents").select("doc_id", "text", "lang"), "doc_id")
    # two neighbouring non-blanks make a word; the test runs in the scan, before words are split
    some = lang.filter(F.col("text").rlike("[^ \\t\\r\\f\\n]{2}"))
    return (words_of_lines(some, min_line=1, keep=("lang",))
            .select("doc_id", F.col("lang").alias("category"), F.col("words").alias("tags")))


LABELLED = WORDS + """,
labelled as materialized (
  select distinct w.doc_id, d.lang category, w.word tag from words w join documents d using (doc_id))"""


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without time zone, whatever the session's zone."""
    since = ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (since.cast("interval second").cast("decimal(18,6)") * 1000000).cast("bigint")


# pulls(event_id, ts, user_id, arm, reward); with the user's vector x for the models that read it

def user_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("user_id"),
        F.col("embedding").cast("array<double>").alias("x"))


def pulls_of(events: DataFrame) -> DataFrame:
    return events.select("event_id", "ts", micros(F.col("ts")).alias("t"), "user_id", F.col("event_type").alias("arm"),
                         (F.col("value") > 50).cast("long").alias("reward"))


def pulls(spark: SparkSession, sf: str) -> DataFrame:
    return pulls_of(table(spark, sf, "events"))


def vector_pulls(spark: SparkSession, sf: str) -> DataFrame:
    return pulls(spark, sf).join(user_vectors(spark, sf), "user_id")


PULLS = """pulls as materialized (
  select event_id, ts, user_id, event_type arm, (value > 50)::bigint reward from events)"""

#: Components of the vectors.
WIDTH = 64

VECTOR_PULLS = """pulls as materialized (
  select event_id, ts, user_id, event_type arm, (value > 50)::bigint reward, embedding::double[] x
  from events join embeddings on vec_id = user_id)"""


# item pulls: the pulled item is named in the event's properties

def item_pulls(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    items = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("item_id"),
        F.col("embedding").cast("array<double>").alias("x"))
    return (events.withColumn("item_id", F.get_json_object("props", "$.k").cast("long"))
            .join(items, "item_id")
            .select("event_id", "user_id", "item_id",
                    (F.col("value") > 50).cast("long").alias("reward"), "x"))


ITEM_PULLS = """ipulls as materialized (
  select event_id, user_id, vec_id item_id, (value > 50)::bigint reward,
         embedding::double[] x
  from events join embeddings on vec_id = cast(json_extract_string(props, '$.k') as bigint))"""


# samples: one row per order with categorical and numeric fields and a planted label

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
FIELDS = 4


def ordinal(col: Column, values: list[str]) -> Column:
    return F.array_position(F.array(*[F.lit(v) for v in values]), col).cast("int")


def samples(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    hot = (F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
           & F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    draw = uniform("lab", F.col("o_orderkey"))
    return (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_orderkey").alias("sample_id"),
                    F.col("o_orderpriority").alias("priority"), F.col("c_mktsegment").alias("segment"),
                    F.col("c_nationkey").alias("nation"), F.month("o_orderdate").alias("month"),
                    F.col("o_totalprice").alias("price"), F.col("c_acctbal").alias("balance"),
                    (draw < F.when(hot, 0.9).otherwise(0.2)).cast("int").alias("label")))


SAMPLES = f"""samples as materialized (
  select o_orderkey sample_id, o_orderpriority priority, c_mktsegment segment, c_nationkey nation,
         month(o_orderdate)::int as "month", o_totalprice price, c_acctbal balance,
         case when {sql_uniform("'lab:'||cast(o_orderkey as varchar)")} <
              case when o_orderpriority in ('1-URGENT','2-HIGH') and c_mktsegment in ('BUILDING','MACHINERY')
                   then 0.9 else 0.2 end then 1 else 0 end as label
  from orders join customer on o_custkey = c_custkey)"""


def features(spark: SparkSession, sf: str) -> DataFrame:
    """Long form (sample_id, label, field, feature, value), one row per field."""
    ids = [ordinal(F.col("priority"), PRIORITIES), F.lit(1000) + ordinal(F.col("segment"), SEGMENTS),
           F.lit(2000) + F.col("nation"), F.lit(3000) + F.col("month")]
    feats = F.array(*[F.struct(F.lit(f).alias("field"), c.cast("int").alias("feature"),
                               F.lit(1.0).alias("value")) for f, c in enumerate(ids)])
    return (samples(spark, sf).select("sample_id", F.col("label").cast("double").alias("label"),
                                      F.explode(feats).alias("f"))
            .select("sample_id", "label", "f.field", "f.feature", "f.value"))


def _list(values):
    return "[" + ",".join(f"'{v}'" for v in values) + "]"


FEATURES = SAMPLES + f""",
feats as materialized (
  select sample_id, label::double as label, 0 field, list_position({_list(PRIORITIES)}, priority)::int feature, 1.0::double as value from samples
  union all select sample_id, label, 1, 1000 + list_position({_list(SEGMENTS)}, segment)::int, 1.0 from samples
  union all select sample_id, label, 2, 2000 + nation, 1.0 from samples
  union all select sample_id, label, 3, 3000 + "month", 1.0 from samples)"""


# scored(event_id, user_id, label, score)

def scored(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", "user_id", F.when(F.col("event_type") == "purchase", "1").otherwise("0").alias("label"),
        F.col("value").alias("score"))


SCORED = """scored as materialized (
  select event_id, user_id, case when event_type = 'purchase' then '1' else '0' end as label, value score from events)"""
