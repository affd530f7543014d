"""Queries over documents: tokens, keywords, tags, embeddings and topics."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.columns import out
from ..operators import ivf, keywords, skipgram, tags, topics, vectors
from ..session import cut_lineage, delete_stored, scratch_path
from ..sources import corpus
from . import fixtures as fx
from .fixtures import LABELLED, TOKENS, WORDS, sql_uniform
from .registry import query


@query("tokens", f"with {TOKENS} select doc_id, word, pos::int pos from tokens")
def tokens(spark, sf):
    return corpus.tokens(fx.ranked_words(spark, sf)).select("doc_id", "word", "pos")


@query("sentences", """
select doc_id, (ln - 1)::int line, array_to_string(ws, ' ') words, len(ws)::int n_words
from (select doc_id, ln, list_filter(string_split_regex(line, '[ \\t\\r\\f]+'), lambda x: x <> '') ws
      from (select doc_id, unnest(string_split(text, chr(10))) line,
                   generate_subscripts(string_split(text, chr(10)), 1) ln from documents))
where len(ws) > 0""")
def sentences(spark, sf):
    return corpus.sentences(fx.docs(spark, sf)).select(
        "doc_id", "line", F.array_join("words", " ").alias("words"), F.size("words").alias("n_words"))


@query("term_frequency", f"with {WORDS} select doc_id, word, count(*) tf from words group by 1, 2")
def term_frequency(spark, sf):
    return keywords.term_frequency(fx.all_words(spark, sf))


IDF = f"""{WORDS},
idf as materialized (
  select word, ln((select count(distinct doc_id) from words) / count(distinct doc_id)) idf from words group by 1)"""


#: Words of documents, without places: what document frequencies need.
HELD = """held as materialized (
  select distinct doc_id, word from (
    select doc_id, unnest(string_split_regex(text, '[ \\t\\r\\f\\n]+')) word from documents) where length(word) > 1),
df as materialized (select word, count(*) df from held group by 1),
docs as materialized (select count(distinct doc_id) n from held)"""


@query("idf_lexicon", f"""with {HELD},
idf as materialized (select word, ln(n / df) idf from df cross join docs),
mean as materialized (select round(avg(idf), 6) mean_idf from idf)
select word, round(idf, 6) + 0.0 idf, mean_idf from idf cross join mean""")
def idf_lexicon(spark, sf):
    lexicon = cut_lineage(keywords.idf_lexicon(fx.all_words(spark, sf)))
    mean = lexicon.agg(F.avg("idf")).first()[0]
    return lexicon.select("word", out(F.col("idf")).alias("idf"), F.round(F.lit(mean), 6).alias("mean_idf"))


@query("stop_words", f"""with {HELD} select word, df from df cross join docs where 10 * df >= n""")
def stop_words(spark, sf):
    """Words that a tenth of the documents hold."""
    return keywords.common_words(fx.all_words(spark, sf), share=0.1)


@query("term_frequency_without_stop_words", f"""with {WORDS}, {HELD}
select doc_id, word, count(*) tf from words anti join (select word from df cross join docs where 10 * df >= n) using (word) group by 1, 2""")
def term_frequency_without_stop_words(spark, sf):
    """Term frequencies without the words of a stop list, given as a table."""
    words = fx.all_words(spark, sf)
    return keywords.without_stop_words(keywords.term_frequency(words), keywords.common_words(words, share=0.1))


@query("tfidf_keywords", f"""with {IDF},
scored as (
  select doc_id, word, round(count(*) * any_value(idf), 6) + 0.0 score from words join idf using (word) group by 1, 2),
ranked as (select *, row_number() over (partition by doc_id order by score desc, word)::int as "rank" from scored)
select * from ranked where "rank" <= 10""")
def tfidf_keywords(spark, sf):
    words = fx.all_words(spark, sf)
    lexicon = cut_lineage(keywords.idf_lexicon(words))
    return keywords.tfidf_keywords(words, lexicon)


PAIRS = f"""{TOKENS},
pairs as materialized (
  select a.doc_id, a.word src, b.word dst, count(*) n
  from tokens a join (select *, unnest(range(-7, 8)) d from tokens) b
    on a.doc_id = b.doc_id and a.pos = b.pos + b.d and b.d <> 0
  group by 1, 2, 3),
edges as materialized (
  select doc_id, src, dst, n / sum(n) over (partition by doc_id, dst) w from pairs)"""


@query("textrank_edges", f"with {PAIRS} select doc_id, src, dst, round(w, 6) weight from edges")
def textrank_edges(spark, sf):
    edges = keywords.textrank_edges(fx.ranked_words(spark, sf))
    return edges.select("doc_id", "src", "dst", F.round("weight", 6).alias("weight"))


def _rounds(n: int) -> str:
    steps = ["pr0 as materialized (select distinct doc_id, word, 1.0::double pr from tokens)"]
    for k in range(n):
        steps.append(f"""pr{k + 1} as materialized (
  select v.doc_id, v.word, 0.15 + 0.85 * coalesce(s.flow, 0) pr from pr0 v left join (
    select e.doc_id, e.src, sum(e.w * p.pr) flow from edges e join pr{k} p on p.doc_id = e.doc_id and p.word = e.dst
    group by 1, 2) s on s.doc_id = v.doc_id and s.src = v.word)""")
    return ",\n".join(steps)


@query("textrank_keywords", f"""with {PAIRS}, {_rounds(10)},
ranked as (
  select doc_id, word, score, row_number() over (partition by doc_id order by score desc, word)::int as "rank"
  from (select doc_id, word, round(pr, 6) score from pr10))
select * from ranked where "rank" <= 10""")
def textrank_keywords(spark, sf):
    return keywords.textrank_keywords(fx.ranked_words(spark, sf))


@query("skipgram_pairs", f"""with {WORDS}
select a.word center, b.word context, count(*) n
from words a join (select *, unnest(range(-5, 6)) d from words) b
  on a.doc_id = b.doc_id and a.pos = b.pos + b.d and b.d <> 0
group by 1, 2""")
def skipgram_pairs(spark, sf):
    return topics.skipgram_pairs(fx.all_words(spark, sf))


@query("labelled_corpus", f"""with {LABELLED}
select doc_id, category, count(*)::int n_tags from (
  select w.doc_id, d.lang category from words w join documents d using (doc_id)) group by 1, 2""")
def labelled_corpus(spark, sf):
    """Written as ``category tag ...`` lines and read back, one line per document."""
    lines = fx.labelled(spark, sf).select(
        F.concat_ws(" ", F.concat("category", F.lit("#"), "doc_id"), F.array_join("tags", " ")).alias("value"))
    path = scratch_path(spark, "labelled")
    lines.write.text(path)
    key = F.split("category", "#")
    return corpus.read_labelled(spark, path).select(
        key[1].cast("bigint").alias("doc_id"), key[0].alias("category"), F.size("tags").alias("n_tags"))


@query("category_counts", f"with {LABELLED} select category, count(distinct doc_id) docs from labelled group by 1")
def category_counts(spark, sf):
    return tags.category_counts(fx.labelled(spark, sf))


@query("category_entropy", f"""with {LABELLED},
c as (select count(distinct doc_id) m from labelled group by category)
select round(-sum(m / n * ln(m / n)), 6) entropy from c, (select sum(m) n from c)""")
def category_entropy(spark, sf):
    return tags.category_entropy(fx.labelled(spark, sf)).select(F.round("entropy", 6).alias("entropy"))


@query("tag_category_counts", f"with {LABELLED} select tag, category, count(*) docs from labelled group by 1, 2")
def tag_category_counts(spark, sf):
    return tags.tag_category_counts(fx.labelled(spark, sf))


CELLS = f"""{LABELLED},
cells as materialized (
  select category, tag, count(distinct doc_id) c from labelled
  group by grouping sets ((category, tag), (category), (tag), ())),
abcd as materialized (
  select p.category, p.tag, p.c a, m.c m, q.c q, n.c n
  from cells p join cells m on m.category = p.category and m.tag is null
               join cells q on q.tag = p.tag and q.category is null
               join cells n on n.category is null and n.tag is null
  where p.category is not null and p.tag is not null)"""


@query("chi_contingency", f"with {CELLS} select * from abcd")
def chi_contingency(spark, sf):
    return tags.contingency(fx.labelled(spark, sf))


CHI = f"""{CELLS},
chi as materialized (
  select category, tag, n::double*t*t / (m::double*q*(n-m)*(n-q)) chi
  from (select *, (a*(n+a-q-m) - (m-a)*(q-a))::double t from abcd) where n > m and n > q)"""


@query("chi_square", f"with {CHI} select category, tag, round(chi, 6) chi from chi")
def chi_square(spark, sf):
    return tags.chi_square(fx.labelled(spark, sf)).dropna().select("category", "tag", F.round("chi", 6).alias("chi"))


@query("chi_top", f"""with {CHI},
ranked as (
  select category, tag, chi, row_number() over (partition by category order by chi desc, tag)::int as "rank"
  from (select category, tag, round(chi, 6) chi from chi))
select * from ranked where "rank" <= 10""")
def chi_top(spark, sf):
    return tags.chi_top(fx.labelled(spark, sf), top=10)


@query("info_gain", f"""with {CELLS},
cats as materialized (select category, c from cells where category is not null and tag is null),
words_q as materialized (select tag, c q from cells where tag is not null and category is null),
grid as (
  select w.tag, k.category, k.c, w.q, coalesce(p.c, 0) a, (select sum(c) from cats) n
  from words_q w cross join cats k
  left join cells p on p.tag = w.tag and p.category = k.category)
select tag word, round(
  sum(-(c/n) * ln(c/n))
  - any_value(q)/any_value(n) * sum(case when a > 0 then -(a/q) * ln(a/q) else 0 end)
  - any_value(n-q)/any_value(n) * sum(case when c > a then -((c-a)/(n-q)) * ln((c-a)/(n-q)) else 0 end), 6) + 0.0 ig
from grid group by tag""")
def info_gain(spark, sf):
    return tags.info_gain(fx.labelled(spark, sf)).select("word", out(F.col("ig")).alias("ig"))


@query("vocab_merge", f"""with {WORDS},
old as (select distinct word from words w join documents d using (doc_id) where d.lang = 'en'),
o as materialized (select word, row_number() over (order by {sql_uniform('word')}, word) - 1 id from old),
fresh as (select distinct word from words where word not in (select word from old))
select * from o union all
select word, row_number() over (order by {sql_uniform('word')}, word) - 1 + (select count(*) from o) id from fresh""")
def vocab_merge(spark, sf):
    """The vocabulary of the English documents, extended by that of all documents."""
    labelled = fx.labelled(spark, sf).select("category", F.col("tags").alias("words"))
    first = topics.vocabulary(labelled.filter(F.col("category") == "en"))
    return topics.extend_vocabulary(first, labelled)


@query("dot_product", """
select b.label, a.vec_id, round(list_inner_product(a.embedding::double[], b.embedding::double[]), 6) + 0.0 dot
from embeddings a join (
  select label, list(m order by k) embedding from (
    select label, k, avg(v::double) m from (
      select label, unnest(embedding) v, generate_subscripts(embedding, 1) k from embeddings) group by 1, 2)
  group by 1) b on a.label = b.label""")
def dot_product(spark, sf):
    """Every vector with the centroid of its label."""
    vecs = fx.table(spark, sf, "embeddings")
    centre = (vecs.select("label", F.posexplode("embedding").alias("k", "v"))
              .groupBy("label", "k").agg(F.avg(F.col("v").cast("double")).alias("m"))
              .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("k", "m"))).alias("c"))
              .select("label", F.col("c.m").alias("centre")))
    return vecs.join(centre, "label").select(
        "label", "vec_id", out(vectors.dot(F.col("embedding"), F.col("centre"))).alias("dot"))


@query("embedding_knn", """with n as materialized (
  select vec_id id, list_transform(embedding, lambda v: v::double / sqrt(list_inner_product(embedding::double[], embedding::double[]))) e
  from embeddings),
ranked as (
  select *, row_number() over (partition by id order by sim desc, neighbour)::int as "rank" from (
    select a.id, b.id neighbour, round(list_inner_product(a.e, b.e), 6) sim from n a join n b on a.id <> b.id))
select * from ranked where "rank" <= 10""")
def embedding_knn(spark, sf):
    vecs = fx.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))
    return vectors.nearest(vecs, vecs)


def vectors_and_queries(spark, sf):
    """All vectors, and every twentieth as a query."""
    vecs = fx.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))
    return vecs, vecs.filter("id % 20 = 0")


@query("ivf_neighbours")
def ivf_neighbours(spark, sf):
    """Ten neighbours of every twentieth vector out of the probed lists, as many as the measured recall asks for."""
    vecs, queries = vectors_and_queries(spark, sf)
    index = ivf.build(vecs)
    return ivf.search(index, queries, probes=ivf.probes_for(index))


@query("ivf_all_lists", """with n as materialized (
  select vec_id id, list_transform(embedding, lambda v: v::double / sqrt(list_inner_product(embedding::double[], embedding::double[]))) e
  from embeddings),
ranked as (
  select *, row_number() over (partition by id order by sim desc, neighbour)::int as "rank" from (
    select a.id, b.id neighbour, round(list_inner_product(a.e, b.e), 6) sim from n a join n b on a.id <> b.id where a.id % 20 = 0))
select * from ranked where "rank" <= 10""")
def ivf_all_lists(spark, sf):
    """The same search with all lists probed and all entries ranked again: the exact neighbours."""
    vecs, queries = vectors_and_queries(spark, sf)
    index = ivf.build(vecs, lists=12, parts=8, words=16)
    return ivf.search(index, queries, probes=12, rerank=1 << 30, limit=100)


@query("word2vec_vectors")
def word2vec_vectors(spark, sf):
    lines = corpus.sentences(fx.docs(spark, sf))
    return topics.train_embedding(lines, size=16, epochs=1).getVectors().select(
        "word", vector_to_array("vector").alias("vector"))


@query("skipgram_continued")
def skipgram_continued(spark, sf):
    """Vectors trained on the English documents, then continued on all."""
    labelled = fx.labelled(spark, sf).select("doc_id", "category", F.col("tags").alias("words"))
    first, _ = skipgram.train(labelled.filter(F.col("category") == "en"), size=16, min_count=2, epochs=1)
    model, _ = skipgram.train(labelled, size=16, min_count=2, epochs=1, old=first)
    return model.select("word", "n", "vector")


@query("lda_topics")
def lda_topics(spark, sf):
    words = fx.all_words(spark, sf)
    model = topics.train_lda(words, topics=4, rounds=5)
    found = topics.infer_topics(model, words)
    delete_stored(model.weights)
    return found
