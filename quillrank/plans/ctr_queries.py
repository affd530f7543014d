"""Queries on click-through samples, features, scores and models."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from ..functions.columns import logistic_loss, out, uniform
from ..functions.network import Shape
from ..operators import ctr_features as cf
from ..operators import ctr_models, leaf_trees, metrics, trainer
from ..session import scratch_path
from ..sources import samples as src
from . import fixtures as fx
from .fixtures import FEATURES, PRIORITIES, SAMPLES, SEGMENTS, _list, sql_uniform
from .registry import query

CATEGORICAL = ["priority", "segment", "nation", "month"]
NUMERIC = ["price", "balance"]


@query("csv_scan_dropna", f"""with {SAMPLES}
select sample_id, priority, price from samples
where {sql_uniform("'gap:'||sample_id")} >= 0.1 and {sql_uniform("'hole:'||sample_id")} >= 0.1""")
def csv_scan_dropna(spark, sf):
    """Samples written with gaps and leading blanks, read back complete rows only."""
    path = scratch_path(spark, "csv")
    rows = fx.samples(spark, sf).select(
        "sample_id", F.when(uniform("gap", F.col("sample_id")) >= 0.1, F.concat(F.lit("  "), "priority")).alias("priority"),
        F.when(uniform("hole", F.col("sample_id")) >= 0.1, F.col("price")).alias("price"))
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    return src.read_csv(spark, path, "sample_id bigint, priority string, price double")


@query("label_contains", """
select o_orderkey sample_id, (contains(o_orderpriority, 'HIGH'))::int as label from orders""")
def label_contains(spark, sf):
    return fx.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("sample_id"), src.label_contains("o_orderpriority", "HIGH").alias("label"))


@query("libffm_parse", f"""with {FEATURES}
select label as label, field::int field, feature, count(*) n, sum(value) total from feats group by 1, 2, 3""")
def libffm_parse(spark, sf):
    path = scratch_path(spark, "libffm")
    src.write_libffm(fx.features(spark, sf), path)
    parsed = src.read_libffm(spark, path).select("label", F.explode("features").alias("f"))
    return parsed.groupBy("label", "f.field", "f.feature").agg(
        F.count("*").alias("n"), F.sum("f.value").alias("total"))


KNOWN = SEGMENTS[:4]


@query("vocab_onehot", f"""with {SAMPLES}
select sample_id, {", ".join(f"(segment = '{v}')::int hot{i}" for i, v in enumerate(KNOWN))} from samples""")
def vocab_onehot(spark, sf):
    """One segment is left out of the vocabulary and becomes all zero."""
    hot = fx.samples(spark, sf).select("sample_id", cf.one_hot(F.col("segment"), KNOWN).alias("h"))
    return hot.select("sample_id", *[F.col("h")[i].alias(f"hot{i}") for i in range(len(KNOWN))])


def bucket_sql(*columns: str, seed: str = "") -> str:
    key = "||'|'||".join([f"'{seed}'", *[f"cast({c} as varchar)" for c in columns]])
    return f"(('0x'||substr(md5({key}),1,8))::BIGINT % 1000)::int"


@query("hash_bucket", f"""with {SAMPLES}
select sample_id, {bucket_sql("priority")} priority_bucket, {bucket_sql("nation")} nation_bucket from samples""")
def hash_bucket(spark, sf):
    return fx.samples(spark, sf).select("sample_id", cf.hash_bucket(F.col("priority")).alias("priority_bucket"),
                                        cf.hash_bucket(F.col("nation")).alias("nation_bucket"))


@query("bucketize", f"""select p_partkey, p_size,
({" + ".join(f"(p_size >= {b})::int" for b in cf.AGE_BOUNDARIES)})::int bucket from part""")
def bucketize(spark, sf):
    return fx.table(spark, sf, "part").select(
        "p_partkey", "p_size", cf.bucketize(F.col("p_size"), cf.AGE_BOUNDARIES).alias("bucket"))


PRICE_STEPS = [50000, 100000, 200000, 300000]
CROSSES = {"cross1": ("priority", "segment"), "cross2": ("step", "priority", "segment"), "cross3": ("nation", "segment")}


@query("crossed_features", f"""with {SAMPLES},
s as (select *, ({" + ".join(f"(price >= {b})::int" for b in PRICE_STEPS)})::int step from samples)
select sample_id, {", ".join(f"{bucket_sql(*c, seed=n)} {n}" for n, c in CROSSES.items())} from s""")
def crossed_features(spark, sf):
    rows = with_crosses(fx.samples(spark, sf))
    return rows.select("sample_id", *CROSSES)


def with_crosses(samples):
    stepped = samples.withColumn("step", cf.bucketize(F.col("price"), PRICE_STEPS))
    return stepped.withColumns({n: cf.hash_bucket(*[F.col(c) for c in cols], seed=n) for n, cols in CROSSES.items()})


@query("ordered_split", f"""with {SAMPLES}
select sample_id, case when row_number() over (order by sample_id) <= floor((select count(*) from samples) * 0.8::double)
       then 'train' else 'test' end part from samples""")
def ordered_split(spark, sf):
    return cf.ordered_split(fx.samples(spark, sf), "sample_id", 0.8)


@query("minibatch_assign", f"""with {SAMPLES}
select sample_id, epoch::int epoch,
  ('0x'||substr(md5('mb:'||epoch||':'||sample_id),1,8))::BIGINT % ceil((select count(*) from samples) / 100)::bigint batch
from samples cross join (select unnest([1, 2]) epoch)""")
def minibatch_assign(spark, sf):
    return cf.minibatches(fx.samples(spark, sf), "sample_id", batch=100, epochs=2)


# scores with parameters given by a formula of the feature id

def weights(feats):
    return feats.select("feature").distinct().select(
        "feature", (uniform("w", F.col("feature")) - 0.5).alias("w"),
        F.array(*[uniform("v", k, F.col("feature")) - 0.5 for k in (0, 1)]).alias("v"))


FM = f"""{FEATURES},
params as materialized (
  select feature, {sql_uniform("'w:'||feature")} - 0.5 w, {sql_uniform("'v:0:'||feature")} - 0.5 v0,
         {sql_uniform("'v:1:'||feature")} - 0.5 v1 from (select distinct feature from feats)),
fm as materialized (
  select sample_id, any_value(label) as label, sum(w*value) + 0.5*(
    power(sum(v0*value), 2) - sum(v0*v0*value*value) + power(sum(v1*value), 2) - sum(v1*v1*value*value)) score
  from feats join params using (feature) group by 1)"""


@query("fm_score", f"with {FM} select sample_id, round(score, 6) + 0.0 score from fm")
def fm_score(spark, sf):
    feats = fx.features(spark, sf)
    return cf.fm_score(feats, weights(feats), 2).withColumn("score", out(F.col("score")))


@query("ffm_score", f"""with {FEATURES},
params as materialized (
  select feature, g, {sql_uniform("'v:'||g||':0:'||feature")} - 0.5 v0, {sql_uniform("'v:'||g||':1:'||feature")} - 0.5 v1
  from (select distinct feature from feats) cross join (select unnest(range(4)) g))
select a.sample_id, round(sum((p.v0*q.v0 + p.v1*q.v1) * a.value * b.value), 6) + 0.0 score
from feats a join feats b on a.sample_id = b.sample_id and a.field < b.field
join params p on p.feature = a.feature and p.g = b.field
join params q on q.feature = b.feature and q.g = a.field group by 1""")
def ffm_score(spark, sf):
    feats = fx.features(spark, sf)
    targets = feats.select("feature").distinct().select(
        "feature", F.explode(F.sequence(F.lit(0), F.lit(fx.FIELDS - 1))).alias("target"))
    vectors = targets.select("feature", "target", F.array(*[
        uniform("v", F.col("target"), k, F.col("feature")) - 0.5 for k in (0, 1)]).alias("v"))
    return cf.ffm_score(feats, vectors, 2).withColumn("score", out(F.col("score")))


HIDDEN = 3


@query("deepfm_forward", f"""with {FM},
units as materialized (
  select sample_id, h, greatest(sum(value * (
      v0*({sql_uniform("'d:'||h||':'||field||':0'")} - 0.5) + v1*({sql_uniform("'d:'||h||':'||field||':1'")} - 0.5))), 0) a
  from feats join params using (feature) cross join (select unnest(range({HIDDEN})) h) group by 1, 2),
deep as (select sample_id, sum(a*({sql_uniform("'o:'||h")} - 0.5)) d from units group by 1)
select sample_id, round(score + d, 6) + 0.0 logit, round(1/(1+exp(-(score + d))), 6) probability
from fm join deep using (sample_id)""")
def deepfm_forward(spark, sf):
    """FM part plus a network of one ReLU layer on the embeddings, scored in Arrow batches."""
    def u(*key):
        return int(hashlib.md5(":".join(map(str, key)).encode()).hexdigest()[:8], 16) / 2 ** 32 - 0.5

    feats = fx.features(spark, sf)
    shape = Shape(features=1000 * fx.FIELDS, fields=fx.FIELDS, k=2, fm=True, layers=(HIDDEN,))
    dense = [("bias", 0, [0.0]), ("c0", 0, [0.0] * HIDDEN), ("c1", 0, [0.0]), *(("W1", h, [u("o", h)]) for h in range(HIDDEN))]
    dense += [("W0", 2 * f + k, [u("d", h, f, k) for h in range(HIDDEN)]) for f in range(fx.FIELDS) for k in (0, 1)]
    rows = feature_rows(weights(feats)).unionByName(spark.createDataFrame(dense, "name string, key bigint, values array<double>"))
    scored = trainer.score(in_rows(feats), trainer.Model.of(rows, shape))
    return scored.select("sample_id", out(F.col("logit")).alias("logit"),
                         F.round("probability", 6).alias("probability"))


def in_rows(feats):
    """One row a sample, with its features in the order of the fields."""
    return (feats.groupBy("sample_id", "label").agg(F.array_sort(F.collect_list(F.struct("field", "feature", "value"))).alias("f"))
            .select("sample_id", "label", F.col("f.feature").alias("idx"), F.col("f.value").alias("val")))


def feature_rows(params):
    """Rows of a parameter table from (feature, w, v)."""
    return params.select(F.lit("f").alias("name"), F.col("feature").cast("bigint").alias("key"),
                         F.concat(F.array("w"), "v").alias("values"))


def adam_sql(first: str, second: str) -> str:
    """Two steps of Adam on the factorisation machine, each on the samples that its condition names."""
    def gradient(params: str, bias: str, which: str, name: str) -> str:
        return f"""
{name}_s as materialized (
  select sample_id, any_value(label) as label, sum(v0*value) s0, sum(v1*value) s1,
    (select b from {bias}) + sum(w*value) + 0.5*(power(sum(v0*value), 2) - sum(v0*v0*value*value)
      + power(sum(v1*value), 2) - sum(v1*v1*value*value)) score
  from feats join {params} using (feature) where {which} group by 1),
{name}_d as materialized (select *, 1/(1 + exp(-score)) - label d, count(*) over () n from {name}_s),
{name} as materialized (
  select feature, sum(d*value/n) g, sum(d*value*(s0 - v0*value)/n) g0, sum(d*value*(s1 - v1*value)/n) g1
  from feats join {name}_d using (sample_id) join {params} using (feature) group by 1),
{name}_b as materialized (select sum(d/n) gb from {name}_d)"""

    def moved(x: str, old: str, g: str, t: str) -> str:
        """Update number t with the gradients of the first and the second step, 0 if it is the first update."""
        m, v = f"(0.832*0.168*{old} + 0.168*{g})", f"(0.987*0.013*power({old}, 2) + 0.013*power({g}, 2))"
        return f"{x} - 0.05*({m}/(1 - power(0.832, {t}))) / (sqrt({v}/(1 - power(0.987, {t}))) + 1e-8)"

    return f"""with {FEATURES},
p0 as materialized (
  select feature, {sql_uniform("'w:'||feature")} - 0.5 w, {sql_uniform("'v:0:'||feature")} - 0.5 v0,
         {sql_uniform("'v:1:'||feature")} - 0.5 v1 from (select distinct feature from feats)),
b0 as (select 0.0 b),{gradient("p0", "b0", first, "a")},
p1 as materialized (
  select feature, case when g is null then w else {moved("w", "0", "g", "1")} end w,
         case when g is null then v0 else {moved("v0", "0", "g0", "1")} end v0,
         case when g is null then v1 else {moved("v1", "0", "g1", "1")} end v1 from p0 left join a using (feature)),
b1 as materialized (select {moved("0", "0", "gb", "1")} b from a_b),{gradient("p1", "b1", second, "c")},
p2 as (
  select feature, case when c.g is null then w else {moved("w", "coalesce(a.g, 0)", "c.g", "(a.g is not null)::int + 1")} end w,
         case when c.g is null then v0 else {moved("v0", "coalesce(a.g0, 0)", "c.g0", "(a.g is not null)::int + 1")} end v0,
         case when c.g is null then v1 else {moved("v1", "coalesce(a.g1, 0)", "c.g1", "(a.g is not null)::int + 1")} end v1
  from p1 left join a using (feature) left join c using (feature))
select feature::bigint feature, round(w, 6) + 0.0 w, round(v0, 6) + 0.0 v0, round(v1, 6) + 0.0 v1 from p2
union all select -1, round({moved("(select b from b1)", "(select gb from a_b)", "gb", "2")}, 6) + 0.0, 0.0, 0.0 from c_b"""


def fm_rows(model):
    """(feature, w, v0, v1) of the factorisation machine's features and, as feature -1, its bias."""
    found = model.rows().filter(F.col("name").isin("f", "bias"))
    v = F.col("values")
    return found.select(F.when(F.col("name") == "f", F.col("key")).otherwise(-1).cast("bigint").alias("feature"),
                        *[out(F.coalesce(F.get(v, F.lit(k)), F.lit(0.0))).alias(n) for k, n in enumerate(("w", "v0", "v1"))])


FM_SHAPE = Shape(features=1000 * fx.FIELDS, fields=fx.FIELDS, k=2, fm=True)
IN_BATCH = "('0x'||substr(md5('mb:1:'||sample_id),1,8))::BIGINT % 2 = {}"


@query("fm_minibatch_steps", adam_sql(IN_BATCH.format(0), IN_BATCH.format(1)))
def fm_minibatch_steps(spark, sf):
    """One epoch of two minibatches, from parameters given by a formula."""
    feats = fx.features(spark, sf)
    rows = in_rows(feats)
    start = trainer.Model.of(feature_rows(weights(feats)), FM_SHAPE)
    return fm_rows(trainer.train(rows, FM_SHAPE, batch=-(-rows.count() // 2), chunk=512, start=start))


@query("fm_reload_step", adam_sql("true", "true"))
def fm_reload_step(spark, sf):
    """A full-batch step, the model saved and loaded, and another step."""
    feats = fx.features(spark, sf)
    rows, path = in_rows(feats), scratch_path(spark, "fm")
    size = rows.count()
    start = trainer.Model.of(feature_rows(weights(feats)), FM_SHAPE)
    trainer.train(rows, FM_SHAPE, batch=size, chunk=512, start=start).save(path)
    return fm_rows(trainer.train(rows, FM_SHAPE, batch=size, chunk=512, start=trainer.Model.load(spark, path)))


def fm_logits(spark, sf):
    feats = fx.features(spark, sf)
    label = fx.samples(spark, sf).select("sample_id", "label")
    return cf.fm_score(feats, weights(feats), 2).join(label, "sample_id").withColumnRenamed("score", "logit")


LOSS = "greatest(score, 0) - score*label + ln(1+exp(-abs(score)))"


@query("logloss_l2", f"""with {FM},
reg as (select sum(w*w)/2 w2, sum(v0*v0+v1*v1)/2 v2 from params)
select round(avg({LOSS}), 6) loss, round(0.01*any_value(w2 + v2), 6) penalty,
       round(avg({LOSS}) + 0.01*any_value(w2 + v2), 6) total from fm cross join reg""")
def logloss_l2(spark, sf):
    feats = fx.features(spark, sf)
    v = F.col("v")
    penalty = weights(feats).agg(0.01 * (F.sum(F.col("w") * F.col("w")) / 2
                                         + F.sum(v[0] * v[0] + v[1] * v[1]) / 2)).scalar()
    loss = fm_logits(spark, sf).agg(F.avg(logistic_loss(F.col("logit"), F.col("label"))).alias("loss"))
    return loss.withColumn("penalty", penalty).select(
        F.round("loss", 6).alias("loss"), F.round("penalty", 6).alias("penalty"),
        F.round(F.col("loss") + F.col("penalty"), 6).alias("total"))


@query("binary_metrics", f"""with {FM},
r as (select label as label, rank() over (order by score) + (count(*) over (partition by score) - 1)/2.0 k from fm),
a as (select (sum(k) filter (label = 1) - count(*) filter (label = 1)*(count(*) filter (label = 1)+1)/2)
             / (count(*) filter (label = 1) * count(*) filter (label = 0)) auc from r),
m as (select avg(((score > 0)::int = label)::int) acc, avg({LOSS}) ll, avg(label) lm, avg(1/(1+exp(-score))) pm from fm)
select 'accuracy' metric, round(acc, 6) "value" from m union all select 'logloss', round(ll, 6) from m
union all select 'label_mean', round(lm, 6) from m union all select 'prediction_mean', round(pm, 6) from m
union all select 'auc', round(auc, 6) from a""")
def binary_metrics(spark, sf):
    return metrics.binary_metrics(fm_logits(spark, sf)).withColumn("value", F.round("value", 6))


# trained models: metrics, or probabilities, on the last fifth of the samples

def parts(spark, sf, rows=None):
    rows = fx.samples(spark, sf) if rows is None else rows
    last = cf.split_point(fx.table(spark, sf, "orders"), "o_orderkey")
    return rows.filter(F.col("sample_id") <= last), rows.filter(F.col("sample_id") > last)


def fit_and_measure(pipeline, train, test):
    return metrics.binary_metrics(ctr_models.logits(pipeline.fit(train).transform(test)))


@query("lr_ctr")
def lr_ctr(spark, sf):
    return fit_and_measure(ctr_models.linear(CATEGORICAL, CATEGORICAL), *parts(spark, sf))


@query("fm_ctr")
def fm_ctr(spark, sf):
    return fit_and_measure(ctr_models.factorization_machine(CATEGORICAL, CATEGORICAL), *parts(spark, sf))


@query("wide_model")
def wide_model(spark, sf):
    columns = [*CATEGORICAL, *CROSSES]
    return fit_and_measure(ctr_models.linear(columns, columns, 1 << 14),
                           *parts(spark, sf, with_crosses(fx.samples(spark, sf))))


def numbers(samples):
    return samples.withColumns({"priority_no": fx.ordinal(F.col("priority"), PRIORITIES),
                                "segment_no": fx.ordinal(F.col("segment"), SEGMENTS)})


TREE_COLUMNS = ["priority_no", "segment_no", "nation", "month", "price", "balance"]


@query("gbt_train")
def gbt_train(spark, sf):
    """Class predictions and probabilities of the boosted trees."""
    train, test = parts(spark, sf, numbers(fx.samples(spark, sf)))
    model = ctr_models.TreesAndLinear(TREE_COLUMNS)
    gbt = model.trees.fit(model.assembler.transform(train))
    scored = gbt.transform(model.assembler.transform(test))
    return ctr_models.logits(scored, ("sample_id", "label", "prediction"))


@query("gbdt_lr")
def gbdt_lr(spark, sf):
    rows = numbers(fx.samples(spark, sf))
    train, test = parts(spark, sf, rows)
    return ctr_models.TreesAndLinear(TREE_COLUMNS).fit(train, rows).predict(test)


@query("gbdt_lr_sampled")
def gbdt_lr_sampled(spark, sf):
    rows = numbers(fx.samples(spark, sf))
    train, test = parts(spark, sf, rows)
    return ctr_models.TreesAndLinear(TREE_COLUMNS, sampled=True).fit(train, rows).predict(test)


def best_split_sql(name: str, rows: str) -> str:
    """The best split of the rows' histograms: highest gain, then first column, then lowest bin."""
    gain = "power(g, 2)/(h + 1) + power(all_g - g, 2)/(all_h - h + 1) - power(all_g, 2)/(all_h + 1)"
    return f"""
{name}_h as (select f, bin, sum(g) g, sum(h) h, count(*) n from {rows} group by 1, 2),
{name}_c as (
  select f, bin, sum(g) over w g, sum(h) over w h, sum(n) over w n, sum(g) over (partition by f) all_g,
         sum(h) over (partition by f) all_h, sum(n) over (partition by f) all_n
  from {name}_h window w as (partition by f order by bin)),
{name} as materialized (
  select *, round({gain}, 9) gain from {name}_c where n < all_n order by gain desc, f, bin limit 1)"""


TREE_EDGES = {"priority_no": [2, 3, 4, 5], "segment_no": [2, 3, 4, 5], "nation": list(range(1, 25)), "month": list(range(2, 13)),
              "price": PRICE_STEPS, "balance": [0, 2500, 5000, 7500]}
ONE_TREE = f"""{SAMPLES},
numbered as (
  select sample_id, label, list_position({_list(PRIORITIES)}, priority) priority_no, list_position({_list(SEGMENTS)}, segment) segment_no,
         nation, "month", price, balance from samples),
prior as (select ln(avg(label)/(1 - avg(label))) f0, avg(label) p from samples),
cells as materialized (
  select sample_id, f, bin, label - p g, p*(1 - p) h
  from (select sample_id, label, unnest([{", ".join(f"struct_pack(f := {k}, bin := " + " + ".join(f"({c} >= {e})::int" for e in edges) + ")" for k, (c, edges) in enumerate(TREE_EDGES.items()))}], recursive := true)
        from numbered) cross join prior),
{best_split_sql("root", "cells").strip()},
side as materialized (
  select sample_id, cells.bin <= root.bin as low from cells join root using (f)),
low_cells as materialized (select cells.* from cells join side using (sample_id) where low),
high_cells as materialized (select cells.* from cells join side using (sample_id) where not low),{best_split_sql("lows", "low_cells")},{best_split_sql("highs", "high_cells")},
second as materialized (
  select * from (select 1 node, lows.* from lows union all select 2, highs.* from highs) where gain > 0 order by gain desc, node limit 1),
leaf as materialized (
  select sample_id, case when node = 1 and low and not inner_low then 4 when node = 1 and low then 3
                         when node = 2 and not low and not inner_low then 4 when node = 2 and not low then 3
                         when low then 1 else 2 end node
  from side join (select sample_id, cells.bin <= second.bin inner_low, node from cells join second using (f)) using (sample_id)),
leaves as materialized (
  select node, row_number() over (order by node) - 1 leaf, count(*) n, sum(label - p)/(sum(p*(1 - p)) + 1) val
  from leaf join samples using (sample_id) cross join prior group by 1)"""


@query("leaf_tree", f"""with {ONE_TREE},
names as (select unnest({_list(TREE_EDGES)}) "name", unnest(range({len(TREE_EDGES)})) f)
select 0::int node, "name" feature, root.bin::int bin, all_n::bigint n, 0.0 "value" from root join names using (f)
union all select node::int, "name", second.bin::int, all_n::bigint, 0.0 from second join names using (f)
union all select node::int, 'leaf', leaf::int, n, round(val, 6) from leaves""")
def leaf_tree(spark, sf):
    """The nodes of one tree of three leaves, on given bins."""
    tree = one_tree(spark, sf).table(spark)
    return tree.select("node", F.coalesce("feature", F.lit("leaf")).alias("feature"), F.coalesce("bin", "leaf").alias("bin"),
                       "n", F.coalesce(out(F.col("value")), F.lit(0.0)).alias("value"))


@query("leaf_tree_scores", f"""with {ONE_TREE}
select sample_id, leaf::int leaf, round(f0 + 0.08*val, 6) logit, round(1/(1 + exp(-(f0 + 0.08*val))), 6) probability
from leaf join leaves using (node) cross join prior""")
def leaf_tree_scores(spark, sf):
    """Leaf, logit and probability of each sample under that tree."""
    booster, rows = one_tree(spark, sf), numbers(fx.samples(spark, sf))
    found = booster.predict(booster.leaves(rows), ("sample_id", "leaf0"))
    return found.select("sample_id", F.col("leaf0").alias("leaf"), out(F.col("logit")).alias("logit"),
                        F.round("probability", 6).alias("probability"))


def one_tree(spark, sf):
    how = leaf_trees.Growth(trees=1)
    return leaf_trees.boost(numbers(fx.samples(spark, sf)), list(TREE_EDGES), how, edges=list(TREE_EDGES.values()))


@query("leaf_gbdt")
def leaf_gbdt(spark, sf):
    """Classes and probabilities of six trees of three leaves."""
    train, test = parts(spark, sf, numbers(fx.samples(spark, sf)))
    return leaf_trees.boost(train, TREE_COLUMNS).predict(test)


@query("leaf_gbdt_lr")
def leaf_gbdt_lr(spark, sf):
    rows = numbers(fx.samples(spark, sf))
    train, test = parts(spark, sf, rows)
    return leaf_trees.LeavesAndLinear(TREE_COLUMNS).fit(train, rows).predict(test)


@query("leaf_gbdt_lr_sampled")
def leaf_gbdt_lr_sampled(spark, sf):
    """Trees that see nine tenths of the rows and half of the columns."""
    rows = numbers(fx.samples(spark, sf))
    train, test = parts(spark, sf, rows)
    return leaf_trees.LeavesAndLinear(TREE_COLUMNS, leaf_trees.sampled()).fit(train, rows).predict(test)


BUCKETS = 64


def encoded(samples):
    """idx, val, wide and num arrays for the trainer; numbers are standardised."""
    idx = [cf.hash_bucket(F.col(c), buckets=BUCKETS, seed=c) + F.lit(f * BUCKETS) for f, c in enumerate(CATEGORICAL)]
    wide = [F.col(n) + F.lit(i * 1000) for i, n in enumerate(CROSSES)]
    moments = samples.agg(F.struct(*[g(c).alias(f"{p}_{c}") for c in NUMERIC
                                     for p, g in (("m", F.avg), ("s", F.stddev_pop))])).scalar()
    num = [(F.col(c) - F.col(f"z.m_{c}")) / F.col(f"z.s_{c}") for c in NUMERIC]
    return with_crosses(samples).withColumn("z", moments).select(
        "sample_id", "label", F.array(*idx).alias("idx"), F.array(*[F.lit(1.0)] * len(idx)).alias("val"),
        F.array(*wide).alias("wide"), F.array(*num).alias("num"))


def train_and_measure(spark, sf, shape, rate=0.1):
    """Four epochs of minibatches."""
    train, test = parts(spark, sf, encoded(fx.samples(spark, sf)))
    model = trainer.train(train, shape, batch=8192, epochs=4, how=trainer.Adam(rate=rate))
    return metrics.binary_metrics(trainer.score(test, model))


def shape_of(**terms) -> Shape:
    return Shape(features=BUCKETS * len(CATEGORICAL), fields=len(CATEGORICAL), **terms)


@query("ffm_ctr")
def ffm_ctr(spark, sf):
    return train_and_measure(spark, sf, shape_of(k=2, ffm=True, l2=0.002))


@query("deep_model")
def deep_model(spark, sf):
    return train_and_measure(spark, sf, shape_of(k=8, linear=False, numeric=2, layers=(100, 50)), rate=0.02)


@query("wide_deep")
def wide_deep(spark, sf):
    return train_and_measure(spark, sf, shape_of(k=8, linear=False, numeric=2, wide=3000, layers=(100, 50)), rate=0.02)


@query("deepfm_ctr")
def deepfm_ctr(spark, sf):
    return train_and_measure(spark, sf, shape_of(k=4, fm=True, layers=(32, 16), batch_norm=True, dropout=0.1, l2=1e-4),
                             rate=0.02)
