"""Queries over logged pulls: bandits, clustered bandits, metrics, components."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import out
from ..operators import bandit, cofiba, graph, linucb, metrics, vectors
from ..session import cut_lineage
from . import fixtures as fx
from .fixtures import ITEM_PULLS, PULLS, SCORED, VECTOR_PULLS, WIDTH, sql_uniform
from .registry import query


def _rank_sum(keys: str) -> str:
    """AUC by mean ranks, as textbooks write it."""
    part = f"partition by {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    group = f"group by {keys}" if keys else ""
    return f"""with {SCORED},
ranked as (
  select {lead}label, rank() over ({part} order by score)
         + (count(*) over ({part + ',' if part else 'partition by'} score) - 1) / 2.0 r from scored)
select {lead}m positives, n negatives, round(case when m = 0 or n = 0 then 0.5
       else (s - m * (m + 1) / 2) / (m * n) end, 6) auc
from (select {lead}count(*) filter (label = '1') m, count(*) filter (label <> '1') n,
             coalesce(sum(r) filter (label = '1'), 0)::double s from ranked {group})"""


@query("auc", _rank_sum(""))
def auc(spark, sf):
    return metrics.auc(fx.scored(spark, sf)).withColumn("auc", F.round("auc", 6))


@query("auc_by_group", _rank_sum("user_id"))
def auc_by_group(spark, sf):
    return metrics.auc(fx.scored(spark, sf), keys=("user_id",)).withColumn("auc", F.round("auc", 6))


STATS = f"""{PULLS},
stats as materialized (
  select arm, sum(reward)::bigint wins, sum(1-reward)::bigint losses, count(*) trials, avg(reward) mean
  from pulls group by 1)"""


@query("arm_stats", f"with {STATS} select arm, wins, losses, trials, round(mean, 6) mean from stats")
def arm_stats(spark, sf):
    return bandit.arm_stats(fx.pulls(spark, sf)).withColumn("mean", F.round("mean", 6))


@query("ucb_select", f"""with {STATS},
u as materialized (
  select arm, mean, trials, round(mean + sqrt(2*ln(1+(select sum(trials) from stats))/(1+trials)), 6) ucb from stats)
select arm, round(mean, 6) mean, trials, ucb, arm = (select arm from u order by ucb desc, arm limit 1) chosen from u""")
def ucb_select(spark, sf):
    return bandit.ucb_select(fx.pulls(spark, sf)).withColumn("mean", F.round("mean", 6))


@query("replay_ucb", f"""with {PULLS},
arms as (select distinct arm a from pulls),
hist as (
  select event_id, arm, a, row_number() over (partition by a order by ts, event_id) - 1 t,
         coalesce(sum((arm = a)::int) over before, 0) n, coalesce(sum(case when arm = a then reward end) over before, 0) w
  from pulls cross join arms
  window before as (partition by a order by ts, event_id rows between unbounded preceding and 1 preceding)),
scored as (
  select event_id, arm, a, round((case when n > 0 then w/n else 0 end) + sqrt(2*ln(1+t)/(1+n)), 6) + 0.0 ucb from hist)
select event_id, arm, a ucb_arm, ucb
from (select *, row_number() over (partition by event_id order by ucb desc, a) k from scored) where k = 1""")
def replay_ucb(spark, sf):
    return bandit.replay_ucb(fx.pulls(spark, sf))


@query("epsilon_greedy", f"""with {STATS},
numbered as materialized (select *, row_number() over (order by {sql_uniform('arm')}, arm) - 1 k from stats),
asked as (select event_id, row_number() over (order by event_id) - 1 t from events),
e as (
  select event_id, {sql_uniform("'eg:'||event_id")} < 0.05 or t < 100 explored,
         floor({sql_uniform("'eg:arm:'||event_id")} * (select count(*) from stats))::bigint draw from asked)
select event_id, explored, case when explored then k.arm else (
  select arm from numbered order by round(mean, 6) desc, k limit 1) end arm
from e join numbered k on k.k = e.draw""")
def epsilon_greedy(spark, sf):
    return bandit.epsilon_greedy(fx.table(spark, sf, "events"), fx.pulls(spark, sf), 0.05, min_trials=100)


@query("thompson_posterior", f"""with {STATS}
select arm, 1+wins alpha, 1+losses beta, round((1+wins)/(2+trials), 6) mean,
       round((1.0::double+wins)*(1+losses)/((2.0::double+trials)*(2+trials)*(3+trials)), 9) variance from stats""")
def thompson_posterior(spark, sf):
    return bandit.thompson_posterior(fx.pulls(spark, sf)).withColumns(
        {"mean": F.round("mean", 6), "variance": F.round("variance", 9)})


def drawn_sql(part: str) -> str:
    return sql_uniform(f"'ts:'||event_id||':'||arm||':'||side||':'||j||':{part}'") + " + power(2, -33)"


@query("thompson_select", f"""with {STATS},
sides as (select arm, 'alpha' side, 1 + wins p from stats union all select arm, 'beta', 1 + losses from stats),
tries as (
  select event_id, arm, side, j, p - 1/3.0::double d, sqrt(-2*ln({drawn_sql("r")}))*cos(2*pi()*({drawn_sql("t")})) x, ln({drawn_sql("u")}) u
  from events cross join sides cross join (select unnest(range(8)) j)),
gammas as (
  select event_id, arm, side, arg_min(d*v, j) g
  from (select *, power(1 + x/sqrt(9*d), 3) v from tries)
  where case when v > 0 then u < 0.5*x*x + d - d*v + d*ln(v) else false end group by 1, 2, 3),
betas as (select a.event_id, a.arm, a.g/(a.g + b.g) draw from gammas a join gammas b using (event_id, arm) where a.side = 'alpha' and b.side = 'beta')
select event_id, arg_max(arm, draw) arm, round(max(draw), 6) draw from betas group by 1""")
def thompson_select(spark, sf):
    chosen = bandit.thompson_select(fx.table(spark, sf, "events"), fx.pulls(spark, sf))
    return chosen.withColumn("draw", F.round("draw", 6))


REGRET = f"""with {STATS},
steps as (select user_id, event_id, arm, ts, (select max(mean) from stats) - mean regret from pulls join stats using (arm))
select %s event_id, arm, round(regret, 6) + 0.0 regret,
       round(sum(regret) over (%s order by ts, event_id rows unbounded preceding), 6) + 0.0 cumulative_regret from steps"""


def _regret(df):
    return df.withColumns({c: out(F.col(c)) for c in ("regret", "cumulative_regret")})


@query("cumulative_regret", REGRET % ("", ""))
def cumulative_regret(spark, sf):
    return _regret(bandit.cumulative_regret(fx.pulls(spark, sf)))


@query("cumulative_regret_by_user", REGRET % ("user_id,", "partition by user_id"))
def cumulative_regret_by_user(spark, sf):
    return _regret(bandit.cumulative_regret(fx.pulls(spark, sf), keys=("user_id",)))


def cells_sql(name: str, key: str, source: str, ridge: float, r: str) -> str:
    """(key, n, i, j, a, b): cells of A = ridge I + sum of x x', and b = sum of r x beside each row i."""
    return f"""{name} as materialized (
  select {key}, count(*) n, i, j, (i = j)::int*{ridge}::double + sum(x[i]*x[j]) a, sum(x[i]*{r}) b
  from {source} cross join (select unnest(range(1, {WIDTH + 1})) i) cross join (select unnest(range(1, {WIDTH + 1})) j)
  group by {key}, i, j)"""


def inverse_sql(name: str, keys: str, source: str) -> str:
    """(keys, m, b, ainv, theta): matrices as lists, inverted by sweeping one row after the other."""
    return f"""{name}_m as materialized (
  select {keys}, list(cells order by i) m, list(b order by i) b
  from (select {keys}, i, list(a order by j) cells, any_value(b) b from {source} group by {keys}, i) group by {keys}),
{name}_k as (
  select *, 0 k, m s from {name}_m
  union all
  select {keys}, m, b, k + 1, list_transform(s, lambda r, i: case
      when i = k + 1 then list_transform(r, lambda v, j: case when j = k + 1 then -1/v else v/r[k + 1] end)
      else list_transform(r, lambda v, j: case when j = k + 1 then v/s[k + 1][k + 1] else v - r[k + 1]*s[k + 1][j]/s[k + 1][k + 1] end) end)
  from {name}_k where k < {WIDTH}),
{name} as materialized (
  select *, list_transform(ainv, lambda r: list_inner_product(r, b)) theta
  from (select {keys}, m, b, list_transform(s, lambda r: list_transform(r, lambda v: -v)) ainv from {name}_k where k = {WIDTH}))"""


QUADRATIC = "list_inner_product(x, list_transform(ainv, lambda r: list_inner_product(r, x)))"
STATE = f"{VECTOR_PULLS},\n" + cells_sql("state", "arm", "pulls", 1.0, "(case when reward = 1 then 0.8::double else 0 end)")


def flat_state(state, key, digits=6):
    """A row for each of the components: the diagonal cell of A, the sum of its row, and b."""
    d = F.sqrt(F.size("a")).cast("int")
    row = F.transform("b", lambda b, i: F.struct(
        (i + 1).alias("i"), F.get("a", i * (d + 1)).alias("diagonal"),
        F.aggregate(F.slice("a", i * d + 1, d), F.lit(0.0), lambda s, v: s + v).alias("row_sum"), b.alias("b")))
    cells = state.select(*key, F.explode(row).alias("c"))
    return cells.select(*key, F.col("c.i").cast("bigint").alias("i"), *[out(F.col(f"c.{c}"), digits).alias(c) for c in ("diagonal", "row_sum", "b")])


def flat_sql(keys: str, source: str) -> str:
    """The same rows from a table of cells."""
    return f"""select {keys}, i, round(max(case when i = j then a end), 6) + 0.0 diagonal, round(sum(a), 6) + 0.0 row_sum,
  round(any_value(b), 6) + 0.0 b from {source} group by {keys}, i"""


@query("linucb_state", f"with {STATE} {flat_sql('arm, n', 'state')}")
def linucb_state(spark, sf):
    return flat_state(linucb.linucb_state(fx.vector_pulls(spark, sf), WIDTH), ["arm", "n"])


THETA = f"with recursive {STATE},\n{inverse_sql('solved', 'arm', 'state')}"


@query("linucb_theta", f"""{THETA}
select arm, unnest(range(1, {WIDTH + 1})) i, round(unnest(theta), 6) + 0.0 theta from solved""")
def linucb_theta(spark, sf):
    theta = linucb.with_theta(linucb.linucb_state(fx.vector_pulls(spark, sf), WIDTH))
    return theta.select("arm", F.posexplode("theta").alias("i", "theta")).select(
        "arm", (F.col("i") + 1).cast("bigint").alias("i"), out(F.col("theta")).alias("theta"))


@query("linucb_select", f"""{THETA},
scored as (
  select vec_id, arm, round(list_inner_product(theta, x) + 0.25*sqrt({QUADRATIC}), 6) + 0.0 score
  from (select vec_id, embedding::double[] x from embeddings) cross join solved)
select vec_id, arm, score from (
  select *, row_number() over (partition by vec_id order by score desc, arm) k from scored) where k = 1""")
def linucb_select(spark, sf):
    ctx = fx.table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    return linucb.linucb_select(ctx, "vec_id", linucb.linucb_state(fx.vector_pulls(spark, sf), WIDTH))


# clustered bandit: items are named by the events, one state per user

COFIBA_STATE = f"{ITEM_PULLS},\n" + cells_sql("ustate", "user_id", "ipulls", 0.1, "reward")

COFIBA = f"""{COFIBA_STATE},
items as materialized (select item_id, any_value(x) x from ipulls group by 1),
{inverse_sql("uth", "user_id", "ustate")},
spans as materialized (
  select item_id, user_id, x, m - w lo, m + w hi, m, w from (
    select item_id, user_id, x, list_inner_product(theta, x) m,
           2.0 * sqrt({QUADRATIC}) * sqrt(log10((select count(*) from ipulls) + 1)) w
    from uth cross join items))"""

ISLANDS = f"""{COFIBA},
isl as materialized (
  select *, sum(f) over (partition by item_id order by lo, user_id rows unbounded preceding) "cluster" from (
    select *, case when lo <= max(hi) over (partition by item_id order by lo, user_id
                                            rows between unbounded preceding and 1 preceding) then 0 else 1 end f
    from spans)),
cstate as materialized (
  select item_id, "cluster", count(*) users, i, j, (i = j)::int*0.1 + sum(a - (i = j)::int*0.1) a, sum(b) b
  from isl join ustate using (user_id) group by item_id, "cluster", i, j)"""

SELECTED = f"""{ISLANDS},
{inverse_sql("cth", 'item_id, "cluster"', "cstate")},
ucb as materialized (
  select item_id, "cluster", round(list_inner_product(theta, x) + 0.2*sqrt({QUADRATIC})
         * sqrt(log10((select count(*) from ipulls) + 1)), 6) + 0.0 score from cth join items using (item_id)),
scored as (select user_id, item_id, score from isl join ucb using (item_id, "cluster")),
chosen as materialized (
  select user_id, item_id, score from (
    select *, row_number() over (partition by user_id order by score desc, item_id) k from scored) where k = 1)"""


def cofiba_parts(spark, sf):
    pulls = fx.item_pulls(spark, sf)
    state = cut_lineage(cofiba.user_state(pulls, WIDTH))
    items = pulls.groupBy("item_id").agg(F.first("x").alias("x"))
    trials = pulls.agg(F.count("*")).scalar()
    # several sorted passes read the intervals: write them once
    return state, items, trials, cut_lineage(cofiba.intervals(state, items, trials))


@query("cofiba_user_state", f"with {COFIBA_STATE} {flat_sql('user_id, n', 'ustate')}")
def cofiba_user_state(spark, sf):
    return flat_state(cofiba.user_state(fx.item_pulls(spark, sf), WIDTH), ["user_id", "n"])


@query("cofiba_user_edges", f"""with recursive {COFIBA}
select a.item_id, a.user_id, sum((a.user_id <> b.user_id and abs(a.m - b.m) <= a.w + b.w)::int)::bigint neighbours
from spans a join spans b on a.item_id = b.item_id group by 1, 2""")
def cofiba_user_edges(spark, sf):
    *_, spans = cofiba_parts(spark, sf)
    return cofiba.user_edges(spans).select("item_id", "user_id", F.col("neighbours").cast("bigint").alias("neighbours"))


@query("cofiba_cluster_state", f"""with recursive {ISLANDS}
{flat_sql('item_id, "cluster"::bigint as "cluster", users', 'cstate').replace('group by item_id, "cluster"::bigint as "cluster", users, i', 'group by item_id, "cluster", users, i')}""")
def cofiba_cluster_state(spark, sf):
    state, _, _, spans = cofiba_parts(spark, sf)
    clusters = cofiba.user_clusters(spans)
    return flat_state(cofiba.cluster_state(clusters, state, WIDTH), ["item_id", "cluster", "users"])


@query("cofiba_select", f"with recursive {SELECTED} select * from chosen")
def cofiba_select(spark, sf):
    state, items, trials, spans = cofiba_parts(spark, sf)
    clusters = cofiba.user_clusters(spans)
    return cofiba.select_items(clusters, cofiba.cluster_state(clusters, state, WIDTH), items, trials)


def _item_split(spark, sf):
    state, items, trials, spans = cofiba_parts(spark, sf)
    clusters = cofiba.user_clusters(spans)
    chosen = cofiba.select_items(clusters, cofiba.cluster_state(clusters, state, WIDTH), items, trials)
    return cofiba.item_edges(cut_lineage(cofiba.user_edges(spans)), chosen), items


NEIGHBOURS = f"""{SELECTED},
hoods as materialized (
  select a.item_id, a.user_id, list(b.user_id order by b.user_id) l
  from spans a join spans b on a.item_id = b.item_id and abs(a.m - b.m) <= a.w + b.w group by 1, 2),
tested as materialized (
  select c.item_id chosen, o.item_id, count(*) filter (o.l <> h.l) dropped
  from chosen c join hoods h on h.user_id = c.user_id and h.item_id = c.item_id
  join hoods o on o.user_id = c.user_id and o.item_id <> c.item_id group by 1, 2)"""


@query("cofiba_item_split", f"with recursive {NEIGHBOURS} select * from tested")
def cofiba_item_split(spark, sf):
    return _item_split(spark, sf)[0]


@query("cofiba_item_clusters", f"""with recursive {NEIGHBOURS},
drops as (select distinct chosen u, item_id v from tested where dropped > 0),
kept as materialized (
  select a.item_id u, b.item_id v from items a join items b on a.item_id <> b.item_id
  where not exists (select 1 from drops d where (d.u, d.v) = (a.item_id, b.item_id) or (d.u, d.v) = (b.item_id, a.item_id))),
reach(node, root) as (
  select item_id, item_id from items union select k.v, r.root from reach r join kept k on k.u = r.node)
select node, min(root) component from reach group by 1""")
def cofiba_item_clusters(spark, sf):
    return cofiba.item_clusters(*_item_split(spark, sf))


@query("connected_components", """with recursive n as materialized (
  select vec_id id, list_transform(embedding, lambda v: v::double / sqrt(list_inner_product(embedding::double[], embedding::double[]))) e
  from embeddings),
near as materialized (
  select id, neighbour from (
    select *, row_number() over (partition by id order by sim desc, neighbour) k from (
      select a.id, b.id neighbour, round(list_inner_product(a.e, b.e), 6) sim from n a join n b on a.id <> b.id))
  where k = 1),
both_ways as materialized (select id u, neighbour v from near union select neighbour, id from near),
reach(node, root) as (
  select id, id from n union select k.v, r.root from reach r join both_ways k on k.u = r.node)
select node, min(root) component from reach group by 1""")
def connected_components(spark, sf):
    """Components of the graph joining every vector to its nearest neighbour."""
    vecs = fx.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))
    near = vectors.nearest(vecs, vecs, k=1)
    return graph.connected_components(near, vecs.select("id"), u="id", v="neighbour")
