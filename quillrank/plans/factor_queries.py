"""Queries on matrix factorisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import out
from ..operators import factorization as mf
from . import fixtures as fx
from .fixtures import RATINGS, sql_uniform
from .registry import query


def start_sql(name: str, column: str, seed: str, shift: float = 0.0) -> str:
    u = [f"{sql_uniform(f"'{seed}:'||{column}||':{c}'")} + {shift}" for c in (0, 1)]
    return f"""{name} as materialized (
  select {column} id, {u[0]} f1, {u[1]} f2 from (select distinct {column} from ratings))"""


def flat(df, digits: int = 6):
    return df.select("id", *[out(F.col("features")[i], digits).alias(f"f{i + 1}") for i in range(2)])


ITEMS0 = f"{RATINGS},\n" + start_sql("y0", "item_id", "als", -0.5)


@query("implicit_confidence", f"""with {RATINGS}
select user_id, item_id, (rating <> 0)::int::double preference, 1 + 40.0::double * rating confidence from ratings""")
def implicit_confidence(spark, sf):
    return mf.confidence(fx.ratings(spark, sf))


@query("gramian", f"""with {ITEMS0}
select round(sum(f1*f1), 6) g11, round(sum(f1*f2), 6) + 0.0 g12, round(sum(f2*f2), 6) g22 from y0""")
def gramian(spark, sf):
    y = mf.init_factors(fx.ratings(spark, sf), "item_id", 2, "als", -0.5, 0.5)
    g = F.col("g")
    return mf.gramian(y, 2).select(out(g[0]).alias("g11"), out(g[1]).alias("g12"), out(g[3]).alias("g22"))


def normal_sql(name: str, key: str, given: str, factors: str) -> str:
    return f"""{name} as materialized (
  select {key} id, g11 + 10 + sum(40*rating*f1*f1) a11, g12 + sum(40*rating*f1*f2) a12, g22 + 10 + sum(40*rating*f2*f2) a22,
         sum((1+40*rating)*f1) b1, sum((1+40*rating)*f2) b2
  from ratings join {factors} f on f.id = {given},
       (select sum(f1*f1) g11, sum(f1*f2) g12, sum(f2*f2) g22 from {factors})
  group by {key}, g11, g12, g22)"""


SOLVED = "(a22*b1-a12*b2)/(a11*a22-a12*a12) f1, (a11*b2-a12*b1)/(a11*a22-a12*a12) f2"


@query("als_normal_eq", f"""with {ITEMS0}, {normal_sql("eq", "user_id", "item_id", "y0")}
select id, {", ".join(f"round({c}, 6) + 0.0 {c}" for c in ("a11", "a12", "a22", "b1", "b2"))} from eq""")
def als_normal_eq(spark, sf):
    ratings = fx.ratings(spark, sf)
    eq = mf.normal_equations(ratings, mf.init_factors(ratings, "item_id", 2, "als", -0.5, 0.5), 2)
    a, b = F.col("a"), F.col("b")
    cells = {"a11": a[0], "a12": a[1], "a22": a[3], "b1": b[0], "b2": b[1]}
    return eq.select("id", *[out(c).alias(n) for n, c in cells.items()])


@query("als_rank2_step", f"""with {ITEMS0}, {normal_sql("equ", "user_id", "item_id", "y0")},
x1 as materialized (select id, {SOLVED} from equ), {normal_sql("eqi", "item_id", "user_id", "x1")},
y1 as (select id, {SOLVED} from eqi)
select 'user' side, id, round(f1, 6) + 0.0 f1, round(f2, 6) + 0.0 f2 from x1
union all select 'item', id, round(f1, 6) + 0.0, round(f2, 6) + 0.0 from y1""")
def als_rank2_step(spark, sf):
    """One whole sweep of two-dimensional implicit ALS."""
    users, items = mf.als_train(fx.ratings(spark, sf), k=2, sweeps=1)
    return (flat(users).select(F.lit("user").alias("side"), "*")
            .unionByName(flat(items).select(F.lit("item").alias("side"), "*")))


@query("als_builtin")
def als_builtin(spark, sf):
    return mf.als_builtin(fx.ratings(spark, sf), sweeps=3).userFactors


MF0 = f"{RATINGS},\n" + start_sql("x0", "user_id", "mf:u") + ",\n" + start_sql("y0", "item_id", "mf:i")


@query("mf_predict", f"""with {MF0}
select user_id, item_id, rating, round(x.f1*y.f1 + x.f2*y.f2, 6) prediction
from ratings join x0 x on x.id = user_id join y0 y on y.id = item_id""")
def mf_predict(spark, sf):
    ratings = fx.ratings(spark, sf)
    users, items = (mf.init_factors(ratings, c, 2, s) for c, s in (("user_id", "mf:u"), ("item_id", "mf:i")))
    return mf.predict(ratings, users, items).withColumn("prediction", F.round("prediction", 6))


def _gd_round(n: int) -> str:
    def move(old: str, key: str, other: str) -> str:
        return f"""select o.id, f1 + 0.01*(g1 - 0.01*n*f1) f1, f2 + 0.01*(g2 - 0.01*n*f2) f2 from {old} o join (
    select {key} id, count(*) n, sum(e*{other}1) g1, sum(e*{other}2) g2 from e{n} group by 1) g on g.id = o.id"""
    return f"""e{n} as materialized (
  select user_id, item_id, x.f1 x1, x.f2 x2, y.f1 y1, y.f2 y2, rating - x.f1*y.f1 - x.f2*y.f2 e
  from ratings join x{n} x on x.id = user_id join y{n} y on y.id = item_id),
x{n + 1} as materialized ({move(f"x{n}", "user_id", "y")}),
y{n + 1} as materialized ({move(f"y{n}", "item_id", "x")})"""


@query("mf_batch_gd", f"""with {MF0}, {_gd_round(0)}, {_gd_round(1)}
select 'user' side, id, round(f1, 6) + 0.0 f1, round(f2, 6) + 0.0 f2 from x2
union all select 'item', id, round(f1, 6) + 0.0, round(f2, 6) + 0.0 from y2""")
def mf_batch_gd(spark, sf):
    users, items = mf.batch_gd(fx.ratings(spark, sf), k=2, rounds=2)
    return (flat(users).select(F.lit("user").alias("side"), "*")
            .unionByName(flat(items).select(F.lit("item").alias("side"), "*")))


@query("mf_dsgd")
def mf_dsgd(spark, sf):
    users, items = mf.stratified_sgd(fx.ratings(spark, sf), k=4, epochs=1)
    return (users.select(F.lit("user").alias("side"), "*")
            .unionByName(items.select(F.lit("item").alias("side"), "*")))


@query("bpr_triples", f"""with {RATINGS},
items as materialized (
  select item_id neg, row_number() over (order by {sql_uniform('cast(item_id as varchar)')}, item_id) - 1 k
  from (select distinct item_id from ratings)),
unrated as materialized (
  select user_id, neg, row_number() over (partition by user_id order by k) - 1 place
  from (select distinct user_id from ratings) a cross join items
  where not exists (select 1 from ratings r where r.user_id = a.user_id and r.item_id = neg)),
drawn as (
  select user_id, item_id pos, floor({sql_uniform("'bpr:1:'||user_id||':'||item_id")}
    * ((select count(*) from items) - count(*) over (partition by user_id)))::bigint place
  from ratings)
select d.user_id, d.pos, u.neg from drawn d join unrated u using (user_id, place)""")
def bpr_triples(spark, sf):
    return mf.bpr_triples(fx.ratings(spark, sf))
