"""Mixing sources to target weights by entropy balancing. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, join_sized, saved

WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): the number of words of each text, 0 for a null one.

    ``source`` is a key without nulls: '=' and the name, or '' for null.
    """
    return docs.select("doc_id", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
                       .cast("bigint").alias("size"))


def targets(sources: DataFrame, weight: Column, budget: float, limit: float) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: the words to take from each.

    ``budget`` times all words are shared by weight; a source stops at ``limit`` times its size and what it leaves
    goes to the others. With sources in the order of their limit per weight, those before a place are full if the
    rest, shared by the weights from there on, asks more than the limit of each. One row a source: windows are small.
    """
    s = sources.withColumn("weight", weight).withColumn("most", limit * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("most") / F.col("weight"), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = s.select("source", "source_size", "weight", "most",
                 ((F.lit(budget) * F.sum("source_size").over(Window.partitionBy())
                   - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest)).alias("level"))
    # levels fall below limit per weight once the full sources are behind; the largest of these is the water level
    open_ = F.max(F.when(F.col("level") * F.col("weight") < F.col("most"), F.col("level"))).over(Window.partitionBy())
    return s.select("source", "source_size", F.least("most", F.coalesce(open_ * F.col("weight"), F.col("most")))
                    .alias("target"))


def tilts(cells: DataFrame, goals: DataFrame, limit: float, tolerance: float, rounds: int) -> DataFrame:
    """(source, tilt): the dual solution of the entropy balancing problem of each source.

    Rates near one copy a document, in the sense of relative entropy, between 0 and ``limit``, that give the source
    its target have the form min(limit, exp(tilt * size / mean size)). The dual is convex; Newton steps solve it,
    kept inside a bracket that every round narrows. ``cells`` holds (source, size, n): documents of one size share
    a rate, so the rounds read this histogram and not the documents. A round is one aggregation for all sources.
    """
    mean = F.sum(F.col("size") * F.col("n")) / F.sum("n")
    state = (cells.groupBy("source").agg(mean.alias("mean"), F.min("size").alias("least"))
             .join(goals, F.col("source") == goals["src"]).filter("target > 0")
             .select("source", "mean", "target", F.lit(0.0).alias("tilt"), F.lit(-64.0).alias("low"),
                     # from here on every document is at the limit
                     (F.log(F.lit(limit)) * F.col("mean") / F.col("least")).alias("high"), F.lit(1.0).alias("gap")))
    state = saved(state, "mix-state")
    x = F.col("size") / F.col("mean")
    grown = F.exp(F.least(F.col("tilt") * x, F.lit(50.0)))
    for _ in range(rounds):
        s = state.withColumnRenamed("source", "src")
        moved = cells.join(s, cells["source"] == s["src"]).groupBy("source").agg(
            *(F.first(c).alias(c) for c in ("mean", "target", "tilt", "low", "high")),
            F.sum(F.col("n") * F.col("size") * F.least(F.lit(limit), grown)).alias("got"),
            F.sum(F.when(grown < limit, F.col("n") * F.col("size") * x * grown).otherwise(0.0)).alias("slope"))
        low = F.when(F.col("got") < F.col("target"), F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("got") >= F.col("target"), F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") + (F.col("target") - F.col("got")) / F.col("slope")
        inside = (F.col("slope") > 0) & (step > F.col("l")) & (step < F.col("h"))
        gap = F.abs(F.col("got") / F.col("target") - 1)
        state = saved(moved.withColumns({"l": low, "h": high}).select(
            "source", "mean", "target", F.when(gap <= tolerance, F.col("tilt")).when(inside, step)
            .otherwise((F.col("l") + F.col("h")) / 2).alias("tilt"), F.col("l").alias("low"), F.col("h").alias("high"),
            gap.alias("gap")), "mix-state")
        if not state.filter(F.col("gap") > tolerance).isEmpty():
            continue
        break
    return state.select(F.col("source").alias("src"), "mean", "tilt")


def copies(cells: DataFrame, goals: DataFrame, repairs: int) -> DataFrame:
    """``cells`` with ``whole`` and ``extra``: copies of every document of the cell, and how many get one more.

    Inside a source, cells are taken by falling size and the running sum of their fractions is rounded, so the words
    taken differ from the rates' by less than the largest document. Repairs then move single documents: in each
    round a source may give up or add one, of the size closest to what it has too much or too little.
    """
    order = Window.partitionBy("source").orderBy(F.col("size").desc(), "part")
    upto = F.sum(F.col("n") * (F.col("rate") - F.floor("rate"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rounded = cells.withColumn("whole", F.floor("rate").cast("bigint")).withColumn("upto", F.floor(upto + 0.5))
    rounded = saved(rounded.withColumn("extra", (F.col("upto") - F.coalesce(F.lag("upto").over(order), F.lit(0)))
                                       .cast("bigint")).drop("upto"), "mix-rounded")
    for _ in range(repairs):
        off = (rounded.groupBy("source").agg(F.sum(F.col("size") * (F.col("n") * F.col("whole") + F.col("extra"))).alias("got"))
               .join(goals, F.col("source") == goals["src"]).select("src", (F.col("got") - F.col("target")).alias("over")))
        near = rounded.join(off, rounded["source"] == off["src"]).filter(
            F.when(F.col("over") > 0, F.col("extra") > 0).otherwise((F.col("extra") < F.col("n")) & (F.col("rate") > F.col("whole")))
            & (F.col("size") < 2 * F.abs("over")) & (F.col("size") > 0))
        fix = near.groupBy("source").agg(F.min(F.struct(
            F.abs(F.col("size") - F.abs("over")).alias("rest"), "size", "part", F.signum("over").alias("sign"))).alias("f"))
        fix = saved(fix.select(F.col("source").alias("s"), F.col("f.size").alias("z"), F.col("f.part").alias("p"),
                               F.col("f.sign").cast("bigint").alias("sign")), "mix-repair")
        if fix.isEmpty():
            break
        rounded = saved(rounded.join(fix, (rounded["source"] == fix["s"]) & (F.col("size") == F.col("z"))
                                     & (F.col("part") == F.col("p")), "left")
                        .withColumn("extra", F.col("extra") - F.coalesce("sign", F.lit(0))).drop("s", "z", "p", "sign"),
                        "mix-rounded")
    return rounded


def mix(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), budget: float = 1.5, limit: float = 2.0,
        tolerance: float = 1e-7, rounds: int = 60, repairs: int = 4, part_rows: int = 10_000) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken), one row for each row of ``docs``.

    Sources in code point order, null last, get the weights in turn. ``rate`` is the document's exponentially tilted
    rate and ``copies`` what rounding makes of it: 0 to ``limit``. Draws are hashes of doc_id, source and size, so
    reruns agree. Texts without words are never taken (a source of such texts has target 0). Rows that repeat a
    doc_id are documents of their own; equal rows share the draw and its order among them is settled by count alone.
    An empty table gives an empty result; other columns are ignored.

    A source or a size that holds a third of all rows is cut into parts of about ``part_rows`` by a hash, and
    choosing among the documents of a part is the only window over documents.
    """
    all_sizes = saved(sizes(docs).select("doc_id", "source", "size", F.xxhash64("doc_id", "source", "size").alias("draw")),
                      "mix-sizes")
    counts = saved(all_sizes.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts")
    place = F.row_number().over(Window.orderBy(F.col("source") == "", "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    sources = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = saved(targets(sources, weight, budget, limit).withColumnRenamed("source", "src"), "mix-goals")
    filled = counts.filter("size > 0")
    tilt = tilts(filled, goals.select("src", "target"), limit, tolerance, rounds)
    rate = F.least(F.lit(limit), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(50.0))))
    rate = F.when(F.abs(rate - limit) < 1e-9, F.lit(limit)).otherwise(rate)
    rates = saved(filled.join(tilt, filled["source"] == tilt["src"], "left").select(
        "source", "size", "n", F.coalesce(rate, F.lit(0.0)).alias("rate"), F.ceil(F.col("n") / part_rows).alias("parts")),
        "mix-rates")
    rated = saved(join_sized(all_sizes.filter("size > 0"), rates, ["source", "size"], "n", all_sizes.count())
                  .select("doc_id", "source", "size", "draw", "rate", F.pmod("draw", "parts").alias("part")), "mix-rated")
    cells = rated.groupBy("source", "size", "part", "rate").agg(F.count("*").alias("n"))
    chosen = copies(saved(cells, "mix-cells"), goals.select("src", "target"), repairs)
    turn = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("draw", "doc_id"))
    dealt = rated.withColumn("turn", turn).join(chosen.drop("n", "rate"), ["source", "size", "part"]).select(
        "doc_id", "source", "size", "rate", (F.col("whole") + (F.col("turn") <= F.col("extra")).cast("bigint")).alias("copies"))
    none = all_sizes.filter("size = 0").select("doc_id", "source", "size", F.lit(0.0).alias("rate"),
                                               F.lit(0).cast("bigint").alias("copies"))
    every, goals = dealt.unionByName(none), goals.withColumnRenamed("src", "source")
    return every.join(F.broadcast(goals) if _few(goals) else goals, "source").select(
        "doc_id", F.when(F.col("source") != "", F.substring("source", 2, 1 << 30)).alias("source"), "size",
        "source_size", "target", "rate", "copies", (F.col("size") * F.col("copies")).cast("bigint").alias("taken"))


def _few(goals: DataFrame, most: int = 10_000) -> bool:
    """Whether the sources are few enough to broadcast a row of numbers for each."""
    return goals.count() <= most


def query(spark, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")
