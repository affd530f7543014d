"""Boosted trees on histograms, grown best-first up to a number of leaves.

Columns are cut into bins once. A split of a leaf costs one aggregation of gradient sums by (column, bin) over the
rows of its smaller child; its sibling's sums are the difference. A leaf is a condition on bins, so rows are never
rewritten for a split; the driver holds histograms, whose size is columns x bins, and the trees.

Sums are exact decimals: a tree does not depend on how rows are spread over tasks.
"""

from __future__ import annotations

import heapq
import json
import math
from dataclasses import dataclass, field, replace
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import uniform
from ..session import delete_stored, stored
from .ctr_models import logits

EXACT = "decimal(20,18)"
NODE = "tree int, node int, leaf int, feature string, bin int, threshold double, left int, right int, n bigint, value double"


@dataclass(frozen=True)
class Growth:
    trees: int = 6
    leaves: int = 3
    depth: int = 2
    rate: float = 0.08
    penalty: float = 1.0       # L2 on leaf values
    least_rows: int = 1
    rows: float = 1.0          # share of the rows that a tree sees
    columns: float = 1.0       # share of the columns that a tree may split
    bins: int = 64
    seed: str = "trees"


#: Fixed shares of the sampled variant.
SAMPLED = Growth(rows=0.9, columns=0.5)


@dataclass
class Node:
    tree: int
    node: int
    depth: int
    path: tuple[tuple[int, int, bool], ...]  # (column, bin, whether the row's bin is at most that)
    g: float
    h: float
    n: int
    value: float = 0.0
    leaf: int | None = None
    feature: int | None = None
    bin: int | None = None
    left: int | None = None
    right: int | None = None


@dataclass
class Booster:
    columns: list[str]
    edges: list[list[float]]   # bin k of a column ends below edge k; nulls are in bin 0
    prior: float
    rate: float
    trees: list[list[Node]] = field(default_factory=list)

    def binned(self, samples: DataFrame) -> Column:
        def one(column: str, edges: list[float]) -> Column:
            x = F.col(column).cast("double")
            if not edges:
                return F.lit(0)
            bounds = F.array(*[F.lit(float(e)) for e in edges])
            return F.when(x.isNull(), 0).otherwise(F.size(F.filter(bounds, lambda e: e <= x)))
        return F.array(*[one(c, e) for c, e in zip(self.columns, self.edges)]).alias("bins")

    def leaf_of(self, tree: int) -> Column:
        """The number of the leaf that a row with ``bins`` falls into."""
        def branch(k: int) -> Column:
            node = self.trees[tree][k]
            if node.feature is None:
                return F.lit(node.leaf)
            return F.when(F.col("bins")[node.feature] <= node.bin, branch(node.left)).otherwise(branch(node.right))
        return branch(0)

    def gain_of(self, tree: int) -> Column:
        """The step that the tree adds to a row's logit."""
        values = {x.leaf: x.value for x in self.trees[tree] if x.feature is None}
        return F.array(*[F.lit(self.rate * values[k]) for k in range(len(values))])[self.leaf_of(tree)]

    def leaves(self, samples: DataFrame) -> DataFrame:
        """The samples with the leaf of each tree as leaf0, leaf1, ..."""
        rows = samples.withColumn("bins", self.binned(samples))
        return rows.withColumns({f"leaf{t}": self.leaf_of(t) for t in range(len(self.trees))}).drop("bins")

    def predict(self, samples: DataFrame, keep: tuple[str, ...] = ("sample_id", "label")) -> DataFrame:
        """(keep..., logit, probability, prediction)."""
        rows = samples.select(*keep, self.binned(samples))
        logit = sum((self.gain_of(t) for t in range(len(self.trees))), F.lit(self.prior))
        scored = rows.withColumn("logit", logit).withColumn("probability", 1 / (1 + F.exp(-F.col("logit"))))
        return scored.select(*keep, "logit", "probability", (F.col("logit") > 0).cast("double").alias("prediction"))

    def table(self, spark: SparkSession) -> DataFrame:
        """One row a node: a split has feature, bin and threshold (rows below it go left), a leaf its number and value."""
        def row(x: Node):
            split = x.feature is not None
            return (x.tree, x.node, x.leaf, self.columns[x.feature] if split else None, x.bin,
                    float(self.edges[x.feature][x.bin]) if split else None, x.left, x.right, x.n, None if split else x.value)
        return spark.createDataFrame([row(x) for tree in self.trees for x in tree], NODE)

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        about = json.dumps({"columns": self.columns, "edges": self.edges, "prior": self.prior, "rate": self.rate})
        spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Booster:
        out = cls(**json.loads(spark.read.text(f"{path}/about").first()[0]))
        for r in sorted(spark.read.parquet(f"{path}/nodes").collect(), key=lambda r: (r.tree, r.node)):
            out.trees += [[]] * (r.tree + 1 - len(out.trees))
            out.trees[r.tree] = [*out.trees[r.tree], Node(
                r.tree, r.node, 0, (), 0.0, 0.0, r.n, r.value or 0.0, r.leaf,
                None if r.feature is None else out.columns.index(r.feature), r.bin, r.left, r.right)]
        return out


def quantile_edges(samples: DataFrame, columns: list[str], bins: int) -> list[list[float]]:
    """Up to bins - 1 cut points a column, at its quantiles."""
    probs = [k / bins for k in range(1, bins)]
    typed = samples.select(*[F.col(c).cast("double").alias(c) for c in columns])
    lows = typed.agg(*[F.min(c) for c in columns]).first()
    found = typed.approxQuantile(columns, probs, 1 / (4 * bins))
    return [sorted({float(v) for v in cuts if low is not None and v > low}) for cuts, low in zip(found, lows)]


def _inside(path) -> Column:
    return reduce(and_, [(F.col("bins")[f] <= b) if below else (F.col("bins")[f] > b) for f, b, below in path], F.lit(True))


def _histogram(rows: DataFrame, path) -> dict[tuple[int, int], tuple[Decimal, Decimal, int]]:
    cells = rows.filter(_inside(path)).select("g", "h", F.posexplode("bins").alias("feature", "bin"))
    sums = cells.groupBy("feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count("*").alias("n"))
    return {(r.feature, r.bin): (r.g, r.h, r.n) for r in sums.collect()}


def _best(cells: dict, allowed: set[int], how: Growth) -> tuple[float, int, int, tuple] | None:
    """(gain, column, bin, sums of the left side) of the best split; ties to the first column and bin."""
    best = None
    for f in sorted(allowed):
        own = sorted((b, x) for (c, b), x in cells.items() if c == f)
        all_g, all_h, all_n = (sum(x[k] for _, x in own) for k in range(3))
        g = h = n = 0
        for b, x in own[:-1]:
            g, h, n = g + x[0], h + x[1], n + x[2]
            if min(n, all_n - n) < how.least_rows:
                continue
            score = lambda a, c: float(a) ** 2 / (float(c) + how.penalty)
            gain = round(score(g, h) + score(all_g - g, all_h - h) - score(all_g, all_h), 9)
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, f, b, (g, h, n))
    return best


def _grow(rows: DataFrame, tree: int, allowed: set[int], how: Growth) -> list[Node]:
    """One tree. The leaf with the best split is split next, until the leaves are enough."""
    root = _histogram(rows, ())
    first = {f: [x for (c, _), x in root.items() if c == f] for f in {c for c, _ in root}}
    g, h, n = (sum(x[k] for x in next(iter(first.values()))) for k in range(3)) if first else (0, 0, 0)
    nodes, queue = [Node(tree, 0, 0, (), g, h, n)], []

    def offer(node: Node, cells: dict) -> None:
        split = _best(cells, allowed, how) if node.depth < how.depth else None
        if split:
            heapq.heappush(queue, (-split[0], node.node, split, cells))

    offer(nodes[0], root)
    leaves = 1
    while queue and leaves < how.leaves:
        _, k, (_, f, b, low), cells = heapq.heappop(queue)
        node = nodes[k]
        node.feature, node.bin = f, b
        node.left, node.right = len(nodes), len(nodes) + 1
        high = (node.g - low[0], node.h - low[1], node.n - low[2])
        left, right = (Node(tree, i, node.depth + 1, (*node.path, (f, b, below)), *sums)
                       for i, below, sums in ((node.left, True, low), (node.right, False, high)))
        nodes += [left, right]
        leaves += 1
        if leaves < how.leaves and left.depth < how.depth:
            small, large = (left, right) if left.n <= right.n else (right, left)
            found = _histogram(rows, small.path)
            rest = {c: tuple(x - y for x, y in zip(v, found.get(c, (0, 0, 0)))) for c, v in cells.items()}
            offer(small, found)
            offer(large, {c: v for c, v in rest.items() if v[2]})
    for number, node in enumerate(x for x in nodes if x.feature is None):
        node.leaf, node.value = number, float(node.g) / (float(node.h) + how.penalty) if node.n else 0.0
    return nodes


def boost(samples: DataFrame, columns: list[str], how: Growth | None = None, key: str = "sample_id",
          edges: list[list[float]] | None = None) -> Booster:
    """Trees on the log loss of ``label``, each leaf a Newton step.

    ``edges`` gives the cut points of each column; without them they are quantiles. Rows and columns of a tree are
    drawn by hashes of (seed, tree, key) and (seed, tree, column).
    """
    how = how or Growth()
    share = samples.agg(F.avg(F.col("label").cast("double"))).first()[0]
    share = min(max(share or 0.0, 1e-9), 1 - 1e-9)
    out = Booster(columns, quantile_edges(samples, columns, how.bins) if edges is None else edges,
                  math.log(share / (1 - share)), how.rate)
    rows = stored(samples.select(F.col(key).alias("key"), F.col("label").cast("int").alias("label"),
                                 F.lit(out.prior).alias("logit"), out.binned(samples)), "binned")
    for tree in range(how.trees):
        p = 1 / (1 + F.exp(-F.col("logit")))
        seen = rows.withColumns({"g": (F.col("label") - p).cast(EXACT), "h": (p * (1 - p)).cast(EXACT)})
        if how.rows < 1:
            seen = seen.filter(uniform(how.seed, tree, F.col("key")) < how.rows)
        allowed = set(range(len(columns)))
        if how.columns < 1:
            spark = samples.sparkSession
            drawn = spark.createDataFrame([(k, c) for k, c in enumerate(columns)], "k int, c string").select(
                "k", uniform(how.seed, tree, "column", F.col("c")).alias("u")).orderBy("u").limit(max(1, round(how.columns * len(columns))))
            allowed = {r.k for r in drawn.collect()}
        out.trees.append(_grow(seen, tree, allowed, how))
        if tree + 1 < how.trees:
            old, rows = rows, stored(rows.withColumn("logit", F.col("logit") + out.gain_of(tree)), "binned")
            delete_stored(old)
    delete_stored(rows)
    return out


class LeavesAndLinear:
    """Leaf numbers of the trees, one-hot, in a logistic regression."""

    def __init__(self, columns: list[str], how: Growth | None = None):
        self.columns, self.how = columns, how or Growth()

    def fit(self, train: DataFrame, everything: DataFrame | None = None) -> LeavesAndLinear:
        """Both models see ``train``; the leaf encoder sees ``everything`` if given."""
        self.booster = boost(train, self.columns, self.how)
        leaves = [f"leaf{t}" for t in range(len(self.booster.trees))]
        hot = [f"hot{t}" for t in range(len(leaves))]
        encoder = OneHotEncoder(inputCols=leaves, outputCols=hot, dropLast=False, handleInvalid="keep")
        encode = Pipeline(stages=[encoder, VectorAssembler(inputCols=hot, outputCol="encoded")])
        self.encode = encode.fit(self.booster.leaves(train if everything is None else everything))
        rows = self.encode.transform(self.booster.leaves(train)).persist()
        self.model = LogisticRegression(featuresCol="encoded", labelCol="label", maxIter=100).fit(rows)
        rows.unpersist()
        return self

    def predict(self, samples: DataFrame) -> DataFrame:
        """(sample_id, label, logit, probability)."""
        return logits(self.model.transform(self.encode.transform(self.booster.leaves(samples))))


def sampled(**more) -> Growth:
    return replace(SAMPLED, **more)
