"""Feature columns for click-through models."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.running import running

#: Numbers of a table of vectors that may be sent to all tasks, some 16 MB.
BROADCAST_NUMBERS = 1 << 21

#: Rows of features that a task adds up.
PART_ROWS = 1 << 19

#: Fixed half-open age boundaries.
AGE_BOUNDARIES = [18, 25, 30, 35, 40, 45, 50, 55, 60, 65]


def one_hot(column: Column, vocabulary: list[str]) -> Column:
    """0/1 array over a fixed word list; all zero for an unknown value."""
    return F.transform(F.array(*[F.lit(v) for v in vocabulary]),
                       lambda v: F.coalesce(v == column, F.lit(False)).cast("int"))


def hash_bucket(*columns: Column, buckets: int = 1000, seed: str = "") -> Column:
    """Bucket of the values, or of their combination (a crossed feature).

    From md5, so that stored models and other engines agree on the number.
    """
    key = F.concat_ws("|", F.lit(seed), *[c.cast("string") for c in columns])
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def bucketize(column: Column, boundaries: list[float]) -> Column:
    """0 below the first boundary, i from boundaries[i-1] up to boundaries[i]."""
    return F.when(column.isNotNull(), sum(((column >= b).cast("int") for b in boundaries), F.lit(0)))


def ordered_split(samples: DataFrame, key: str, rate: float = 0.8) -> DataFrame:
    """(key, part): the first int(n * rate) keys train, the others test."""
    limit = F.floor(samples.agg(F.count("*")).scalar() * F.lit(rate))
    ranked = running(samples.select(key), key, sums={"before": F.lit(1)}, inclusive=False)
    return ranked.select(key, F.when(F.col("before") < limit, "train").otherwise("test").alias("part"))


def split_point(samples: DataFrame, key: str, rate: float = 0.8):
    """The last key of the train part: keys up to it train, so a split needs no join."""
    split = ordered_split(samples, key, rate)
    return split.filter("part = 'train'").agg(F.max(key)).first()[0]


def batch_draw(key, epoch, seed: str = "mb") -> Column:
    """An integer that deals samples to the batches of an epoch; from md5, so that other engines agree."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), epoch, key)), 1, 8), 16, 10).cast("bigint")


def minibatches(samples: DataFrame, key: str, batch: int, epochs: int = 1, seed: str = "mb") -> DataFrame:
    """(key, epoch, batch): an independent even assignment in every epoch."""
    n = F.ceil(samples.agg(F.count("*")).scalar() / batch)
    rows = samples.select(key, F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("epoch"))
    return rows.withColumn("batch", F.pmod(batch_draw(F.col(key), F.col("epoch"), seed), n))


def fm_score(features: DataFrame, weights: DataFrame, k: int, bias: float = 0.0) -> DataFrame:
    """(sample_id, score): b + sum w x + 1/2 sum_k ((sum v x)^2 - sum (v x)^2).

    ``weights`` is (feature, w, v array). The identity needs one pass over a
    sample's features, never their pairs.
    """
    x, v = F.col("value"), F.col("v")
    joined = features.select("sample_id", "feature", "value").join(weights, "feature")
    sums = joined.groupBy("sample_id").agg(
        F.sum(F.col("w") * x).alias("linear"),
        *[F.sum(v[c] * x).alias(f"s{c}") for c in range(k)],
        *[F.sum(v[c] * x * v[c] * x).alias(f"q{c}") for c in range(k)])
    pairs = sum((F.col(f"s{c}") * F.col(f"s{c}") - F.col(f"q{c}") for c in range(k)), F.lit(0.0))
    return sums.select("sample_id", (F.lit(bias) + F.col("linear") + 0.5 * pairs).alias("score"))


def ffm_score(features: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """(sample_id, score): sum over feature pairs of <v[i, field j], v[j, field i]> x_i x_j.

    ``vectors`` is (feature, target, v array). With S[f, g] the sum of v[i, g] x_i
    over the features i of field f, the pairs of two fields give S[f,g] S[g,f]
    and those inside a field 1/2 (S[f,f]^2 - sum (v x)^2): linear in the features.
    """
    x, v = F.col("value"), F.col("v")
    features = features.select("sample_id", "field", "feature", "value")
    # rows move once: all that is added up stays where its sample is; a row makes several, so parts are sized by rows
    parts = max(int(features.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(features.count() / PART_ROWS))
    if vectors.count() * (k + 4) <= BROADCAST_NUMBERS:
        joined = features.repartition(parts, "sample_id").join(F.broadcast(vectors), "feature")
    else:
        joined = features.join(vectors, "feature").repartition(parts, "sample_id")
    sums = (joined.groupBy("sample_id", "field", "target")
            .agg(*[F.sum(v[c] * x).alias(f"s{c}") for c in range(k)],
                 F.sum(sum((v[c] * x * v[c] * x for c in range(k)), F.lit(0.0))).alias("q")))
    inside = F.col("field") == F.col("target")
    low, high = F.least("field", "target").alias("lo"), F.greatest("field", "target").alias("hi")
    fields = sums.groupBy("sample_id", low, high).agg(
        *[F.sum(F.when(F.col("field") <= F.col("target"), F.col(f"s{c}"))).alias(f"a{c}") for c in range(k)],
        *[F.sum(F.when(F.col("field") >= F.col("target"), F.col(f"s{c}"))).alias(f"b{c}") for c in range(k)],
        F.sum(F.when(inside, F.col("q"))).alias("q"))
    # a target field without a feature of the sample has no partner and contributes nothing
    product = F.coalesce(sum((F.col(f"a{c}") * F.col(f"b{c}") for c in range(k)), F.lit(0.0)), F.lit(0.0))
    part = F.when(F.col("lo") == F.col("hi"), 0.5 * (product - F.col("q"))).otherwise(product)
    return fields.groupBy("sample_id").agg(F.sum(part).alias("score"))

