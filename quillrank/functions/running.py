"""Running totals that never put a whole key, or the whole table, in one task.

A window over one key sorts that key's rows in a single task. Here the order
column is cut at its quantiles first. Every (key, slice) pair is a window of
its own, and the totals of the earlier slices, one small row per pair, are
carried in by a join.
"""

from __future__ import annotations

from collections import Counter

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

SLICE = "__slice"


def _bucket(df: DataFrame, column: str, cuts: list[float], output: str) -> DataFrame:
    if not cuts:
        return df.withColumn(output, F.lit(0.0))
    splits = [float("-inf"), *cuts, float("inf")]
    typed = df.withColumn("__order", F.col(column).cast("double"))
    return Bucketizer(splits=splits, inputCol="__order", outputCol=output).transform(typed).drop("__order")


def slice_by_quantile(df: DataFrame, order: str, slices: int, tie: str | None = None) -> DataFrame:
    """Adds the slice number of the numeric column ``order``.

    A value filling several quantiles would fill one slice. Such values begin a
    slice, since they are cut points; their rows are cut again by ``tie``.
    """
    error = 1 / (4 * slices)
    probs = [i / slices for i in range(1, slices)]
    found = df.approxQuantile(order, probs, error) if probs else []
    cut = _bucket(df, order, sorted(set(found)), SLICE)
    hot = sorted({v for v, n in Counter(found).items() if n > 1}) if len(found) > len(set(found)) else []
    if not hot or tie is None:
        return cut
    is_hot = F.col(order).cast("double").isin(hot)
    inner = sorted(set(df.filter(is_hot).approxQuantile(tie, probs, error)))
    cut = _bucket(cut, tie, inner, "__inner")
    width = len(inner) + 2
    return cut.withColumn(SLICE, F.col(SLICE) * width
                          + F.when(is_hot, F.col("__inner")).otherwise(width - 1)).drop("__inner")


def default_slices(df: DataFrame) -> int:
    return max(2, min(1 << 16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def running(df: DataFrame, order: str, sums: dict[str, Column] | None = None,
            maxima: dict[str, Column] | None = None, keys: tuple[str, ...] = (),
            ties: tuple[str, ...] = (), inclusive: bool = True,
            slices: int | None = None) -> DataFrame:
    """Adds running sums and maxima of expressions along ``order`` within ``keys``.

    ``inclusive=False`` leaves the row itself out (the state before it).
    """
    sums, maxima = dict(sums or {}), dict(maxima or {})
    numeric = ties and isinstance(df.schema[ties[0]].dataType, NumericType)
    cut = slice_by_quantile(df, order, slices or default_slices(df), ties[0] if numeric else None)
    for name, expr in {**sums, **maxima}.items():
        cut = cut.withColumn(f"__v_{name}", expr)
    group = [*keys, SLICE]
    pick = {**{n: F.sum for n in sums}, **{n: F.max for n in maxima}}

    totals = cut.groupBy(*group).agg(*[fn(f"__v_{n}").alias(f"__t_{n}") for n, fn in pick.items()])
    before = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(*group, *[fn(f"__t_{n}").over(before).alias(f"__c_{n}")
                                    for n, fn in pick.items()])

    end = W.currentRow if inclusive else -1
    inside = W.partitionBy(*group).orderBy(order, *ties).rowsBetween(W.unboundedPreceding, end)
    rows = cut
    for n, fn in pick.items():
        rows = rows.withColumn(f"__w_{n}", fn(f"__v_{n}").over(inside))
    rows = rows.join(carry, group)
    values = [(F.coalesce(f"__w_{n}", F.lit(0)) + F.coalesce(f"__c_{n}", F.lit(0))).alias(n)
              for n in sums]
    values += [F.greatest(f"__w_{n}", f"__c_{n}").alias(n) for n in maxima]
    return rows.select(*df.columns, *values)
