"""Column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(*parts) -> Column:
    """Reproducible uniform in [0, 1) keyed by the parts joined with ':'.

    Derived from md5, so any engine can compute the same number.
    """
    text = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    key = text[0] if len(text) == 1 else F.concat_ws(":", *text)
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def dot(a: Column, b: Column) -> Column:
    """Inner product of two double arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def quadratic(x: Column, m: Column) -> Column:
    """x' M x for a vector and a row-major flattened square matrix."""
    outer = F.flatten(F.transform(x, lambda a: F.transform(x, lambda b: a * b)))
    return dot(outer, m)


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def logistic_loss(score: Column, label: Column) -> Column:
    """Cross entropy of a logit, written so that large logits cannot overflow."""
    return F.greatest(score, F.lit(0.0)) - score * label + F.log1p(F.exp(-F.abs(score)))


def total(cols) -> Column:
    return reduce(lambda a, b: a + b, cols)


def xlogx(x: Column) -> Column:
    """x ln x with the limit 0 at x = 0."""
    return F.when(x > 0, x * F.log(x)).otherwise(F.lit(0.0))


def out(x: Column, digits: int = 6) -> Column:
    """Rounded value for reports; the addition turns -0.0 into 0.0."""
    return F.round(x, digits) + F.lit(0.0)
