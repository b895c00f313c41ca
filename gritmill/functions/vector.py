"""Vector expressions over array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def normalise(v: Column, floor: float = 1e-12) -> Column:
    norm = F.greatest(F.sqrt(dot(v, v)), F.lit(floor))
    return F.transform(v, lambda x: x.cast("double") / norm)


def linear(v: Column, weights: list[float], bias: float = 0.0) -> Column:
    return dot(v, F.array(*(F.lit(float(w)) for w in weights))) + F.lit(float(bias))


def softmax(logits: Column) -> Column:
    top = F.array_max(logits)
    total = F.aggregate(F.transform(logits, lambda x: F.exp(x - top)), F.lit(0.0), lambda s, x: s + x)
    return F.transform(logits, lambda x: F.exp(x - top) / total)


def ranked(labels: Column, scores: Column) -> Column:
    """Structs (neg, ordinal, label, score), best first; equal scores in label order."""
    rows = F.zip_with(labels, scores, lambda label, s: F.struct((-s).alias("neg"), label.alias("label"), s.alias("score")))
    placed = F.transform(rows, lambda r, i: F.struct(r["neg"].alias("neg"), i.alias("ordinal"), r["label"].alias("label"), r["score"].alias("score")))
    return F.array_sort(placed)
