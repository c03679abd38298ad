"""Arithmetic on array columns and scores."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_normalize(vector: Column) -> Column:
    """The vector scaled to length one; a zero vector stays zero."""
    length = F.greatest(F.sqrt(dot(vector, vector)), F.lit(1e-12))
    return F.transform(vector, lambda x: x.cast("double") / length)


def cosine(left: Column, right: Column) -> Column:
    return dot(l2_normalize(left), l2_normalize(right))


def cosine_score(left: Column, right: Column) -> Column:
    """Cosine moved from [-1, 1] to [0, 1]."""
    return (cosine(left, right) + 1) / 2


def pairwise_dots(vectors: list[Column]) -> Column:
    """Dot products of all pairs of a row's vectors, lower triangle row by row."""
    pairs = sorted((high, low) for low, high in combinations(range(len(vectors)), 2))
    return F.array(*[dot(vectors[high], vectors[low]) for high, low in pairs])


def sigmoid(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def discount(rank: Column) -> Column:
    """The weight of a hit at ``rank`` in discounted cumulative gain."""
    return 1 / F.log2(rank + 1)
