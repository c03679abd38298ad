"""Connected components, and groups of rows that arrive sorted."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinary.sources.scratch import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b) but the smallest of each component, which is its name.

    Alternates two steps until nothing changes: every node points its larger neighbours, then its
    smaller ones, at the smallest node it knows.  Minima are combined before the shuffle and joined back,
    so a node with a third of all edges is split like any skewed join key.  Each round is written,
    which cuts the lineage.
    """
    oriented = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    current = materialize(oriented, "edges")
    before = _summary(current)
    while before[0]:
        both = current.union(current.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least.select("u", F.least("m", "u").alias("m")), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large, "large-star")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = materialize(small.union(smallest.select("u", "m")).distinct(), "small-star")
        after = _summary(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """One table per group of equal values in the first ``keys`` columns, which must be bigints without nulls, sorted."""
    waiting: list[pa.Table] = []
    last: tuple | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not len(table):
            continue
        values = [table.column(i).combine_chunks().to_numpy(zero_copy_only=False) for i in range(keys)]
        changed = np.zeros(len(table) - 1, dtype=bool)
        for column in values:
            changed |= column[1:] != column[:-1]
        starts = [0, *(np.flatnonzero(changed) + 1).tolist()]
        ends = [*starts[1:], len(table)]
        if waiting and tuple(column[0] for column in values) != last:
            yield pa.concat_tables(waiting)
            waiting = []
        for start, end in zip(starts, ends):
            if end < len(table):
                waiting.append(table.slice(start, end - start))
                yield pa.concat_tables(waiting) if len(waiting) > 1 else waiting[0]
                waiting = []
            else:
                waiting.append(table.slice(start, end - start))
        last = tuple(column[-1] for column in values)
    if waiting:
        yield pa.concat_tables(waiting)


def smallest_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the smallest one that the links a-b reach, for groups that fit one task."""
    labels = np.arange(n)
    while True:
        found = labels.copy()
        np.minimum.at(found, a, labels[b])
        np.minimum.at(found, b, labels[a])
        found = found[found]  # a label's own label
        if (found == labels).all():
            return labels
        labels = found
