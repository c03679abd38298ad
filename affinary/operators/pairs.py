"""Work on (user, item) pairs: set difference, label conflicts, first occurrences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinary.operators.ordering import null_safe_join
from affinary.roles import EXCLUDE, NEGATIVE, POSITIVE, Roles


def anti_join(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``; null keys match null keys.

    The keys are made distinct first, which combines a key with very many copies
    before the shuffle.  Rows of a hot key on the left are split by adaptive
    execution, which may divide the left side of an anti join freely.
    """
    return null_safe_join(df, other.select(*on).distinct(), on, "left_anti")


def drop_seen_pairs(df: DataFrame, seen: DataFrame | None, roles: Roles = Roles()) -> DataFrame:
    """Drop the pairs that were already seen."""
    if seen is None:
        raise ValueError("build the training side first: there are no seen pairs to drop")
    return anti_join(df, seen, roles.pair)


def resolve_labels(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Settle pairs that carry several labels.

    A positive beats every other label of its pair and an exclude-only row beats
    the negatives, so a negative survives only where its pair has neither; the
    exclude-only rows themselves are dropped.  Positives pass through without a
    shuffle, only negatives meet the blocking pairs.
    """
    label = F.col(roles.label)
    positives = df.filter(label == POSITIVE)
    negatives = df.filter(label == NEGATIVE)
    blocking = df.filter(label.isin(POSITIVE, EXCLUDE))
    return positives.unionByName(anti_join(negatives, blocking, roles.pair))


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in an explicit order.

    The rank limit is applied before the shuffle as well, so copies of a hot key
    shrink to one row per task.
    """
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_first", F.row_number().over(window)).filter(F.col("_first") == 1).drop("_first")


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Append tables by column name; a missing column is an error."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=False)
    return first


def split_by_label(df: DataFrame, roles: Roles = Roles()) -> dict[str, DataFrame]:
    label = F.col(roles.label)
    return {
        "positive": df.filter(label == POSITIVE),
        "negative": df.filter(label == NEGATIVE),
        "exclude": df.filter(label == EXCLUDE),
    }


def latest_per_key(
    df: DataFrame, key: Sequence[str], version: str, before: int | None = None, *, inclusive: bool = False
) -> DataFrame:
    """Per key, the row with the greatest version, optionally before a bound.

    An ordinary aggregate: versions are compared map-side, one row per key and
    task is shuffled.
    """
    if before is not None:
        df = df.filter(F.col(version) <= before if inclusive else F.col(version) < before)
    rest = [name for name in df.columns if name not in key and name != version]
    newest = F.max(F.struct(version, *rest)).alias("_newest")
    return df.groupBy(*key).agg(newest).select(*key, "_newest.*")
