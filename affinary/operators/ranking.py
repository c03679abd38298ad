"""Ranking items per user without listing every user-item candidate.

The candidates of an evaluation are all users times all items, minus the pairs
already seen.  That table is never built.  When the score of a pair orders the
items the same way for every user (popularity, or any additive click model), the
rank of an item for a user is

    its position in the catalog  -  the user's seen items placed before it

so ranks come from a sorted catalog and the seen pairs alone, and the work grows
with those and not with users times items.  Scores that depend on both sides go
through ``operators.retrieval``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinary.operators.ordering import top_per_group, value_positions
from affinary.roles import Roles

UNRANKED = 9999  # fixed value: the rank of a pair outside the top k
SPAN_BITS = 20  # positions per span, as a power of two


def _span(position: str):
    return F.shiftright(F.col(position).cast("bigint"), SPAN_BITS)


def _earlier(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def taken_before(marks: DataFrame, group: str, position: str) -> DataFrame:
    """For every mark: how many taken marks of its group lie before it, and the last of them.

    ``marks`` has a boolean ``_taken``.  A group is cut into spans of positions
    with one summary row each, so no task sorts more than a span of a group.
    """
    spanned = marks.withColumn("_key", F.struct(group, _span(position).alias("_span")))
    taken_at = F.when(F.col("_taken"), F.col(position))
    spans = spanned.groupBy("_key").agg(F.count(taken_at).alias("_n"), F.max(taken_at).alias("_last"))
    over_spans = _earlier(Window.partitionBy(F.col(f"_key.{group}")).orderBy(F.col("_key._span")))
    spans = spans.select(
        "_key",
        F.coalesce(F.sum("_n").over(over_spans), F.lit(0)).alias("_n_before"),
        F.max("_last").over(over_spans).alias("_last_before"),
    )
    inside = _earlier(Window.partitionBy("_key").orderBy(position, F.desc("_taken")))
    local = spanned.withColumns(
        {"_n_inside": F.count(taken_at).over(inside), "_last_inside": F.max(taken_at).over(inside)}
    )
    return local.join(spans, "_key").withColumns(
        {
            "_before": F.col("_n_before") + F.col("_n_inside"),
            "_previous": F.coalesce("_last_inside", "_last_before"),
        }
    ).drop("_key", "_n_before", "_last_before", "_n_inside", "_last_inside")


def open_positions(groups: DataFrame, taken: DataFrame, group: str, position: str) -> DataFrame:
    """The first ``_limit`` free positions of each group, as runs.

    ``groups`` gives ``_end`` (one past the last position, counting from 0) and
    ``_limit``; ``taken`` lists occupied positions.  A run is (``_start_at``,
    ``_length``) with ``_before`` free positions in front of it.
    """
    closing = groups.select(group, F.col("_end").alias(position), F.lit(False).alias("_taken"))
    marks = taken.select(group, position, F.lit(True).alias("_taken")).unionByName(closing)
    runs = taken_before(marks, group, position).join(groups.select(group, "_limit"), group)
    start = F.coalesce(F.col("_previous") + 1, F.lit(0))
    runs = runs.select(
        group,
        start.alias("_start_at"),
        (start - F.col("_before")).alias("_free_before"),
        F.least(F.col(position) - start, F.col("_limit") - (start - F.col("_before"))).alias("_length"),
    )
    return runs.filter(F.col("_length") > 0).withColumnRenamed("_free_before", "_before")


def catalog_positions(items: DataFrame, score: str, roles: Roles = Roles()) -> DataFrame:
    """Items with their 1-based place by score; one row per item."""
    return value_positions(items.select(roles.item_id, score), score, [roles.item_id])


def candidate_counts(
    users: DataFrame, items: DataFrame, seen: DataFrame, roles: Roles = Roles(), n_items: int | None = None
) -> DataFrame:
    """Number of candidates of every user: catalog size minus the user's seen catalog items.

    ``users``, ``items`` and ``seen`` are distinct.
    """
    n_items = items.count() if n_items is None else n_items
    known = seen.join(items.select(roles.item_id), roles.item_id, "left_semi")
    known = known.groupBy(roles.user_id).agg(F.count(F.lit(1)).alias("_n"))
    left = F.lit(n_items) - F.coalesce(F.col("_n"), F.lit(0))
    return users.join(known, roles.user_id, "left").select(roles.user_id, left.alias("n_candidates"))


def rank_pairs(
    pairs: DataFrame,
    catalog: DataFrame,
    seen: DataFrame,
    roles: Roles = Roles(),
    out: str = "prediction_rank",
) -> DataFrame:
    """Rank of the given (user, item) pairs among all items the user has not seen.

    ``catalog`` comes from ``catalog_positions``.  Pairs that were seen, or whose
    item is not in the catalog, have no rank and drop out.
    """
    user, item = roles.pair
    places = catalog.select(item, "position")
    asked = pairs.select(user, item).distinct().join(seen, [user, item], "left_anti")
    marks = asked.withColumn("_taken", F.lit(False)).unionByName(
        # only users that are asked about need their seen items
        seen.select(user, item).join(asked.select(user).distinct(), user, "left_semi").withColumn("_taken", F.lit(True))
    )
    placed = taken_before(marks.join(places, item), user, "position")
    ranked = placed.filter(~F.col("_taken"))
    return ranked.select(user, item, (F.col("position") - F.col("_before")).alias(out))


def top_items(
    users: DataFrame, catalog: DataFrame, seen: DataFrame, k: int, roles: Roles = Roles(), out: str = "prediction_rank"
) -> DataFrame:
    """The ``k`` best unseen items of every user, with their ranks.

    Fills the gaps a user's seen items leave in the catalog order, up to k rows
    per user, so the result is all that is generated.
    """
    user, item = roles.pair
    n_items = catalog.count()
    places = catalog.withColumn("_at", F.col("position") - 1)
    taken = seen.join(users.select(user), user, "left_semi").join(places.select(item, "_at"), item)
    bounds = users.select(user, F.lit(n_items).cast("bigint").alias("_end"), F.lit(k).cast("bigint").alias("_limit"))
    runs = open_positions(bounds, taken, user, "_at")
    steps = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_length") - 1))
    slots = runs.select(user, "_start_at", "_before", steps.alias("_step"))
    filled = slots.select(
        user,
        (F.col("_start_at") + F.col("_step")).alias("_at"),
        (F.col("_before") + F.col("_step") + 1).alias(out),
    )
    score = [name for name in catalog.columns if name not in (item, "position")]
    return filled.join(places, "_at").select(user, item, *score, out)


def rank_scored(
    scored: DataFrame, score: str, k: int = 1000, roles: Roles = Roles(), out: str = "prediction_rank"
) -> DataFrame:
    """Top ``k`` rows per user of a table that already holds scored pairs.

    Null and NaN scores are dropped first: they would sort in front.  Equal
    scores are ordered by item.
    """
    usable = scored.filter(F.col(score).isNotNull() & ~F.isnan(score))
    return top_per_group(usable, [roles.user_id], [F.desc(score), F.col(roles.item_id)], k, out)


def having_predictions(rows: DataFrame, predicted: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key occurs among the predictions (or the content set)."""
    return rows.join(predicted.select(*key).distinct(), list(key), "left_semi")


def attach_ranks(rows: DataFrame, ranks: DataFrame, roles: Roles = Roles(), out: str = "prediction_rank") -> DataFrame:
    """Left join ranks; a pair outside the ranked ones gets ``UNRANKED``."""
    joined = rows.join(ranks.select(*roles.pair, out), roles.pair, "left")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(UNRANKED)))
