"""Offline evaluation: rank what users did next among everything they had not seen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinary.functions.calendar import days_before, window_filters
from affinary.functions.predicates import Predicate, all_of, apply_filters
from affinary.operators.metrics import duration_at_k
from affinary.operators.pairs import anti_join, first_per_key, union_all
from affinary.operators.ranking import (
    attach_ranks,
    candidate_counts,
    catalog_positions,
    having_predictions,
    rank_pairs,
)
from affinary.operators.slices import OVERALL, slice_report
from affinary.roles import POSITIVE, Roles
from affinary.sources.scratch import Stage, materialize


@dataclass(frozen=True)
class EvaluationData:
    """What one evaluation day is made of.

    users: distinct users with a positive that day
    rows: that day's first positive of every unseen pair whose item is in the content set
    history: distinct positive pairs of the window before, with their ``n_positives``
    """

    users: DataFrame
    rows: DataFrame
    history: DataFrame


def history_rows(log: DataFrame, day: int, days: int, roles: Roles = Roles()) -> DataFrame:
    """Positives of the ``days`` days before ``day``."""
    return apply_filters(log, [*window_filters(day, days, column=roles.event_date), f"{roles.label} == {POSITIVE}"])


def content_set(history: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Distinct items of the history; the item is repeated as ``content_id``."""
    return history.select(roles.item_id).distinct().withColumn("content_id", F.col(roles.item_id))


def evaluation_data(
    log: DataFrame,
    infer_day: int,
    days: int,
    columns: Sequence[str],
    roles: Roles = Roles(),
    user_filters: Sequence[Predicate] = (),
    stage: Stage = materialize,
) -> EvaluationData:
    """Rows to evaluate on the day before ``infer_day`` and the history before that day.

    The history window is read once: its pairs are counted, with those of the
    evaluated users marked, and stored.  The content set (items of all users) and
    the history of the evaluated users both come from that table.
    """
    day = days_before(infer_day, 1)
    user, item = roles.pair
    today = apply_filters(log, [f"{roles.event_date} == {day}", f"{roles.label} == {POSITIVE}", *user_filters])
    kept = list(dict.fromkeys([user, item, roles.label, roles.duration, *columns]))
    order = [roles.row_id] if roles.row_id else kept
    firsts = first_per_key(today.select(*dict.fromkeys([*kept, *order])), roles.pair, order).select(*kept)

    mine = F.count(F.when(all_of(user_filters), 1)).alias("n_positives")
    window = stage(history_rows(log, day, days, roles).groupBy(user, item).agg(mine), "window")
    history = window.filter(F.col("n_positives") > 0)
    rows = having_predictions(anti_join(firsts, history, roles.pair), content_set(window, roles), [item])
    return EvaluationData(today.select(user).distinct(), stage(rows, "rows"), history)


def catalog_items(history: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Items that can be recommended: those of the history."""
    return history.select(roles.item_id).distinct()


def popularity_scores(history: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Positives per history item: the score of recommending what is popular."""
    return history.groupBy(roles.item_id).agg(F.sum("n_positives").alias("score"))


def ranked_rows(
    data: EvaluationData,
    scored_items: DataFrame,
    score: str,
    roles: Roles = Roles(),
    top_k: int = 1000,
    user_features: DataFrame | None = None,
    stage: Stage = materialize,
) -> DataFrame:
    """Evaluation rows with ``prediction_rank``; pairs outside the top k get the unranked value.

    ``scored_items`` are the catalog items that have features, with their score,
    as a stored table: they are counted first.
    ``user_features`` restricts the users to those with features, which is what
    an inner join of candidate pairs with the features would do.
    """
    places = stage(catalog_positions(scored_items, score, roles), "catalog")
    users = data.users
    if user_features is not None:
        users = users.join(user_features.select(roles.user_id).distinct(), roles.user_id, "left_semi")
    n_items = places.count()
    left = candidate_counts(users, places, data.history, roles, n_items)
    predicted = left.filter(F.col("n_candidates") > 0)
    rows = having_predictions(data.rows, predicted, [roles.user_id])
    ranks = rank_pairs(data.rows, places, data.history, roles)
    ranks = ranks.filter(F.col("prediction_rank") <= top_k)
    return attach_ranks(rows, ranks, roles)


def compare_models(
    data: EvaluationData,
    models: Mapping[str, DataFrame],
    score: str,
    features: Mapping[str, DataFrame],
    metrics: Sequence[str],
    roles: Roles = Roles(),
    top_k: int = 1000,
    stage: Stage = materialize,
) -> DataFrame:
    """The sliced report of every model version over the same rows, with the model's name.

    ``models`` gives each version's scored items; ``features`` the tables that
    bring the slicing columns, by the key to join on.
    """
    slices = [name for key, table in features.items() for name in table.columns if name != key]
    reports = []
    for name, scored_items in models.items():
        ranked = ranked_rows(data, scored_items, score, roles, top_k, stage=stage)
        for key, table in features.items():
            ranked = ranked.join(table, key)
        reports.append(slice_report(ranked, slices, metrics, roles).select(F.lit(name).alias("model"), "*"))
    return union_all(*reports)


@dataclass(frozen=True)
class EvaluationReport:
    """Metrics per slice, of all rows, and watch time by rank."""

    slices: DataFrame
    overall: DataFrame
    duration: DataFrame


def report(
    ranked: DataFrame,
    features: Sequence[str],
    metrics: Sequence[str],
    day: int,
    roles: Roles = Roles(),
    separate_by: str | None = None,
) -> EvaluationReport:
    """All metrics per slice, and watch time by rank."""
    watched = duration_at_k(ranked, roles).select(F.lit(day).alias("day"), "*")
    if features:
        slices = slice_report(ranked, features, metrics, roles, separate_by)
        every = slices
    else:
        # nothing to slice by: one feature without values gives the overall row
        every = slice_report(ranked.withColumn("_none", F.lit(None).cast("string")), ["_none"], metrics, roles, separate_by)
        slices = every.filter(F.lit(False))
    first = features[0] if features else "_none"
    # every slicing feature repeats the same overall row
    overall = every.filter((F.col("value") == OVERALL) & (F.col("feature") == first)).drop("feature", "value")
    return EvaluationReport(slices, overall, watched)
