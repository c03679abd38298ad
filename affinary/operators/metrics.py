"""Ranking and error metrics as aggregate columns.

A metric contributes columns to one aggregate per user and columns to one
aggregate over users.  All metrics asked for share those two aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate
from math import log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinary.functions.columns import double_array
from affinary.functions.vectors import discount
from affinary.operators.ordering import place_in_order
from affinary.roles import POSITIVE, Roles
from affinary.sources.scratch import Stage, materialize

# fixed values: the cut-offs every report uses; 9999 stands for all ranks
CUTOFFS = (1, 5, 10, 20, 100, 200, 500, 1000)
DURATION_CUTOFFS = (*CUTOFFS, 9999)
SCORE_CHUNK_BITS = 12  # 4,096 distinct scores in a chunk


@dataclass(frozen=True)
class Inputs:
    """Columns a metric reads."""

    label: Column
    prediction: Column
    rank: Column


@dataclass(frozen=True)
class Metric:
    """``per_user`` names the partial sums of one user, ``overall`` the scores made of them.

    Each score is averaged over users, unless ``per_row_mean`` says that
    ``overall`` already aggregates the partials itself.  ``reads`` names the inputs ``per_user`` is made of.
    """

    name: str
    scores: tuple[str, ...]
    higher_is_better: bool
    per_user: Callable[[Inputs], Mapping[str, Column]]
    overall: Callable[[], Mapping[str, Column]]
    per_row_mean: bool = False
    reads: tuple[str, ...] = ("label", "prediction", "rank")


_registry: dict[str, Metric] = {}


def register(metric: Metric) -> Metric:
    """Make a metric available to reports by name."""
    if not metric.scores:
        raise ValueError(f"metric {metric.name!r} declares no scores")
    _registry[metric.name] = metric
    return metric


def metric_named(name: str) -> Metric:
    if name not in _registry:
        raise ValueError(f"unknown metric {name!r}, known are {sorted(_registry)}")
    return _registry[name]


def registered() -> dict[str, Metric]:
    return dict(_registry)


def _hits(inputs: Inputs) -> dict[str, Column]:
    return {f"hits_{k}": F.sum(F.when(inputs.rank <= k, 1).otherwise(0)) for k in CUTOFFS}


def _relevant(inputs: Inputs) -> dict[str, Column]:
    return {"n_ranked": F.count(inputs.rank)}


def ideal_gain(relevant: Column, k: int) -> Column:
    """Discounted gain of a perfect list: the first ``min(relevant, k)`` places all hit."""
    totals = accumulate((1 / log2(place + 1) for place in range(1, k + 1)), initial=0.0)
    return F.element_at(double_array(totals), F.least(relevant, F.lit(k)).cast("int") + 1)


register(
    Metric(
        "recall_at_k",
        tuple(f"recall@{k}" for k in CUTOFFS),
        True,
        lambda inputs: {**_hits(inputs), **_relevant(inputs)},
        lambda: {f"recall@{k}": F.try_divide(F.col(f"hits_{k}"), F.col("n_ranked")) for k in CUTOFFS},
        reads=("rank",),
    )
)
register(
    Metric(
        "precision_at_k",
        tuple(f"precision@{k}" for k in CUTOFFS),
        True,
        _hits,
        lambda: {f"precision@{k}": F.col(f"hits_{k}") / k for k in CUTOFFS},
        reads=("rank",),
    )
)
register(
    Metric(
        "ndcg_at_k",
        tuple(f"ndcg@{k}" for k in CUTOFFS),
        True,
        lambda inputs: {
            **{f"gain_{k}": F.sum(F.when(inputs.rank <= k, discount(inputs.rank)).otherwise(0.0)) for k in CUTOFFS},
            **_relevant(inputs),
        },
        lambda: {
            f"ndcg@{k}": F.try_divide(F.col(f"gain_{k}"), ideal_gain(F.col("n_ranked"), k)) for k in CUTOFFS
        },
        reads=("rank",),
    )
)
register(
    Metric(
        "rmse",
        ("rmse",),
        False,
        lambda inputs: {
            "squared_error": F.sum(F.pow(inputs.label - inputs.prediction, 2)),
            "n_errors": F.count(inputs.label - inputs.prediction),
        },
        lambda: {"rmse": F.sqrt(F.try_divide(F.sum("squared_error"), F.sum("n_errors")))},
        per_row_mean=True,
        reads=("label", "prediction"),
    )
)


def partial_columns(metrics: Sequence[Metric], inputs: Inputs) -> list[Column]:
    """Per-user aggregate columns of several metrics, each once."""
    merged: dict[str, Column] = {"sample_count": F.count(F.lit(1))}
    for metric in metrics:
        merged.update(metric.per_user(inputs))
    return [column.alias(name) for name, column in merged.items()]


def score_columns(metrics: Sequence[Metric], user: str) -> list[Column]:
    """Aggregates over users: row count and the scores.

    A row without a user counts as a row and belongs to no user's score.
    """
    columns = [F.sum("sample_count").alias("sample_count")]
    for metric in metrics:
        computed = metric.overall()
        if set(computed) != set(metric.scores):
            raise ValueError(f"metric {metric.name!r} declares {metric.scores} but computes {tuple(computed)}")
        for name, value in computed.items():
            score = value if metric.per_row_mean else F.avg(F.when(F.col(user).isNotNull(), value))
            columns.append(score.alias(name))
    return columns


def inputs_for(roles: Roles, prediction: str = "prediction", rank: str = "prediction_rank") -> Inputs:
    return Inputs(F.col(roles.label), F.col(prediction), F.col(rank))


def evaluate(
    df: DataFrame,
    metrics: Sequence[str],
    roles: Roles = Roles(),
    prediction: str = "prediction",
    rank: str = "prediction_rank",
) -> DataFrame:
    """One row with every score of the metrics."""
    chosen = [metric_named(name) for name in metrics]
    users = df.groupBy(roles.user_id).agg(*partial_columns(chosen, inputs_for(roles, prediction, rank)))
    return users.agg(*score_columns(chosen, roles.user_id))


def duration_at_k(
    df: DataFrame, roles: Roles = Roles(), focus: str | None = None, rank: str = "prediction_rank", positive: int = POSITIVE
) -> DataFrame:
    """Watch time of positives ranked within each cut-off, per user with a positive."""
    watched = F.col(focus or roles.duration)
    is_positive = F.col(roles.label) == positive
    sums = [
        F.sum(F.when(is_positive & (F.col(rank) <= k), watched).otherwise(0.0)).alias(f"within_{k}")
        for k in DURATION_CUTOFFS
    ]
    users = df.groupBy(roles.user_id).agg(F.max(F.when(is_positive, 1).otherwise(0)).alias("_active"), *sums)
    active = F.sum(F.when(F.col(roles.user_id).isNotNull(), F.col("_active")))
    return users.agg(
        active.alias("active_users"),
        *[
            F.try_divide(F.sum(f"within_{k}"), active).alias("duration_all" if k == 9999 else f"duration@{k}")
            for k in DURATION_CUTOFFS
        ],
    )


def count_active_users(df: DataFrame, roles: Roles = Roles(), positive: int = POSITIVE) -> DataFrame:
    positives = df.filter(F.col(roles.label) == positive)
    return positives.agg(F.countDistinct(roles.user_id).alias("active_users"))


def auc(
    df: DataFrame, score: str, target: Column, by: Sequence[str] = (), stage: Stage = materialize, copies: str | None = None
) -> DataFrame:
    """Exact area under the ROC curve, ties counted half, overall or per group; a row stands for as many as ``copies`` says.

    Rows are combined per distinct score, and that table is sorted by range partitions and staged.
    Chunks of consecutive scores count their own wins; a chunk's positives also win against the
    negatives of the earlier chunks.  So no task sums up all scores.
    """
    usable = df.filter(F.col(score).isNotNull() & ~F.isnan(score) & target.isNotNull())
    value = F.col(score).cast("double")
    n = F.lit(1) if copies is None else F.col(copies)
    ties = usable.groupBy(*by, value.alias("_s")).agg(
        F.sum(F.when(target, n).otherwise(0)).alias("_pos"), F.sum(F.when(target, 0).otherwise(n)).alias("_neg")
    )
    placed = place_in_order(ties, [*by, "_s"], stage, "_at")
    # the partition is in the high bits, so a chunk lies in one
    chunked = placed.withColumn("_chunk", F.shiftright("_at", SCORE_CHUNK_BITS))

    def before(*part: str) -> Column:
        window = Window.partitionBy(*part) if part else Window.partitionBy(F.lit(0))
        return F.coalesce(F.sum("_neg").over(window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    wins = F.col("_pos").cast("double") * (F.col("_below") + F.col("_neg") / 2)
    inside = chunked.withColumn("_below", before(*by, "_chunk")).groupBy(*by, "_chunk").agg(
        F.sum(wins).alias("_wins"), F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"), F.min("_at").alias("_at")
    )
    # a row per chunk
    across = inside.withColumn("_below", before(*by))
    all_wins = F.sum(F.col("_wins") + F.col("_pos").cast("double") * F.col("_below"))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg")
    area = F.try_divide(all_wins, pairs).alias("auc")
    return across.groupBy(*by).agg(area) if by else across.agg(area)


def log_loss(df: DataFrame, logit: str, target: Column, weight: str | None = None) -> DataFrame:
    """Binary cross entropy from logits, in a form that does not overflow.

    ``log_loss`` weighs every row; ``log_loss_times_mean_weight`` is the mean loss
    times the mean weight, the form some trainers report.
    """
    z, y = F.col(logit), F.when(target, 1.0).otherwise(0.0)
    loss = F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    return df.agg(
        F.try_divide(F.sum(loss * w), F.sum(w)).alias("log_loss"),
        (F.avg(loss) * F.avg(w)).alias("log_loss_times_mean_weight"),
    )


def log_loss_of_probability(df: DataFrame, probability: str, target: Column, weight: str | None = None) -> DataFrame:
    """The same two losses from probabilities; logarithms are cut off at -100."""
    p = F.col(probability)
    floor = F.lit(-100.0)
    hit = F.greatest(F.when(p > 0, F.log(p)).otherwise(floor), floor)
    miss = F.greatest(F.when(p < 1, F.log1p(-p)).otherwise(floor), floor)
    loss = -F.when(target, hit).otherwise(miss)
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    return df.agg(
        F.try_divide(F.sum(loss * w), F.sum(w)).alias("log_loss"),
        (F.avg(loss) * F.avg(w)).alias("log_loss_times_mean_weight"),
    )


def best_run(runs: DataFrame, run: str, score: str) -> DataFrame:
    """The best score over runs and the run that reached it (the first such run on ties)."""
    best = F.max(score).alias("best_score")
    return runs.agg(best, F.min_by(run, F.struct(-F.col(score), F.col(run))).alias("best_run"))

