"""Reports of every metric per value of every slicing feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinary.operators.metrics import Inputs, metric_named, partial_columns, score_columns
from affinary.roles import Roles
from affinary.sources.scratch import Stage, materialize

OVERALL = "OVERALL"
TASK_ROWS = 1 << 19  # rows of slices in a task, at most twice as many wide sums are held at a time
HEAVY_ROWS = 1 << 20  # rows of a user that are summed up where they lie


def slice_report(
    df: DataFrame,
    features: Sequence[str],
    metrics: Sequence[str],
    roles: Roles = Roles(),
    separate_by: str | None = None,
    prediction: str = "prediction",
    rank: str = "prediction_rank",
    stage: Stage = materialize,
) -> DataFrame:
    """Scores per (feature, value), and an OVERALL row per feature.

    A user's sums are much wider than a row and there is a set of them per slice.  So the narrow rows are staged
    and brought together by user, as many parts as there are rows for, and listed under their slices and
    summed up there; the sums are never shuffled, a second aggregate turns them into scores.  Users with very many rows
    are not brought together: their sums are combined before the shuffle.  Rows with a null slice value count in
    OVERALL only.  With ``separate_by`` the whole report repeats per its value.
    Rows come out worst first by the first metric.
    """
    chosen = [metric_named(name) for name in metrics]
    apart = [separate_by] if separate_by else []
    if separate_by:
        df = df.filter(F.col(separate_by).isNotNull())
    user = roles.user_id
    sources = {"label": roles.label, "prediction": prediction, "rank": rank}
    reads = {name for metric in chosen for name in metric.reads if sources[name] in df.columns}
    slices = [f"_f{i}" for i in range(len(features))]
    rows = df.select(
        *apart,
        user,
        *[F.col(name).cast("string").alias(alias) for alias, name in zip(slices, features)],
        *[F.col(sources[name]).alias(f"_{name}") for name in sorted(reads)],
    )
    rows = stage(rows, "slice_rows")
    n_parts = max(1, -(-rows.count() * (len(slices) + 1) // TASK_ROWS))

    # every user's rows are counted; a row per user of more than HEAVY_ROWS is left
    heavy = rows.groupBy(F.col(user).alias("_user")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HEAVY_ROWS)
    heavy = F.broadcast(stage(heavy.select("_user"), "heavy_users"))
    is_heavy = F.col(user).eqNullSafe(F.col("_user"))

    places = [F.struct(F.lit(at).alias("_at"), F.col(alias).alias("_value")) for at, alias in enumerate(slices)]
    places.append(F.struct(F.lit(len(slices)).alias("_at"), F.lit(OVERALL).alias("_value")))
    inputs = Inputs(F.col("_label"), F.col("_prediction"), F.col("_rank"))

    def summed(part: DataFrame) -> DataFrame:
        listed = part.select("*", F.inline(F.array(*places))).filter(F.col("_value").isNotNull())
        return listed.groupBy(*apart, user, "_at", "_value").agg(*partial_columns(chosen, inputs))

    users = summed(rows.join(heavy, is_heavy, "left_anti").repartition(n_parts, user))
    users = users.unionByName(summed(rows.join(heavy, is_heavy, "left_semi")))
    scored = users.groupBy(*apart, "_at", "_value").agg(*score_columns(chosen, user))
    # the overall row is computed once and listed under every feature
    names = F.array(*[F.lit(name) for name in features])
    listed = F.when(F.col("_at") == len(slices), names).otherwise(F.array(F.get(names, F.col("_at"))))
    scores = [F.col(f"`{name}`") for name in scored.columns if name not in (*apart, "_at", "_value")]
    scored = scored.select(*apart, F.explode(listed).alias("feature"), F.col("_value").alias("value"), *scores)
    return scored.orderBy(*apart, "feature", *report_order(metrics))


def report_order(metrics: Sequence[str]) -> list:
    """Sort columns that put the worst slice first."""
    first = metric_named(metrics[0])
    score = F.col(f"`{first.scores[0]}`")
    return [score.asc_nulls_last() if first.higher_is_better else score.desc_nulls_last(), F.col("value")]
