"""Jobs run from settings, and their stored reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from affinary.catalog import logs
from affinary.catalog.joins import day_data, flagged_log
from affinary.catalog.logs import HISTORY_DAYS, INFER_DAY
from affinary.catalog.registry import query, rounded
from affinary.catalog.scores import _DURATIONS, _METRICS, _NAMES, EVALUATED_SQL, _slices_sql
from affinary.catalog.training import _FULL_SQL, _SET_COLUMNS, _VALIDATION_SQL, stored_observations
from affinary.plans.evaluation import popularity_scores
from affinary.plans.jobs import evaluate_and_store, read_stored, training_side, validation_side
from affinary.roles import spec_from_mapping
from affinary.sources.scratch import materialize, new_path

_SLICES = ("user_region", "item_type", "market_segment")
_STAMPS = "'2024-01-31 00:00:00' AS evaluate_time, 'clicks' AS model_name, 'val' AS data_type"

# the settings of a model file, as its reader gives them
SETTINGS = {
    "config_name": "clicks",
    "data_loader": {
        "user_id_col": "user_id",
        "item_id_col": "item_id",
        "time_order_event_col": "filename_date",
        "label_col": "is_interacted",
        "duration_col": "duration",
        "weight_col": "weighted_lr",
        "popularity_item_group_col": "popularity_item_group",
        "row_id_col": "event_id",
        "account_feature_names": ["market_segment", "user_region"],
        "user_feature_names": ["user_nation"],
        "item_feature_names": ["item_brand", "item_type"],
        "context_feature_names": ["is_weekend"],
        "popularity_sample_groups": [1, 2],
        "factor_popularity_sample_groups": [0.1, 0.05],
        "tail_sample_groups": [3, 4, 5, 0],
        "factor_tail_sample_groups": [0.5, 0.3, 0.25, 1.0],
        "batch_size": 200,
        "shuffle": True,
        "train_filters": ["item_id >= 0"],
    },
    "model_analysis": {
        "metrics": _METRICS,
        "by_external_user_features": ["user_region"],
        "by_external_item_features": ["item_type"],
        "by_features": ["market_segment"],
    },
}


@query(f"{_FULL_SQL} SELECT {_SET_COLUMNS} FROM numbered")
def training_from_settings(spark, sf_dir):
    """The training set that the settings describe; the filter holds for all items."""
    return rounded(training_side(stored_observations(spark, sf_dir), INFER_DAY, HISTORY_DAYS, spec_from_mapping(SETTINGS)))


@query(_VALIDATION_SQL)
def validation_from_settings(spark, sf_dir):
    """The validation set that the settings describe: the held-out day without pairs trained on, nothing synthetic."""
    return rounded(validation_side(stored_observations(spark, sf_dir), INFER_DAY, HISTORY_DAYS, spec_from_mapping(SETTINGS)))


def _stored(spark, sf_dir):
    spec = spec_from_mapping(SETTINGS)
    data = day_data(flagged_log(spark, sf_dir))
    scores = materialize(popularity_scores(data.history, spec.roles), "scores")
    features = {
        "user_id": logs.users(spark, sf_dir).select("user_id", "user_region", "market_segment"),
        "item_id": logs.items(spark, sf_dir).select("item_id", "item_type"),
    }
    folder = new_path(spark, "evaluation")
    return evaluate_and_store(data, scores, "score", features, spec, INFER_DAY, folder, "2024-01-31 00:00:00")


@query(f"SELECT *, {_STAMPS} FROM (WITH {EVALUATED_SQL}, {_slices_sql('evaluated', _SLICES, _NAMES)})")
def evaluation_from_settings(spark, sf_dir):
    """The sliced report that the settings ask for, from its stored form."""
    return rounded(read_stored(spark, _stored(spark, sf_dir).slices))


@query(
    f"""SELECT * EXCLUDE (feature, value), {_STAMPS} FROM (WITH {EVALUATED_SQL}, {_slices_sql('evaluated', _SLICES[:1], _NAMES)})
    WHERE value = 'OVERALL'"""
)
def evaluation_overall(spark, sf_dir):
    """The overall values of the same evaluation, from their stored form."""
    return rounded(read_stored(spark, _stored(spark, sf_dir).overall))


@query(
    f"""WITH {EVALUATED_SQL} SELECT CAST({INFER_DAY} AS BIGINT) AS day, count(DISTINCT user_id) FILTER (is_interacted = 2) AS active_users, {_DURATIONS}, {_STAMPS}
    FROM evaluated"""
)
def evaluation_duration(spark, sf_dir):
    """Watch time by rank of the same evaluation, from its stored form."""
    return rounded(read_stored(spark, _stored(spark, sf_dir).duration))


@query(
    f"""SELECT value, {_STAMPS.split(", ")[1]}, row_number() OVER (ORDER BY "recall@1", value) AS place
    FROM (WITH {EVALUATED_SQL}, {_slices_sql('evaluated', _SLICES[1:2], _NAMES)})"""
)
def evaluation_slice_order(spark, sf_dir):
    """The place of every slice in its stored report, worst first by the first metric."""
    found = read_stored(spark, f"{_stored(spark, sf_dir).slices}/feature={_SLICES[1]}")
    # one file per feature, read in its own order
    lines = found.select("value", "model_name", F.monotonically_increasing_id().alias("at")).coalesce(1)
    return lines.select("value", "model_name", F.row_number().over(Window.orderBy("at")).cast("bigint").alias("place"))
