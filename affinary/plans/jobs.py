"""Whole jobs from one set of settings: what to train on, and what to report."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinary.functions.calendar import full_training_split
from affinary.operators.batching import shuffled
from affinary.operators.slices import report_order
from affinary.plans.evaluation import EvaluationData, EvaluationReport, ranked_rows, report
from affinary.plans.training import training_set, window_rows
from affinary.roles import JobSpec
from affinary.sources.sinks import stamp, write_report
from affinary.sources.scratch import Stage, materialize


def training_side(log: DataFrame, infer_day: int, days: int, spec: JobSpec, stage: Stage = materialize) -> DataFrame:
    """The training set of the full split under ``spec.train_filters``.

    With ``spec.shuffle`` its rows come in a random, repeatable order.
    """
    split = full_training_split(infer_day, days, spec.roles.event_date)
    train = training_set(log, [*split.train, *spec.train_filters], spec.roles.model_features, spec, stage=stage)
    return shuffled(train, train.columns) if spec.shuffle else train


def validation_side(log: DataFrame, infer_day: int, days: int, spec: JobSpec, stage: Stage = materialize) -> DataFrame:
    """The held-out day under ``spec.validation_filters``, without the pairs that the training window holds and without
    synthetic negatives."""
    split = full_training_split(infer_day, days, spec.roles.event_date)
    trained = window_rows(log, [*split.train, *spec.train_filters], spec).select(*spec.roles.pair)
    return training_set(log, [*split.validation, *spec.validation_filters], spec.roles.model_features, spec, seen=trained, stage=stage)


@dataclass(frozen=True)
class StoredEvaluation:
    """Folders of an evaluation's three reports."""

    slices: str
    overall: str
    duration: str


def evaluate_and_store(
    data: EvaluationData,
    scored_items: DataFrame,
    score: str,
    features: Mapping[str, DataFrame],
    spec: JobSpec,
    infer_day: int,
    folder: str,
    evaluate_time: str,
    data_type: str = "val",
    stage: Stage = materialize,
) -> StoredEvaluation:
    """Rank, report what the settings ask for, and store slices, overall values and watch time as stamped CSV.

    ``features`` gives the tables that bring the slicing columns, by the key to join on.
    """
    ranked = ranked_rows(data, scored_items, score, spec.roles, stage=stage)
    for key, table in features.items():
        ranked = ranked.join(table, key)
    ranked = stage(ranked, "ranked")
    found = report(ranked, spec.slice_by, spec.metrics, infer_day, spec.roles, spec.separate_by or None)
    return store_report(found, spec, folder, evaluate_time, data_type)


def store_report(found: EvaluationReport, spec: JobSpec, folder: str, evaluate_time: str, data_type: str) -> StoredEvaluation:
    """Store the reports: slices worst first in each feature's file, one overall row, watch time by rank.

    Settings without slicing features give the overall row alone.
    """
    paths = StoredEvaluation(f"{folder}/slices", f"{folder}/overall", f"{folder}/duration")
    slices = stamp(found.slices, evaluate_time, spec.name, data_type)
    write_report(slices, paths.slices, order_by=report_order(spec.metrics))
    whole = stamp(found.overall, evaluate_time, spec.name, data_type)
    for table, path in ((whole, paths.overall), (stamp(found.duration, evaluate_time, spec.name, data_type), paths.duration)):
        table.coalesce(1).write.mode("overwrite").option("header", True).csv(path)  # one row per separate value at most
    return paths


_TEXT = ("feature", "value", "evaluate_time", "model_name", "data_type")
_WHOLE = ("sample_count", "active_users", "day")


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """A stored report with its numbers typed; a report without slices has no rows and no columns."""
    try:
        stored = spark.read.option("header", True).csv(path)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.createDataFrame([], T.StructType())

    def typed(name: str):
        kind = "string" if name in _TEXT else "bigint" if name in _WHOLE else "double"
        return F.col(f"`{name}`").cast(kind).alias(name)

    return stored.select(*[typed(name) for name in stored.columns])
