"""Click models on Spark ML, and what is computed with them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from random import Random
from typing import Any

from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.feature import FeatureHasher
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinary.operators.metrics import auc
from affinary.roles import NEGATIVE, Roles
from affinary.sources.scratch import Stage, materialize


def clicked(roles: Roles = Roles()) -> Column:
    """The learning target: a positive label."""
    return F.col(roles.label) > NEGATIVE


@dataclass(frozen=True)
class MinMax:
    """Bounds of some columns, and their scaling to [0, 1]."""

    bounds: Mapping[str, tuple[float | None, float | None]]

    def transform(self, df: DataFrame, targets: Mapping[str, str] | None = None) -> DataFrame:
        """Replace each column by its scaled form, under its target name if one is given."""
        targets = targets or {}
        selected = []
        for name in df.columns:
            if name not in self.bounds:
                selected.append(F.col(name))
                continue
            low, high = self.bounds[name]
            value = F.col(name).cast("double")
            # a constant column sits in the middle
            flat = low is None or low == high
            scaled = F.when(value.isNotNull(), 0.5) if flat else (value - low) / (high - low)
            selected.append(scaled.alias(targets.get(name, name)))
        return df.select(*selected)


def fit_min_max(df: DataFrame, columns: Sequence[str]) -> MinMax:
    """Bounds of all columns from one aggregate."""
    wanted = [F.min(F.col(c).cast("double")).alias(f"low_{c}") for c in columns]
    wanted += [F.max(F.col(c).cast("double")).alias(f"high_{c}") for c in columns]
    row = df.agg(*wanted).first()
    return MinMax({c: (row[f"low_{c}"], row[f"high_{c}"]) for c in columns})


def _hasher(columns: Sequence[str], size: int) -> FeatureHasher:
    return FeatureHasher(inputCols=list(columns), categoricalCols=list(columns), numFeatures=size, outputCol="_x")


@dataclass(frozen=True)
class ClickModel:
    """A weighted logistic model on hashed categories.

    The logit is a sum of one part per feature, so for one user the items are
    ordered by their item parts alone (see ``operators.ranking``).
    """

    features: tuple[str, ...]
    size: int
    model: LogisticRegressionModel

    def _logit(self, df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
        hashed = _hasher(columns, self.size).transform(df)
        raw = self.model.transform(hashed)
        added = [self.model.getRawPredictionCol(), self.model.getProbabilityCol(), self.model.getPredictionCol()]
        logits = raw.withColumn("_logit", vector_to_array(F.col(added[0]))[1])
        return logits.drop("_x", *added).withColumnRenamed("_logit", out)

    def score(self, df: DataFrame, out: str = "prediction", logit: str = "logit") -> DataFrame:
        """Add the click probability and its logit; rows with a missing feature are dropped first."""
        complete = df.dropna("any", subset=list(self.features))
        return self._logit(complete, self.features, logit).withColumn(out, 1 / (1 + F.exp(-F.col(logit))))

    def part(self, df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
        """Add the share of the logit that comes from some of the features."""
        used = [name for name in columns if name in self.features]
        complete = df.dropna("any", subset=used)
        if not used:
            return complete.withColumn(out, F.lit(0.0))
        return self._logit(complete, used, out).withColumn(out, F.col(out) - self.model.intercept)


def merged_rows(df: DataFrame, features: Sequence[str], roles: Roles = Roles()) -> DataFrame:
    """Rows that are alike in features and target as one row, with the sums of their weights and of the weights' squares.

    A weighted loss is the same on them, and they are as many as there are combinations, however long the log is.
    """
    complete = df.select(*features, roles.label, roles.weight).dropna("any")
    target = F.when(clicked(roles), 1.0).otherwise(0.0).alias("_y")
    weight = F.col(roles.weight).cast("double")
    return complete.groupBy(*features, target).agg(F.sum(weight).alias("_w"), F.sum(weight * weight).alias("_w2"))


def _same_penalty(merged: DataFrame, params: Mapping[str, Any]) -> dict[str, Any]:
    """Penalties that weigh on merged rows as the given ones do on the rows themselves.

    They are taken of coefficients times standard deviations.  A deviation has the sum of weights less their mean by weight
    as its denominator, which merging makes smaller, for all columns alike.
    """
    strength, share = params.get("regParam", 0.0), params.get("elasticNetParam", 0.0)
    if not strength or not params.get("standardization", True):
        return dict(params)
    total, rows, groups = merged.agg(F.sum("_w"), F.sum("_w2"), F.sum(F.col("_w") * F.col("_w"))).first()
    if not total or total * total <= groups:
        return dict(params)
    variance = (total - rows / total) / (total - groups / total)
    absolute, squared = strength * share / variance**0.5, strength * (1 - share) / variance
    return {**params, "regParam": absolute + squared, "elasticNetParam": absolute / (absolute + squared)}


def _fit_merged(merged: DataFrame, features: Sequence[str], size: int, max_iter: int = 20, **params: Any) -> ClickModel:
    prepared = _hasher(features, size).transform(merged).select("_x", "_y", "_w")
    penalties = _same_penalty(merged, params)
    learner = LogisticRegression(featuresCol="_x", labelCol="_y", weightCol="_w", maxIter=max_iter, **penalties)
    return ClickModel(tuple(features), size, learner.fit(prepared))


def fit_click_model(
    df: DataFrame,
    features: Sequence[str],
    roles: Roles = Roles(),
    size: int = 1 << 18,
    max_iter: int = 20,
    **params: Any,
) -> ClickModel:
    """Fit on rows with label, weight and features; equal rows are merged first."""
    return _fit_merged(merged_rows(df, features, roles), features, size, max_iter, **params)


@dataclass(frozen=True)
class PerceptronModel:
    """A small network on hashed categories; unlike the click model it can continue from earlier weights."""

    features: tuple[str, ...]
    layers: tuple[int, ...]
    model: MultilayerPerceptronClassificationModel

    def score(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        hashed = _hasher(self.features, self.layers[0]).transform(df.dropna("any", subset=list(self.features)))
        scored = self.model.transform(hashed)
        return scored.withColumn("_p", vector_to_array(F.col("probability"))[1]).select(
            *df.columns, F.col("_p").alias(out)
        )


def fit_perceptron(
    df: DataFrame,
    features: Sequence[str],
    roles: Roles = Roles(),
    layers: Sequence[int] = (64, 8, 2),
    start: PerceptronModel | None = None,
    max_iter: int = 20,
    seed: int = 42,
) -> PerceptronModel:
    """Fit a network; with ``start`` training continues from that model's weights."""
    complete = df.select(*features, roles.label).dropna("any")
    prepared = _hasher(features, layers[0]).transform(complete).select(
        "_x", F.when(clicked(roles), 1.0).otherwise(0.0).alias("_y")
    )
    learner = MultilayerPerceptronClassifier(
        featuresCol="_x", labelCol="_y", layers=list(layers), maxIter=max_iter, seed=seed
    )
    if start is not None:
        learner = learner.setInitialWeights(start.model.weights)
    return PerceptronModel(tuple(features), tuple(layers), learner.fit(prepared))


def daily_refit(
    full_window: DataFrame,
    recent_window: DataFrame,
    features: Sequence[str],
    roles: Roles = Roles(),
    full_model: PerceptronModel | None = None,
    **options: Any,
) -> tuple[PerceptronModel, PerceptronModel]:
    """Refit on the newest days, starting from the full model, which is trained first if missing."""
    if full_model is None:
        full_model = fit_perceptron(full_window, features, roles, **options)
    return full_model, fit_perceptron(recent_window, features, roles, start=full_model, **options)


def search_space(grid: Mapping[str, Sequence[Any]], samples: int | None = None, seed: int = 42) -> list[dict[str, Any]]:
    """All combinations of a grid, or a seeded sample of them."""
    names = sorted(grid)
    combinations = [dict(zip(names, values)) for values in product(*[grid[name] for name in names])]
    if samples is None or samples >= len(combinations):
        return combinations
    return Random(seed).sample(combinations, samples)


def search_parameters(
    train: DataFrame,
    validation: DataFrame,
    features: Sequence[str],
    trials: Iterable[Mapping[str, Any]],
    roles: Roles = Roles(),
    size: int = 1 << 18,
    stage: Stage = materialize,
) -> DataFrame:
    """One row per trial with its validation AUC, best first.

    Train and validation are separated by date beforehand.  Both are read once: their equal rows are merged and
    staged, so fits and scores of all trials see a row per combination.  One sort gives the areas of all
    trials; the driver keeps one number per trial.
    """
    trials = list(trials)
    merged = stage(merged_rows(train, features, roles), "merged")
    complete = validation.dropna("any", subset=list(features))
    asked = complete.groupBy(*features, clicked(roles).alias("_hit")).agg(F.count(F.lit(1)).alias("_copies"))
    asked = stage(asked, "asked")
    scored = [
        _fit_merged(merged, features, size, **params).score(asked).select(F.lit(number).alias("_trial"), "prediction", "_hit", "_copies")
        for number, params in enumerate(trials)
    ]
    found = {}
    if scored:
        areas = auc(reduce(DataFrame.unionByName, scored), "prediction", F.col("_hit"), ["_trial"], stage, "_copies")
        found = {row["_trial"]: row["auc"] for row in areas.collect()}
    rows = [
        (number, ", ".join(f"{name}={params[name]}" for name in sorted(params)), found.get(number))
        for number, params in enumerate(trials)
    ]
    results = train.sparkSession.createDataFrame(rows, "trial int, params string, auc double")
    return results.orderBy(F.desc("auc"), "trial")


def feature_importance(model: ClickModel, df: DataFrame) -> DataFrame:
    """Mean absolute Shapley value of every feature over all rows, greatest first.

    For a sum of feature parts the Shapley value is the part minus its mean, so
    this is exact.  Each feature costs one narrow aggregate to (value, count).
    """
    complete = df.select(*model.features).dropna("any")

    def one(name: str) -> DataFrame:
        counts = complete.groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
        parts = model.part(counts, [name], "_part").select("_n", "_part")
        mean = parts.agg((F.sum(F.col("_part") * F.col("_n")) / F.sum("_n")).alias("_mean")).first()["_mean"]
        deviation = F.sum(F.abs(F.col("_part") - F.lit(mean)) * F.col("_n")) / F.sum("_n")
        return parts.agg(deviation.alias("importance")).select(F.lit(name).alias("feature"), "importance")

    tables = [one(name) for name in model.features]
    return reduce(DataFrame.unionByName, tables).orderBy(F.desc("importance"), "feature")
