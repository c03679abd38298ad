"""Learning jobs; their results depend on the optimizer, so SQL has no equivalent."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinary.catalog import logs
from affinary.catalog.joins import day_data, flagged_log
from affinary.catalog.logs import FEATURES, HISTORY_DAYS, INFER_DAY, ROLES, SPEC
from affinary.catalog.registry import query
from affinary.catalog.training import stored_observations
from affinary.functions.calendar import full_training_split, refit_split
from affinary.operators.factorization import fit_factor_model
from affinary.operators.learning import (
    clicked,
    daily_refit,
    feature_importance,
    fit_click_model,
    search_parameters,
    search_space,
)
from affinary.operators.metrics import auc
from affinary.operators.retrieval import vector_top_k
from affinary.plans.evaluation import ranked_rows, report
from affinary.plans.training import training_set, window_rows
from affinary.sources.scratch import materialize

_SIZE = 1 << 14
_ITEM_PARTS = ["item_brand", "item_type"]


def _train(obs):
    split = full_training_split(INFER_DAY, HISTORY_DAYS)
    return materialize(training_set(obs, split.train, FEATURES, SPEC), "train")


def _sets(spark, sf_dir, obs=None):
    obs = stored_observations(spark, sf_dir) if obs is None else obs
    split = full_training_split(INFER_DAY, HISTORY_DAYS)
    return _train(obs), materialize(window_rows(obs, split.validation, SPEC), "validation")


@query()
def train_score_evaluate(spark, sf_dir):
    """Fit the click model, rank every user's unseen items by it, report per slice."""
    train = _train(stored_observations(spark, sf_dir))
    model = fit_click_model(train, FEATURES, ROLES, _SIZE)
    data = day_data(flagged_log(spark, sf_dir))
    # for one user the model orders items by their own part of the logit
    catalog = data.history.select("item_id").distinct().join(logs.items(spark, sf_dir), "item_id")
    scored = model.part(catalog, _ITEM_PARTS, "score").select("item_id", "score")
    people = logs.users(spark, sf_dir)
    ranked = ranked_rows(data, materialize(scored, "scores"), "score", ROLES, user_features=people)
    sliced = ranked.join(people.select("user_id", "user_region", "market_segment"), "user_id")
    metrics = ["recall_at_k", "precision_at_k", "ndcg_at_k"]
    return report(sliced, ["user_region", "market_segment"], metrics, INFER_DAY, ROLES).slices


@query()
def score_held_out_day(spark, sf_dir):
    """Click probability of every row of the held-out day."""
    train, held_out = _sets(spark, sf_dir)
    scored = fit_click_model(train, FEATURES, ROLES, _SIZE).score(held_out)
    return scored.select("event_id", "user_id", "item_id", "logit", "prediction")


@query()
def daily_model_refit(spark, sf_dir):
    """AUC of the full model and of its refit on the newest days."""
    obs = stored_observations(spark, sf_dir)
    train, held_out = _sets(spark, sf_dir, obs)
    recent = materialize(training_set(obs, refit_split(INFER_DAY).train, FEATURES, SPEC), "recent")
    full, refit = daily_refit(train, recent, FEATURES, ROLES)
    areas = [
        auc(model.score(held_out), "prediction", clicked(ROLES)).select(F.lit(name).alias("model"), "auc")
        for name, model in (("full", full), ("refit", refit))
    ]
    return areas[0].unionByName(areas[1])


@query()
def parameter_search(spark, sf_dir):
    train, held_out = _sets(spark, sf_dir)
    trials = search_space({"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.5]})
    return search_parameters(train, held_out, FEATURES, trials, ROLES, _SIZE)


@query()
def feature_importances(spark, sf_dir):
    train, held_out = _sets(spark, sf_dir)
    return feature_importance(fit_click_model(train, FEATURES, ROLES, _SIZE), held_out)


@query()
def factor_model_top_items(spark, sf_dir):
    """Top items per user by a model with user-item interactions."""
    train = _train(stored_observations(spark, sf_dir))
    model = fit_factor_model(train, ["market_segment", "user_region", "user_nation"], _ITEM_PARTS, ROLES)
    data = day_data(flagged_log(spark, sf_dir))
    people = data.users.join(logs.users(spark, sf_dir), "user_id")
    goods = data.history.select("item_id").distinct().join(logs.items(spark, sf_dir), "item_id")
    seen = data.history.select("user_id", "item_id")
    return vector_top_k(model.user_vectors(people, ROLES), model.item_vectors(goods, ROLES), 20, seen, ROLES)
