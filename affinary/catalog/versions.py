"""Model versions by date, evaluated on dated snapshots of features."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinary.catalog import logs
from affinary.catalog.additive import _ITEM_JOINS, _ITEM_TOTAL, _parts_sql
from affinary.catalog.joins import HISTORY_SQL, day_data, flagged_log
from affinary.catalog.logs import EVAL_DAY, FEATURES, HISTORY_DAYS, INFER_DAY, OBS_SQL, ROLES
from affinary.catalog.registry import query, rounded
from affinary.catalog.scores import _METRICS, _NAMES, _slices_sql
from affinary.catalog.training import stored_observations
from affinary.functions.calendar import days_before
from affinary.operators.refit import CountStore, refit
from affinary.plans.versions import ModelStore, evaluate_versions
from affinary.sources.scratch import new_path
from affinary.sources.snapshots import Snapshots

_VERSIONS = {"train": EVAL_DAY, "val": days_before(EVAL_DAY, 1)}
_SLICES = ("user_region", "item_type")


def _snapshots(spark, sf_dir) -> tuple[Snapshots, Snapshots]:
    """User and item features of several days; some features are missing on the evaluated day."""
    users = Snapshots(new_path(spark, "user-features"), "user_id")
    items = Snapshots(new_path(spark, "item-features"), "item_id")
    people = logs.users(spark, sf_dir).drop("is_infering_user")
    goods = logs.items(spark, sf_dir).drop("item_size")
    hole = F.lit(None).cast("string")
    users.write(people.withColumn("user_region", F.lit("before")), days_before(EVAL_DAY, 9))
    users.write(people.withColumn("market_segment", F.when(F.col("user_id") % 11 != 0, F.col("market_segment")).otherwise(hole)), EVAL_DAY)
    users.write(people.withColumn("user_region", F.lit("after")), INFER_DAY)
    items.write(goods.withColumn("item_brand", F.when(F.col("item_id") % 7 != 0, F.col("item_brand")).otherwise(hole)), days_before(EVAL_DAY, 2))
    items.write(goods.withColumn("item_type", F.lit("after")), INFER_DAY)
    return users, items


def _version_sql(name: str, day: int) -> str:
    history = HISTORY_SQL.replace(
        "scores AS (SELECT item_id, count(*) AS score FROM hist GROUP BY 1)",
        f"""goods AS (SELECT * FROM items WHERE item_id % 7 <> 0 AND item_id IN (SELECT item_id FROM hist)),
        scores AS (SELECT item_id, round({_ITEM_TOTAL}, 9) AS score FROM goods t {_ITEM_JOINS})""",
    ).replace("(SELECT DISTINCT user_id FROM firsts) u", "(SELECT DISTINCT user_id FROM firsts WHERE user_id % 11 <> 0) u")
    return f"""SELECT '{name}' AS model, CAST({day} AS INTEGER) AS version, * FROM (WITH {OBS_SQL}, learned AS (
        SELECT *, CASE WHEN is_interacted > 1 THEN weighted_lr ELSE 0 END AS pos, CASE WHEN is_interacted > 1 THEN 0 ELSE weighted_lr END AS neg
        FROM obs WHERE is_interacted > 0 AND filename_date > {days_before(day, HISTORY_DAYS)} AND filename_date <= {day}),
      {_parts_sql()}, {history},
      evaluated AS (
        SELECT e.*, coalesce(prediction_rank, 9999) AS prediction_rank, user_region, item_type
        FROM eval_rows e LEFT JOIN (SELECT * FROM ranked WHERE prediction_rank <= 1000) r USING (user_id, item_id)
        JOIN users USING (user_id) JOIN items USING (item_id)
        WHERE e.user_id IN (SELECT user_id FROM candidates)),
      {_slices_sql('evaluated', _SLICES, _NAMES)})"""


@query(" UNION ALL ".join(_version_sql(name, day) for name, day in _VERSIONS.items()))
def evaluation_by_version(spark, sf_dir):
    """The models of two days, each refitted and kept on its day, on the same rows and the newest earlier snapshots."""
    log = stored_observations(spark, sf_dir).filter("is_interacted > 0")
    counts = CountStore(new_path(spark, "click-counts"), tuple(FEATURES), (), ROLES)
    models = ModelStore(new_path(spark, "models"))
    for day in sorted(_VERSIONS.values()):
        models.save(refit(log, counts, day, HISTORY_DAYS), day)
    users, items = _snapshots(spark, sf_dir)
    data = day_data(flagged_log(spark, sf_dir))
    return rounded(evaluate_versions(data, models, _VERSIONS, users, items, EVAL_DAY, _SLICES, _METRICS, ROLES))
