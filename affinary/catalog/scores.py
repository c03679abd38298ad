"""Metrics, sliced reports and the offline evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinary.catalog import logs
from affinary.catalog.joins import RANKED_SQL, day_data, flagged_log
from affinary.catalog.logs import EVAL_DAY, INFER_DAY, ITEMS_SQL, LOG_SQL, OBS_SQL, ORDERS_SQL, ROLES
from affinary.catalog.registry import query, rounded
from affinary.operators.learning import clicked
from affinary.operators.metrics import CUTOFFS, DURATION_CUTOFFS, auc, best_run, duration_at_k, evaluate, log_loss, log_loss_of_probability
from affinary.operators.ranking import catalog_positions
from affinary.operators.sampling import resample_check
from affinary.operators.slices import slice_report
from affinary.plans.evaluation import compare_models, popularity_scores, ranked_rows, report
from affinary.sources.scratch import materialize

# ---- ranking metrics ------------------------------------------------------

EVALUATED_SQL = f"""{RANKED_SQL},
evaluated AS (
  SELECT e.event_id, e.user_id, e.item_id, e.is_interacted, e.duration, coalesce(prediction_rank, 9999) AS prediction_rank,
         user_region, item_type, market_segment
  FROM eval_rows e LEFT JOIN (SELECT * FROM ranked WHERE prediction_rank <= 1000) r USING (user_id, item_id)
  JOIN users USING (user_id) JOIN (SELECT p_partkey AS item_id, p_type AS item_type FROM part) USING (item_id)
  WHERE e.user_id IN (SELECT user_id FROM candidates))"""


def _recall(k: int) -> str:
    return f"sum(CASE WHEN prediction_rank <= {k} THEN 1 ELSE 0 END) / count(prediction_rank)"


def _precision(k: int) -> str:
    return f"sum(CASE WHEN prediction_rank <= {k} THEN 1 ELSE 0 END) / {k}"


def _ndcg(k: int) -> str:
    gain = f"sum(CASE WHEN prediction_rank <= {k} THEN 1 / log2(prediction_rank + 1) ELSE 0 END)"
    ideal = f"list_sum(list_transform(range(1, least(count(prediction_rank), {k}) + 1), lambda i: 1 / log2(i + 1)))"
    return f"{gain} / {ideal}"


_FORMULA = {"recall": _recall, "precision": _precision, "ndcg": _ndcg}


def _users_sql(source: str, names: tuple[str, ...], by: str = "") -> str:
    """Per-user scores under plain names."""
    columns = ", ".join(f"{_FORMULA[name](k)} AS {name}_{k}" for name in names for k in CUTOFFS)
    return f"SELECT {by} user_id, count(*) AS n, {columns} FROM {source} GROUP BY {by} user_id"


def _means_sql(names: tuple[str, ...]) -> str:
    columns = ", ".join(f'round(avg({name}_{k}), 6) AS "{name}@{k}"' for name in names for k in CUTOFFS)
    return f"CAST(sum(n) AS BIGINT) AS sample_count, {columns}"


def _metric_sql(*names: str) -> str:
    return f"WITH {EVALUATED_SQL}, per_user AS ({_users_sql('evaluated', names)}) SELECT {_means_sql(names)} FROM per_user"


def _evaluated(spark, sf_dir):
    """Evaluation rows of the popularity model with their ranks and slicing features."""
    data = day_data(flagged_log(spark, sf_dir))
    scores = materialize(popularity_scores(data.history, ROLES), "scores")
    ranked = ranked_rows(data, scores, "score", ROLES)
    people = logs.users(spark, sf_dir).select("user_id", "user_region", "market_segment")
    kinds = logs.items(spark, sf_dir).select("item_id", "item_type")
    return ranked.join(people, "user_id").join(kinds, "item_id")


@query(_metric_sql("recall", "precision"))
def rank_evaluation_minimum(spark, sf_dir):
    return rounded(evaluate(_evaluated(spark, sf_dir), ["recall_at_k", "precision_at_k"], ROLES))


@query(_metric_sql("recall"))
def recall_at_k(spark, sf_dir):
    return rounded(evaluate(_evaluated(spark, sf_dir), ["recall_at_k"], ROLES))


@query(_metric_sql("precision"))
def precision_at_k(spark, sf_dir):
    return rounded(evaluate(_evaluated(spark, sf_dir), ["precision_at_k"], ROLES))


@query(_metric_sql("ndcg"))
def ndcg_at_k(spark, sf_dir):
    return rounded(evaluate(_evaluated(spark, sf_dir), ["ndcg_at_k"], ROLES))


_DURATIONS = ", ".join(
    f"round(sum(CASE WHEN prediction_rank <= {k} AND is_interacted = 2 THEN duration ELSE 0 END) "
    f"/ count(DISTINCT user_id) FILTER (is_interacted = 2), 6) AS " + ('"duration_all"' if k == 9999 else f'"duration@{k}"')
    for k in DURATION_CUTOFFS
)


@query(f"WITH {EVALUATED_SQL} SELECT count(DISTINCT user_id) FILTER (is_interacted = 2) AS active_users, {_DURATIONS} FROM evaluated")
def watch_time_at_k(spark, sf_dir):
    return rounded(duration_at_k(_evaluated(spark, sf_dir), ROLES))


# All order lines, each with the place of its item by number of lines: a large
# evaluated table with several labels for the metrics alone.
_LINES_RANKED = f"""{ORDERS_SQL}, evaluated AS (
  SELECT user_id, item_id, is_interacted, duration, p_type AS item_type, p_size AS item_size, prediction_rank,
         price / 100000 AS prediction
  FROM lines JOIN part ON item_id = p_partkey JOIN (
    SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, md5(concat_ws('|', 'tie', item_id)), item_id) AS prediction_rank
    FROM lines GROUP BY 1) places USING (item_id))"""


def _ranked_lines(spark, sf_dir):
    """Order lines with the place and the features of their item; a task holds its items and streams their lines, unsorted."""
    lines = logs.order_lines(spark, sf_dir)
    counts = materialize(lines.groupBy("item_id").agg(F.count(F.lit(1)).alias("score")), "counts")
    places = catalog_positions(counts, "score", ROLES)
    places = places.select("item_id", F.col("position").alias("prediction_rank"))
    placed = places.join(logs.items(spark, sf_dir), "item_id").hint("shuffle_hash")
    return lines.withColumn("prediction", F.col("price") / 100000).join(placed, "item_id")


@query(
    f"WITH {_LINES_RANKED}, per_user AS ({_users_sql('evaluated', ('recall', 'precision', 'ndcg'))}) "
    f"SELECT {_means_sql(('recall', 'precision', 'ndcg'))} FROM per_user"
)
def rank_metrics_orders(spark, sf_dir):
    return rounded(evaluate(_ranked_lines(spark, sf_dir), ["recall_at_k", "precision_at_k", "ndcg_at_k"], ROLES))


@query(f"WITH {_LINES_RANKED} SELECT count(*) AS sample_count, round(sqrt(avg(pow(is_interacted - prediction, 2))), 6) AS rmse FROM evaluated")
def rmse_orders(spark, sf_dir):
    return rounded(evaluate(_ranked_lines(spark, sf_dir), ["rmse"], ROLES))


def _slices_sql(source: str, features: tuple[str, ...], names: tuple[str, ...], apart: str = "") -> str:
    key = f"{apart}, " if apart else ""
    parts = []
    for feature in features:
        named = f"SELECT *, '{feature}' AS feature, CAST({feature} AS VARCHAR) AS value FROM {source} WHERE {feature} IS NOT NULL"
        whole = f"SELECT *, '{feature}' AS feature, 'OVERALL' AS value FROM {source}"
        parts += [named, whole]
    return (
        f"long AS ({' UNION ALL '.join(parts)}), per_user AS ({_users_sql('long', names, f'{key}feature, value,')}) "
        f"SELECT {key}feature, value, {_means_sql(names)} FROM per_user GROUP BY {key}feature, value"
    )


_NAMES = ("recall", "precision", "ndcg")
_METRICS = ["recall_at_k", "precision_at_k", "ndcg_at_k"]


@query(f"WITH {EVALUATED_SQL}, {_slices_sql('evaluated', ('user_region', 'item_type', 'market_segment'), _NAMES)}")
def offline_evaluation(spark, sf_dir):
    """The evaluation day end to end: candidates, ranks, and every metric per slice."""
    evaluated = _evaluated(spark, sf_dir)
    return rounded(report(evaluated, ["user_region", "item_type", "market_segment"], _METRICS, INFER_DAY, ROLES).slices)


_REACH_SQL = EVALUATED_SQL.replace("count(*) AS score FROM hist", "count(DISTINCT user_id) AS score FROM hist")
_BY_REGION = _slices_sql("evaluated", ("user_region",), ("recall", "ndcg"))


@query(
    f"""SELECT 'popular' AS model, * FROM (WITH {EVALUATED_SQL}, {_BY_REGION})
    UNION ALL SELECT 'reach' AS model, * FROM (WITH {_REACH_SQL}, {_BY_REGION})"""
)
def compare_two_models(spark, sf_dir):
    """Two item scores, positives and distinct users, evaluated on the same rows."""
    data = day_data(flagged_log(spark, sf_dir))
    reach = data.history.groupBy("item_id").agg(F.count(F.lit(1)).alias("score"))
    models = {
        "popular": materialize(popularity_scores(data.history, ROLES), "scores"),
        "reach": materialize(reach, "scores"),
    }
    regions = logs.users(spark, sf_dir).select("user_id", "user_region")
    return rounded(compare_models(data, models, "score", {"user_id": regions}, ["recall_at_k", "ndcg_at_k"], ROLES))


@query(f"WITH {_LINES_RANKED}, {_slices_sql('evaluated', ('item_type', 'item_size'), _NAMES)}")
def slice_report_orders(spark, sf_dir):
    return rounded(slice_report(_ranked_lines(spark, sf_dir), ["item_type", "item_size"], _METRICS, ROLES))


@query(f"WITH {_LINES_RANKED}, {_slices_sql('evaluated', ('item_type',), ('recall', 'ndcg'), 'is_interacted')}")
def slice_report_by_label(spark, sf_dir):
    """The report once per value of a separating column."""
    ranked = _ranked_lines(spark, sf_dir)
    return rounded(slice_report(ranked, ["item_type"], ["recall_at_k", "ndcg_at_k"], ROLES, "is_interacted"))


# ---- model metrics --------------------------------------------------------


def _auc_sql(source: str, by: str = "") -> str:
    """Rank-sum form with average ranks on ties."""
    key = f"{by}, " if by else ""
    over = f"PARTITION BY {by}" if by else ""
    return f"""
    ties AS (SELECT {key}score, count(*) FILTER (target) AS pos, count(*) FILTER (NOT target) AS neg
             FROM {source} GROUP BY {key}score),
    below AS (SELECT *, coalesce(sum(neg) OVER ({over} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower
              FROM ties)
    SELECT {key}round(sum(pos * (lower + neg / 2)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) AS auc FROM below
    {f'GROUP BY {by}' if by else ''}"""


@query(f"WITH {ORDERS_SQL}, scored AS (SELECT price AS score, is_interacted > 1 AS target FROM lines), {_auc_sql('scored')}")
def auc_orders(spark, sf_dir):
    return rounded(auc(logs.order_lines(spark, sf_dir), "price", clicked(ROLES)))


_SHARE_SQL = """shares AS (SELECT item_id, avg(CASE WHEN is_interacted = 2 THEN 1.0 ELSE 0.0 END) AS share FROM log GROUP BY 1),
scored AS (SELECT filename_date, CAST(round(share, 3) AS DOUBLE) AS score, is_interacted > 1 AS target FROM log JOIN shares USING (item_id))"""


def _shared(spark, sf_dir):
    log = logs.interactions(spark, sf_dir)
    share = F.avg(F.when(F.col("is_interacted") == 2, 1.0).otherwise(0.0))
    shares = log.groupBy("item_id").agg(F.round(share, 3).alias("score"))
    return log.join(shares, "item_id")


@query(f"WITH {LOG_SQL}, {_SHARE_SQL}, {_auc_sql('scored', 'filename_date')}")
def auc_per_day(spark, sf_dir):
    """Tied scores, one area per day."""
    return rounded(auc(_shared(spark, sf_dir), "score", clicked(ROLES), ["filename_date"]))


@query(
    f"""WITH {LOG_SQL}, {_SHARE_SQL}, daily AS (SELECT * FROM ({"WITH " + _auc_sql('scored', 'filename_date')}))
    SELECT max(auc) AS best_score, min_by(filename_date, (-auc, filename_date)) AS best_run FROM daily"""
)
def best_auc_day(spark, sf_dir):
    daily = rounded(auc(_shared(spark, sf_dir), "score", clicked(ROLES), ["filename_date"]))
    return rounded(best_run(daily, "filename_date", "auc"))


_LOSSES = """round(sum(loss * w) / sum(w), 6) AS log_loss, round(avg(loss) * avg(w), 6) AS log_loss_times_mean_weight"""


@query(
    f"""WITH {ORDERS_SQL}, scored AS (SELECT (duration - 25) / 10 AS z, CASE WHEN is_interacted > 1 THEN 1 ELSE 0 END AS y, weighted_lr AS w FROM lines),
    losses AS (SELECT w, greatest(z, 0) - z * y + ln(1 + exp(-abs(z))) AS loss FROM scored) SELECT {_LOSSES} FROM losses"""
)
def log_loss_orders(spark, sf_dir):
    lines = logs.order_lines(spark, sf_dir).withColumn("logit", (F.col("duration") - 25) / 10)
    return rounded(log_loss(lines, "logit", clicked(ROLES), "weighted_lr"))


@query(
    f"""WITH {ORDERS_SQL}, scored AS (SELECT duration / 50 AS p, is_interacted > 1 AS y, weighted_lr AS w FROM lines),
    losses AS (SELECT w, -(CASE WHEN y THEN greatest(ln(p), -100) WHEN p < 1 THEN greatest(ln(1 - p), -100) ELSE -100 END) AS loss FROM scored)
    SELECT {_LOSSES} FROM losses"""
)
def log_loss_of_probability_orders(spark, sf_dir):
    lines = logs.order_lines(spark, sf_dir).withColumn("p", F.col("duration") / 50)
    return rounded(log_loss_of_probability(lines, "p", clicked(ROLES), "weighted_lr"))


@query(
    f"""WITH {OBS_SQL} SELECT popularity_item_group, is_interacted, count(*) AS n_sample, count(DISTINCT item_id) AS n_item,
    round(count(*) / count(DISTINCT item_id), 6) AS rate FROM obs GROUP BY 1, 2"""
)
def resampling_check(spark, sf_dir):
    return rounded(resample_check(logs.observations(spark, sf_dir), ROLES))
