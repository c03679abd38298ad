"""Pair set operations, feature joins, candidates and ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinary.catalog import logs
from affinary.catalog.logs import (
    EVAL_DAY,
    HISTORY_DAYS,
    INFER_DAY,
    ITEMS_SQL,
    LOG_SQL,
    OBS_SQL,
    ORDER_ROLES,
    ORDERS_SQL,
    ROLES,
    USERS_SQL,
    WEEKEND_SQL,
)
from affinary.catalog.registry import query, rounded
from affinary.functions.calendar import days_before
from affinary.operators.assembly import add_account_features, add_user_context, assemble
from affinary.operators.pairs import anti_join, drop_seen_pairs, resolve_labels
from affinary.operators.ranking import (
    attach_ranks,
    candidate_counts,
    catalog_positions,
    having_predictions,
    rank_pairs,
    rank_scored,
    top_items,
)
from affinary.operators.retrieval import cosine_top_k, vector_top_k
from affinary.plans.evaluation import catalog_items, content_set, evaluation_data, history_rows, popularity_scores
from affinary.roles import Roles
from affinary.sources.scratch import materialize

_START = days_before(EVAL_DAY, HISTORY_DAYS)
INFERRED = ["is_infering_user is True"]

# ---- pairs ----------------------------------------------------------------


@query(
    f"""WITH {LOG_SQL} SELECT event_id, user_id, item_id FROM log a WHERE is_interacted = 1 AND NOT EXISTS
    (SELECT 1 FROM log b WHERE b.is_interacted = 0 AND b.user_id = a.user_id AND b.item_id = a.item_id)"""
)
def anti_pairs(spark, sf_dir):
    log = logs.interactions(spark, sf_dir).select("event_id", "user_id", "item_id", "is_interacted")
    negatives = log.filter("is_interacted = 1").drop("is_interacted")
    return anti_join(negatives, log.filter("is_interacted = 0"), ["user_id", "item_id"])


@query(
    f"""WITH {LOG_SQL} SELECT event_id, user_id, item_id, is_interacted FROM log a
    WHERE filename_date = {EVAL_DAY} AND NOT EXISTS (SELECT 1 FROM log b WHERE b.filename_date < {EVAL_DAY}
      AND b.filename_date >= {_START} AND b.user_id = a.user_id AND b.item_id = a.item_id)"""
)
def drop_seen(spark, sf_dir):
    log = logs.interactions(spark, sf_dir).select("event_id", "user_id", "item_id", "is_interacted", "filename_date")
    trained = log.filter((F.col("filename_date") < EVAL_DAY) & (F.col("filename_date") >= _START))
    return drop_seen_pairs(log.filter(F.col("filename_date") == EVAL_DAY), trained, ROLES).drop("filename_date")


def _resolved_sql(log: str) -> str:
    """The three-step form: 2 beats 0 and 1, a surviving 0 beats 1, rows labelled 0 go."""
    return f"""
p2 AS (SELECT DISTINCT user_id, item_id FROM {log} WHERE is_interacted = 2),
zeros AS (SELECT * FROM {log} a WHERE is_interacted = 0
  AND NOT EXISTS (SELECT 1 FROM p2 WHERE p2.user_id = a.user_id AND p2.item_id = a.item_id)),
ones AS (SELECT * FROM {log} a WHERE is_interacted = 1
  AND NOT EXISTS (SELECT 1 FROM p2 WHERE p2.user_id = a.user_id AND p2.item_id = a.item_id)
  AND NOT EXISTS (SELECT 1 FROM zeros z WHERE z.user_id = a.user_id AND z.item_id = a.item_id)),
resolved AS (SELECT * FROM {log} WHERE is_interacted = 2 UNION ALL SELECT * FROM ones)"""


@query(f"WITH {LOG_SQL}, {_resolved_sql('log')} SELECT event_id, user_id, item_id, is_interacted FROM resolved")
def resolve_label_conflicts(spark, sf_dir):
    log = logs.interactions(spark, sf_dir).select("event_id", "user_id", "item_id", "is_interacted")
    return resolve_labels(log, ROLES)


@query(f"WITH {ORDERS_SQL}, {_resolved_sql('lines')} SELECT event_id, user_id, item_id, is_interacted FROM resolved")
def resolve_label_conflicts_orders(spark, sf_dir):
    lines = logs.order_lines(spark, sf_dir).select("event_id", "user_id", "item_id", "is_interacted")
    return resolve_labels(lines, ORDER_ROLES)


# ---- features -------------------------------------------------------------


@query(
    f"""WITH {LOG_SQL}, {USERS_SQL}, {ITEMS_SQL} SELECT user_id, item_id, market_segment, user_nation, user_region,
      is_infering_user, item_brand, item_type, item_size, {WEEKEND_SQL.format(date=EVAL_DAY)} AS is_weekend
    FROM (SELECT DISTINCT user_id, item_id FROM log) JOIN users USING (user_id) JOIN items USING (item_id)"""
)
def assemble_features(spark, sf_dir):
    pairs = logs.interactions(spark, sf_dir).select("user_id", "item_id").distinct()
    return assemble(pairs, logs.users(spark, sf_dir), logs.items(spark, sf_dir), ROLES, EVAL_DAY)


@query(
    f"""WITH {LOG_SQL}, {ITEMS_SQL}, context AS (
      SELECT user_id, filename_date, count(*) AS n_events, max(item_type) AS last_type
      FROM log JOIN items USING (item_id) GROUP BY 1, 2)
    SELECT l.event_id, l.user_id, n_events, last_type
    FROM log l JOIN context c ON l.user_id = c.user_id AND c.filename_date = {EVAL_DAY}"""
)
def user_context(spark, sf_dir):
    log = logs.interactions(spark, sf_dir)
    typed = log.join(logs.items(spark, sf_dir), "item_id")
    context = typed.groupBy("user_id", "filename_date").agg(
        F.count(F.lit(1)).alias("n_events"), F.max("item_type").alias("last_type")
    )
    roles = Roles(user_context_features=("n_events", "last_type"))
    joined = add_user_context(log.select("event_id", "user_id"), context, EVAL_DAY, roles)
    return joined.select("event_id", "user_id", "n_events", "last_type")


@query(
    """SELECT CASE WHEN c_acctbal < 0 THEN CAST(c_custkey AS VARCHAR) ELSE c_custkey || '#' || c_nationkey END AS id,
      c_mktsegment, n_name, r_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_acctbal >= 0"""
)
def profile_account(spark, sf_dir):
    """Customers as profiles of nation-wide accounts; those in debt have no account in their id."""
    alone, shared = F.col("c_custkey").cast("string"), F.concat_ws("#", "c_custkey", "c_nationkey")
    in_debt = F.col("c_acctbal") < 0
    profiles = logs.table(spark, sf_dir, "customer").select(
        F.when(in_debt, alone).otherwise(shared).alias("id"), "c_mktsegment"
    )
    nations = logs.table(spark, sf_dir, "nation").join(
        logs.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    accounts = nations.select(F.concat_ws("#", F.lit("account"), "n_nationkey").alias("id"), "n_name", "r_name")
    return add_account_features(profiles, accounts, "id")


# ---- candidates and ranks -------------------------------------------------

HISTORY_SQL = f"""
hist AS (
  SELECT user_id, item_id FROM log JOIN users USING (user_id)
  WHERE is_interacted = 2 AND is_infering_user AND filename_date < {EVAL_DAY} AND filename_date >= {_START}),
seen AS (SELECT DISTINCT user_id, item_id FROM hist),
scores AS (SELECT item_id, count(*) AS score FROM hist GROUP BY 1),
firsts AS (
  SELECT l.* FROM log l JOIN users USING (user_id)
  WHERE is_interacted = 2 AND is_infering_user AND filename_date = {EVAL_DAY}
  QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY event_id) = 1),
content AS (SELECT DISTINCT item_id FROM log WHERE is_interacted = 2 AND filename_date < {EVAL_DAY} AND filename_date >= {_START}),
eval_rows AS (
  SELECT f.* FROM firsts f WHERE item_id IN (SELECT item_id FROM content)
    AND NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = f.user_id AND s.item_id = f.item_id)),
candidates AS (
  SELECT u.user_id, i.item_id, i.score FROM (SELECT DISTINCT user_id FROM firsts) u CROSS JOIN scores i
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = u.user_id AND s.item_id = i.item_id)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, md5(concat_ws('|', 'tie', item_id)), item_id)
    AS prediction_rank FROM candidates)"""
RANKED_SQL = f"{LOG_SQL},{USERS_SQL},{HISTORY_SQL}"


def flagged_log(spark, sf_dir) -> DataFrame:
    people = logs.users(spark, sf_dir).select("user_id", "is_infering_user")
    return logs.interactions(spark, sf_dir).join(people, "user_id")


def day_data(log: DataFrame, columns=()):
    return evaluation_data(log, INFER_DAY, HISTORY_DAYS, columns, ROLES, INFERRED)


def popular_catalog(history: DataFrame) -> DataFrame:
    scores = materialize(popularity_scores(history, ROLES), "scores")
    return materialize(catalog_positions(scores, "score", ROLES), "catalog")


@query(f"WITH {RANKED_SQL} SELECT user_id, count(*) AS n_candidates FROM candidates GROUP BY 1")
def candidates_per_user(spark, sf_dir):
    data = day_data(flagged_log(spark, sf_dir))
    return candidate_counts(data.users, catalog_items(data.history, ROLES), data.history, ROLES)


@query(f"WITH {RANKED_SQL} SELECT user_id, item_id, score, prediction_rank FROM ranked WHERE prediction_rank <= 20")
def top_items_per_user(spark, sf_dir):
    data = day_data(flagged_log(spark, sf_dir))
    return top_items(data.users, popular_catalog(data.history), data.history, 20, ROLES)


@query(f"WITH {RANKED_SQL} SELECT user_id, item_id, prediction_rank FROM ranked SEMI JOIN firsts USING (user_id, item_id)")
def rank_of_pairs(spark, sf_dir):
    data = day_data(flagged_log(spark, sf_dir))
    wanted = data.rows.select("user_id", "item_id")
    return rank_pairs(wanted, popular_catalog(data.history), data.history, ROLES)


@query(
    f"""WITH {ORDERS_SQL}, scored AS (
      SELECT user_id, item_id, sum(duration) AS score FROM lines GROUP BY 1, 2)
    SELECT user_id, item_id, round(score, 6) AS score,
      row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS prediction_rank
    FROM scored QUALIFY prediction_rank <= 10"""
)
def rank_scored_orders(spark, sf_dir):
    lines = logs.order_lines(spark, sf_dir)
    scored = lines.groupBy("user_id", "item_id").agg(F.sum("duration").alias("score"))
    return rounded(rank_scored(scored, "score", 10, ORDER_ROLES))


@query(
    f"""WITH {RANKED_SQL} SELECT event_id, user_id, item_id FROM log
    WHERE user_id IN (SELECT user_id FROM candidates) AND item_id IN (SELECT item_id FROM content)"""
)
def rows_with_predictions(spark, sf_dir):
    data = day_data(flagged_log(spark, sf_dir))
    counts = candidate_counts(data.users, catalog_items(data.history, ROLES), data.history, ROLES)
    log = logs.interactions(spark, sf_dir)
    rows = having_predictions(log.select("event_id", "user_id", "item_id"), counts.filter("n_candidates > 0"), ["user_id"])
    content = content_set(history_rows(log, EVAL_DAY, HISTORY_DAYS, ROLES), ROLES)
    return having_predictions(rows, content, ["item_id"])


@query(f"WITH {RANKED_SQL} SELECT item_id, item_id AS content_id FROM content")
def content_items(spark, sf_dir):
    return content_set(history_rows(logs.interactions(spark, sf_dir), EVAL_DAY, HISTORY_DAYS, ROLES), ROLES)


@query(
    f"""WITH {RANKED_SQL} SELECT e.user_id, e.item_id, duration, coalesce(prediction_rank, 9999) AS prediction_rank
    FROM eval_rows e LEFT JOIN (SELECT * FROM ranked WHERE prediction_rank <= 20) r USING (user_id, item_id)"""
)
def join_evaluation_ranks(spark, sf_dir):
    data = day_data(flagged_log(spark, sf_dir))
    best = top_items(data.users, popular_catalog(data.history), data.history, 20, ROLES)
    return attach_ranks(data.rows, best, ROLES).select("user_id", "item_id", "duration", "prediction_rank")


_VECTORS_SQL = f"""{LOG_SQL}, last AS (SELECT max(vec_id) AS m FROM embeddings),
    u AS (SELECT user_id, CAST(embedding AS DOUBLE[]) AS a FROM (SELECT DISTINCT user_id FROM log) JOIN embeddings ON vec_id = user_id),
    i AS (SELECT item_id, CAST(embedding AS DOUBLE[]) AS b FROM (SELECT DISTINCT item_id FROM log), last
          JOIN embeddings ON vec_id = m - item_id),
    seen AS (SELECT DISTINCT user_id, item_id FROM log WHERE is_interacted = 2)"""


def _vectors(spark, sf_dir):
    """The log, and vectors of its users and items."""
    log = logs.interactions(spark, sf_dir)
    vectors = logs.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    last = vectors.agg(F.max("vec_id")).first()[0]
    user_vectors = log.select("user_id").distinct().join(vectors, F.col("user_id") == F.col("vec_id")).drop("vec_id")
    item_vectors = log.select("item_id").distinct().join(vectors, F.lit(last) - F.col("item_id") == F.col("vec_id"))
    return log, user_vectors, item_vectors.drop("vec_id")


@query(
    f"""WITH {_VECTORS_SQL},
    scored AS (
      SELECT user_id, item_id, round((list_dot_product(a, b) / sqrt(list_dot_product(a, a)) / sqrt(list_dot_product(b, b)) + 1) / 2, 12) AS exact
      FROM u CROSS JOIN i ANTI JOIN seen USING (user_id, item_id))
    SELECT user_id, item_id, round(exact, 6) AS score, row_number() OVER (PARTITION BY user_id ORDER BY exact DESC, item_id) AS prediction_rank
    FROM scored QUALIFY prediction_rank <= 10"""
)
def cosine_top_items(spark, sf_dir):
    log, user_vectors, item_vectors = _vectors(spark, sf_dir)
    seen = log.filter("is_interacted = 2").select("user_id", "item_id").distinct()
    return rounded(cosine_top_k(user_vectors, item_vectors, 10, seen, roles=ROLES))


@query(
    f"""WITH {_VECTORS_SQL}, liked AS (SELECT item_id, count(*) AS n FROM log WHERE is_interacted = 2 GROUP BY item_id),
    scored AS (
      SELECT user_id, item_id, round(list_dot_product(a, b) * ln(1 + coalesce(n, 0)), 9) AS exact
      FROM u CROSS JOIN (SELECT * FROM i LEFT JOIN liked USING (item_id)) ANTI JOIN seen USING (user_id, item_id))
    SELECT user_id, item_id, round(exact, 6) AS score, row_number() OVER (PARTITION BY user_id ORDER BY exact DESC, item_id) AS prediction_rank
    FROM scored QUALIFY prediction_rank <= 10"""
)
def popular_vector_top_items(spark, sf_dir):
    """Top items by dot product, where an item's vector is as long as the logarithm of its positives."""
    log, user_vectors, item_vectors = _vectors(spark, sf_dir)
    positive = log.filter("is_interacted = 2")
    counts = positive.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n"))
    weight = F.log(1 + F.coalesce("_n", F.lit(0)).cast("double"))
    weighted = item_vectors.join(counts, "item_id", "left").select(
        "item_id", F.transform("vector", lambda x: x.cast("double") * weight).alias("vector")
    )
    return rounded(vector_top_k(user_vectors, weighted, 10, positive, roles=ROLES, digits=9, items_per_cell=32))
