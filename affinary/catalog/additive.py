"""What a click model is used for, with a model whose closed form SQL can repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinary.catalog import logs
from affinary.catalog.logs import EVAL_DAY, FEATURES, HISTORY_DAYS, INFER_DAY, OBS_SQL, ROLES, SPEC
from affinary.catalog.registry import query, rounded
from affinary.catalog.training import _FULL_SQL, stored_observations
from affinary.functions.calendar import days_before, full_training_split
from affinary.operators.additive import cross_name, fit_additive_model, search_smoothing
from affinary.operators.ranking import catalog_positions
from affinary.operators.refit import CountStore, refit
from affinary.plans.training import training_set, window_rows
from affinary.sources.scratch import materialize, new_path

_ITEM_PARTS = ["item_brand", "item_type"]
_SMOOTHINGS = (0.1, 1.0, 10.0, 100.0)

# ---- the SQL of the model -------------------------------------------------


def _flat_sql(source: str, *others: str) -> str:
    columns = "".join(f"{name}, " for name in others)
    arms = [f"SELECT {columns}'{name}' AS feature, CAST({name} AS VARCHAR) AS value FROM {source}" for name in FEATURES]
    return " UNION ALL ".join(arms)


_LEARNED_SQL = """learned AS (SELECT *, CASE WHEN is_interacted > 1 THEN weighted_lr ELSE 0 END AS pos,
      CASE WHEN is_interacted > 1 THEN 0 ELSE weighted_lr END AS neg FROM numbered)"""


def _parts_sql(smoothing: str = "1.0") -> str:
    odds = f"ln((sum(pos) + {smoothing}) / (sum(neg) + {smoothing}))"
    return f"""base AS (SELECT {odds} AS b FROM learned),
    parts AS (SELECT feature, value, {odds} - any_value(b) AS part
      FROM ({_flat_sql('learned', 'pos', 'neg')}) AS f, base GROUP BY feature, value)"""


def _model_sql(smoothing: str = "1.0") -> str:
    return f"{_LEARNED_SQL}, {_parts_sql(smoothing)}, held AS (SELECT * FROM obs WHERE filename_date = {EVAL_DAY})"


def _sum_sql(names) -> tuple[str, str]:
    total = " + ".join(f"coalesce(p{i}.part, 0)" for i, _ in enumerate(names))
    joins = " ".join(f"LEFT JOIN parts p{i} ON p{i}.feature = '{n}' AND p{i}.value = CAST(t.{n} AS VARCHAR)" for i, n in enumerate(names))
    return total, joins


_TOTAL, _JOINS = _sum_sql(FEATURES)
_SCORED_SQL = f"scored AS (SELECT t.*, b + {_TOTAL} AS logit FROM held t {_JOINS}, base)"
_AUC_SQL = """SELECT round(sum(CASE WHEN is_interacted > 1 THEN below + ties / 2 ELSE 0 END) /
      (sum(CASE WHEN is_interacted > 1 THEN 1 ELSE 0 END) * sum(CASE WHEN is_interacted > 1 THEN 0 ELSE 1 END)), 6)
    FROM (SELECT is_interacted,
      coalesce(sum(CASE WHEN is_interacted > 1 THEN 0 ELSE 1 END) OVER (ORDER BY s RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
        - sum(CASE WHEN is_interacted > 1 THEN 0 ELSE 1 END) OVER (PARTITION BY s) AS below,
      CAST(sum(CASE WHEN is_interacted > 1 THEN 0 ELSE 1 END) OVER (PARTITION BY s) AS DOUBLE) AS ties
      FROM (SELECT is_interacted, round(logit, 9) AS s FROM scored))"""

# ---- queries --------------------------------------------------------------


def _sets(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    obs = stored_observations(spark, sf_dir)
    split = full_training_split(INFER_DAY, HISTORY_DAYS)
    train = materialize(training_set(obs, split.train, FEATURES, SPEC), "train")
    return train, materialize(window_rows(obs, split.validation, SPEC), "held-out")


@query(
    f"""{_FULL_SQL}, {_model_sql()}, {_SCORED_SQL}
    SELECT event_id, round(logit, 6) AS logit, round(1 / (1 + exp(-logit)), 6) AS prediction FROM scored"""
)
def additive_scores(spark, sf_dir):
    """Click probability of every row of the held-out day."""
    train, held_out = _sets(spark, sf_dir)
    scored = fit_additive_model(train, FEATURES, ROLES).score(held_out)
    return rounded(scored.select("event_id", "logit", "prediction"))


def _searched_sql() -> str:
    rows = []
    for number, smoothing in enumerate(_SMOOTHINGS):
        rows.append(
            f"""SELECT {number} AS trial, CAST({smoothing} AS DOUBLE) AS smoothing, (WITH {_model_sql(str(smoothing))}, {_SCORED_SQL} {_AUC_SQL}) AS auc"""
        )
    return f"{_FULL_SQL} " + " UNION ALL ".join(rows)


@query(_searched_sql())
def additive_parameter_search(spark, sf_dir):
    """Area under the curve of the held-out day for every smoothing of a grid."""
    train, held_out = _sets(spark, sf_dir)
    return rounded(search_smoothing(train, held_out, FEATURES, _SMOOTHINGS, ROLES))


@query(
    f"""{_FULL_SQL}, {_model_sql()}, counted AS (
      SELECT feature, value, count(*) AS n FROM ({_flat_sql('held')}) GROUP BY feature, value),
    known AS (SELECT feature, n, coalesce(part, 0) AS part FROM counted LEFT JOIN parts USING (feature, value)),
    means AS (SELECT feature, sum(part * n) / sum(n) AS mean FROM known GROUP BY feature)
    SELECT feature, round(sum(abs(part - mean) * n) / sum(n), 6) AS importance FROM known JOIN means USING (feature) GROUP BY feature"""
)
def additive_feature_importances(spark, sf_dir):
    """Mean absolute Shapley value of every feature over the held-out day."""
    train, held_out = _sets(spark, sf_dir)
    return rounded(fit_additive_model(train, FEATURES, ROLES).importance(held_out))


_ITEM_TOTAL, _ITEM_JOINS = _sum_sql(_ITEM_PARTS)


@query(
    f"""{_FULL_SQL}, {_model_sql()}, goods AS (SELECT DISTINCT item_id, item_brand, item_type FROM obs),
    rated AS (SELECT item_id, round({_ITEM_TOTAL}, 9) AS score FROM goods t {_ITEM_JOINS})
    SELECT item_id, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, md5(concat_ws('|', 'tie', item_id)), item_id) AS position
    FROM rated"""
)
def additive_item_ranks(spark, sf_dir):
    """The catalog in the order of the model's item parts, which is the order for every user."""
    train, _ = _sets(spark, sf_dir)
    goods = logs.observations(spark, sf_dir).select("item_id", *_ITEM_PARTS).distinct()
    rated = fit_additive_model(train, FEATURES, ROLES).part(goods, _ITEM_PARTS, "score")
    rated = materialize(rated.select("item_id", F.round("score", 9).alias("score")), "item-scores")
    return rounded(catalog_positions(rated, "score", ROLES))


# ---- pairwise interactions --------------------------------------------------

_CROSSES = (("market_segment", "item_type"), ("user_region", "item_brand"))
_CROSS_SMOOTHING = 10.0


def _crosses_sql() -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{cross_name((a, b))}' AS feature, '{a}' AS first, '{b}' AS second, {a} AS value, {b} AS other, sum(pos) AS pos, sum(neg) AS neg FROM learned GROUP BY {a}, {b}"
        for a, b in _CROSSES
    )
    s = _CROSS_SMOOTHING
    return f"""cross_counts AS ({counts}),
    expected AS (SELECT c.*, b + x.part + y.part AS e FROM cross_counts c, base
      JOIN parts x ON x.feature = first AND x.value = c.value JOIN parts y ON y.feature = second AND y.value = c.other),
    crosses AS (SELECT feature, value, other, ln((pos + {s} / (1 + exp(-e))) / (neg + {s} * (1 - 1 / (1 + exp(-e))))) - e AS part FROM expected)"""


def _cross_sum_sql() -> tuple[str, str]:
    total = " + ".join(f"coalesce(x{i}.part, 0)" for i, _ in enumerate(_CROSSES))
    joins = " ".join(
        f"LEFT JOIN crosses x{i} ON x{i}.feature = '{cross_name((a, b))}' AND x{i}.value = t.{a} AND x{i}.other = t.{b}"
        for i, (a, b) in enumerate(_CROSSES)
    )
    return total, joins


_CROSS_TOTAL, _CROSS_JOINS = _cross_sum_sql()


def _interaction_model(spark, sf_dir):
    train, held_out = _sets(spark, sf_dir)
    return fit_additive_model(train, FEATURES, ROLES, crosses=_CROSSES, cross_smoothing=_CROSS_SMOOTHING), held_out


@query(
    f"""{_FULL_SQL}, {_model_sql()}, {_crosses_sql()},
    scored AS (SELECT t.event_id, b + {_TOTAL} + {_CROSS_TOTAL} AS logit FROM held t {_JOINS} {_CROSS_JOINS}, base)
    SELECT event_id, round(logit, 6) AS logit, round(1 / (1 + exp(-logit)), 6) AS prediction FROM scored"""
)
def interaction_scores(spark, sf_dir):
    """Click probability of every row of the held-out day by a weighted model with pairwise interactions."""
    model, held_out = _interaction_model(spark, sf_dir)
    return rounded(model.score(held_out).select("event_id", "logit", "prediction"))


def _interaction_importance_sql() -> str:
    """Shapley values row by row, from the means over the other feature's values."""
    columns, joins = [], []
    for i, name in enumerate(FEATURES):
        columns.append(f"coalesce(p{i}.part, 0) AS g{i}")
    for i, (a, b) in enumerate(_CROSSES):
        name = cross_name((a, b))
        columns.append(f"coalesce(x{i}.part, 0) AS h{i}")
        for side, (own, other, key, rest) in enumerate(((a, b, "value", "other"), (b, a, "other", "value"))):
            columns.append(f"coalesce(m{i}{side}.m, 0) AS m{i}{side}")
            joins.append(
                f"""LEFT JOIN (SELECT c.{key} AS k, sum(c.part * n) / (SELECT count(*) FROM held) AS m FROM crosses c
                  JOIN (SELECT {other} AS o, count(*) AS n FROM held GROUP BY 1) ON o = c.{rest}
                  WHERE feature = '{name}' GROUP BY 1) m{i}{side} ON m{i}{side}.k = t.{own}"""
            )
    shares = []
    for i, name in enumerate(FEATURES):
        share = f"g{i} - avg(g{i}) OVER ()"
        for j, cross in enumerate(_CROSSES):
            if name in cross:
                side = cross.index(name)
                share += f" + (m{j}{side} - avg(h{j}) OVER () + h{j} - m{j}{1 - side}) / 2"
        shares.append(f"{share} AS s{i}")
    arms = " UNION ALL ".join(f"SELECT '{name}' AS feature, round(avg(abs(s{i})), 6) AS importance FROM shapley" for i, name in enumerate(FEATURES))
    return f"""{_FULL_SQL}, {_model_sql()}, {_crosses_sql()},
    terms AS (SELECT {", ".join(columns)} FROM held t {_JOINS} {_CROSS_JOINS} {" ".join(joins)}),
    shapley AS (SELECT {", ".join(shares)} FROM terms) {arms}"""


@query(_interaction_importance_sql())
def interaction_importances(spark, sf_dir):
    """Mean absolute Shapley value of every feature of the model with interactions."""
    model, held_out = _interaction_model(spark, sf_dir)
    return rounded(model.importance(held_out))


# ---- daily refit --------------------------------------------------------------

_DECAY = 0.9
_REFIT_START = days_before(EVAL_DAY, HISTORY_DAYS)


@query(
    f"""WITH {OBS_SQL}, learned AS (
      SELECT * EXCLUDE (weight), CASE WHEN is_interacted > 1 THEN weight ELSE 0 END AS pos, CASE WHEN is_interacted > 1 THEN 0 ELSE weight END AS neg
      FROM (SELECT *, weighted_lr * power({_DECAY}, date_diff('day', strptime(CAST(filename_date AS VARCHAR), '%Y%m%d'), DATE '2024-01-30')) AS weight
        FROM obs WHERE is_interacted > 0 AND filename_date > {_REFIT_START} AND filename_date <= {EVAL_DAY})),
    {_parts_sql()}, held AS (SELECT * FROM obs WHERE is_interacted > 0 AND filename_date = {EVAL_DAY}), {_crosses_sql()},
    scored AS (SELECT t.event_id, b + {_TOTAL} + {_CROSS_TOTAL} AS logit FROM held t {_JOINS} {_CROSS_JOINS}, base)
    SELECT event_id, round(logit, 6) AS logit FROM scored"""
)
def additive_refit(spark, sf_dir):
    """Click logits of the newest day by a model whose older days come from stored sums: first all days up to the day
    before, then the newest day is added."""
    log = stored_observations(spark, sf_dir).filter("is_interacted > 0")
    store = CountStore(new_path(spark, "click-counts"), tuple(FEATURES), _CROSSES, ROLES)
    refit(log, store, days_before(EVAL_DAY, 1), HISTORY_DAYS, _DECAY)
    model = refit(log, store, EVAL_DAY, HISTORY_DAYS, _DECAY)
    return rounded(model.score(log.filter(F.col("filename_date") == EVAL_DAY)).select("event_id", "logit"))
