"""Models, training sets and staged tables."""

import random
from dataclasses import replace

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from affinary.operators.factorization import fit_factor_model
from affinary.operators.learning import (
    _hasher,
    clicked,
    daily_refit,
    feature_importance,
    fit_click_model,
    search_parameters,
    search_space,
)
from affinary.operators.metrics import auc
from affinary.operators.ranking import catalog_positions, rank_pairs, rank_scored
from affinary.operators.retrieval import vector_top_k
from affinary.plans.evaluation import report
from affinary.plans.jobs import read_stored, store_report
from affinary.plans.training import training_set
from affinary.roles import JobSpec, Resampling, Roles
from affinary.sources import scratch

ROLES = Roles()
FEATURES = ["taste", "kind"]


@pytest.fixture(scope="module")
def clicks(spark):
    """Users like the kind that matches their taste; kind c is liked by all."""
    rng = random.Random(1)
    data = []
    for n in range(3000):
        u, i = rng.randint(0, 29), rng.randint(0, 44)
        taste, kind = "ab"[u % 2], "abc"[i % 3]
        chance = 0.9 if kind == "c" else 0.7 if kind == taste else 0.1
        data.append((u, i, taste, kind, 2 if rng.random() < chance else 1, 1.0))
    columns = "user_id int, item_id int, taste string, kind string, is_interacted int, weighted_lr double"
    return spark.createDataFrame(data, columns)


def test_click_model_ranks_by_item_parts(spark, clicks):
    model = fit_click_model(clicks, FEATURES, ROLES, 64)
    goods = clicks.select("item_id", "kind").distinct()
    people = clicks.select("user_id", "taste").distinct()
    seen = clicks.filter("is_interacted = 2").select("user_id", "item_id").distinct()
    catalog = catalog_positions(model.part(goods, ["kind"], "score").select("item_id", "score"), "score")
    pairs = people.crossJoin(goods).join(seen, ["user_id", "item_id"], "left_anti")
    ranked = rank_pairs(pairs, catalog, seen)
    scored = model.score(pairs).join(ranked, ["user_id", "item_id"])
    # a better rank never has a lower probability
    rows = sorted(scored.select("user_id", "prediction_rank", "prediction").collect())
    for before, after in zip(rows, rows[1:]):
        if before.user_id == after.user_id:
            assert after.prediction_rank == before.prediction_rank + 1
            assert after.prediction <= before.prediction + 1e-9
    assert len(rows) == pairs.count()


def test_click_model_drops_rows_with_missing_features(spark, clicks):
    model = fit_click_model(clicks, FEATURES, ROLES, 64)
    holed = clicks.limit(10).withColumn("kind", F.lit(None).cast("string")).unionByName(clicks.limit(5))
    assert model.score(holed).count() == 5


def test_importance_is_the_mean_absolute_part(spark, clicks):
    model = fit_click_model(clicks, FEATURES, ROLES, 64)
    found = {r.feature: r.importance for r in feature_importance(model, clicks).collect()}
    parts = model.part(clicks, ["kind"], "part").select("part").toPandas()["part"]
    assert found["kind"] == pytest.approx((parts - parts.mean()).abs().mean())
    assert found["kind"] > found["taste"]


def test_factor_model_vectors_order_items_like_its_scores(spark, clicks):
    model = fit_factor_model(clicks, ["taste"], ["kind", "item_id"], ROLES, size=128, factors=4, max_iter=30)
    goods = clicks.select("item_id", "kind").distinct()
    people = clicks.select("user_id", "taste").distinct()
    best = vector_top_k(
        model.user_vectors(people), model.item_vectors(goods), 10, digits=9, users_per_cell=8, items_per_cell=16
    )
    scored = model.score(people.crossJoin(goods)).withColumn("s", F.col("logit"))
    wanted = {(r.user_id, r.prediction_rank): r.s for r in rank_scored(scored, "s", 10).collect()}
    logits = {(r.user_id, r.item_id): r.s for r in scored.collect()}
    found = best.collect()
    assert len(found) == len(wanted) == 300
    for row in found:
        assert logits[row.user_id, row.item_id] == pytest.approx(wanted[row.user_id, row.prediction_rank], abs=1e-6)


def test_refit_starts_from_the_full_model(spark, clicks):
    full, refit = daily_refit(clicks, clicks.limit(500), FEATURES, ROLES, layers=(8, 2), max_iter=5)
    assert full.layers == refit.layers
    again, _ = daily_refit(clicks, clicks.limit(500), FEATURES, ROLES, full_model=full, layers=(8, 2), max_iter=5)
    assert again is full
    assert 0 <= refit.score(clicks.limit(1)).first().prediction <= 1


def test_search(spark, clicks):
    trials = search_space({"regParam": [0.0, 5.0], "maxIter": [5]})
    assert len(trials) == 2 and len(search_space({"a": range(9)}, samples=3)) == 3
    assert search_space({"a": range(9)}, samples=3) == search_space({"a": range(9)}, samples=3)
    trials = [{"regParam": t["regParam"]} for t in trials]
    results = search_parameters(clicks, clicks, FEATURES, trials, ROLES, 64).collect()
    assert [r.trial for r in results] in ([0, 1], [1, 0]) and results[0].auc >= results[1].auc


def test_search_fits_a_row_per_combination(spark, clicks):
    """All trials share one staged row per combination and one sort, and find what fits on the rows find, to the optimizer's tolerance."""
    odd = clicks.withColumn("weighted_lr", 0.5 + F.col("item_id") % 4).withColumn(
        "kind", F.when(F.col("user_id") != 7, F.col("kind"))
    )
    train, held_out = odd.filter("item_id % 5 < 4"), odd.filter("item_id % 5 = 4")
    trials = [{}, {"regParam": 0.05, "elasticNetParam": 0.5}, {"regParam": 0.3}, {"regParam": 0.3, "standardization": False}]
    sizes = {}

    def stage(table, name):
        kept = scratch.materialize(table, name)
        sizes.setdefault(name, []).append(kept.count())
        return kept

    found = {r.trial: r.auc for r in search_parameters(train, held_out, FEATURES, trials, ROLES, 64, stage).collect()}
    assert max(sizes["merged"] + sizes["asked"]) <= 2 * 3 * 2 and len(sizes["sorted"]) == 1
    whole = train.dropna("any", subset=FEATURES)
    rows = _hasher(FEATURES, 64).transform(whole).withColumn("_y", clicked(ROLES).cast("double"))
    for number, params in enumerate(trials):
        plain = LogisticRegression(featuresCol="_x", labelCol="_y", weightCol="weighted_lr", maxIter=20, **params).fit(rows)
        model = fit_click_model(train, FEATURES, ROLES, 64, **params)
        assert model.model.coefficients.toArray() == pytest.approx(plain.coefficients.toArray(), abs=1e-5)
        assert model.model.intercept == pytest.approx(plain.intercept, abs=1e-5)
        assert found[number] == pytest.approx(auc(model.score(held_out), "prediction", clicked(ROLES)).first()["auc"])


def test_search_without_validation_rows_or_trials(spark, clicks):
    assert [r.auc for r in search_parameters(clicks, clicks.limit(0), FEATURES, [{}], ROLES, 64).collect()] == [None]
    assert search_parameters(clicks, clicks, FEATURES, [], ROLES, 64).count() == 0


def test_auc_of_rows_with_copies(spark):
    data = [(0.1, 1, 3), (0.1, 2, 1), (0.4, 1, 2), (0.6, 2, 4), (0.6, 1, 1), (0.9, None, 5)]
    df = spark.createDataFrame(data, "s double, is_interacted int, n int")
    spread = df.select("s", "is_interacted", F.explode(F.sequence(F.lit(1), "n")))
    assert auc(df, "s", clicked(ROLES), copies="n").collect() == auc(spread, "s", clicked(ROLES)).collect()


def _log(spark):
    rng = random.Random(6)
    data = [
        (rng.randint(1, 20), rng.randint(1, 15), 20240101 + rng.randint(0, 2), rng.choice([0, 1, 1, 2]), rng.randint(1, 4), rng.choice(["x", None, "y"]))
        for _ in range(2000)
    ]
    columns = "user_id int, item_id int, filename_date int, is_interacted int, popularity_item_group int, kind string"
    return spark.createDataFrame(data, columns).withColumns({"weighted_lr": F.lit(1.0), "duration": F.lit(2.0)})


def test_training_set_without_row_ids(spark):
    """Copies are told apart, and the set is the same in every run."""
    log = _log(spark)
    log = log.unionByName(log.limit(50))
    plan = Resampling(popular={1: 0.2}, tail={2: 0.5, 3: 0.5})
    spec = JobSpec("t", replace(ROLES, item_features=("kind",)), plan, batch_size=40)
    first = training_set(log, ["filename_date <= 20240102"], ["kind"], spec).collect()
    again = training_set(log.repartition(5), ["filename_date <= 20240102"], ["kind"], spec).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    assert first and all(value is not None for row in first for value in row)
    assert {row.is_interacted for row in first} == {1, 2}


def test_training_set_without_resampling_keeps_every_settled_row(spark):
    log = _log(spark).fillna("z", ["kind"])
    plan = Resampling(popular={1: 0.5}, tail={2: 1.0, 3: 1.0})
    spec = JobSpec("t", replace(ROLES, row_id="event_id"), plan, batch_size=40)
    log = log.withColumn("event_id", F.monotonically_increasing_id()).cache()
    labels = log.groupBy("user_id", "item_id").agg(F.collect_set("is_interacted").alias("labels"))
    kept = log.join(labels, ["user_id", "item_id"]).filter(
        "is_interacted = 2 or (is_interacted = 1 and not array_contains(labels, 2) and not array_contains(labels, 0))"
    )
    assert training_set(log, [], ["kind"], spec).count() == kept.count()


class _Session:
    """Just what the choice of a folder looks at."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})


def test_staged_tables_need_a_shared_folder_on_a_cluster():
    assert scratch.shared_folder(_Session("spark://host:1", "hdfs://shared/stage/")) == "hdfs://shared/stage"
    with pytest.raises(RuntimeError):
        scratch.shared_folder(_Session("spark://host:1"))


def test_staged_table_reads_back_the_same(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    stored = scratch.materialize(df, "pairs")
    assert stored.schema == df.schema and set(stored.collect()) == set(df.collect())


def test_evaluation_without_slices_stores_the_overall_row(spark):
    ranked = spark.createDataFrame([(1, 1, 2, 1, 5.0), (1, 2, 2, 9999, 7.0), (2, 1, 2, 3, 1.0)], "user_id int, item_id int, is_interacted int, prediction_rank int, duration double")
    spec = JobSpec("plain", ROLES, metrics=("recall_at_k",))
    found = report(ranked, spec.slice_by, spec.metrics, 20240131, ROLES)
    folder = scratch.new_path(spark, "report")
    paths = store_report(found, spec, folder, "2024-01-31", "val")
    assert read_stored(spark, paths.slices).count() == 0
    whole = read_stored(spark, paths.overall).collect()
    assert [(row["recall@1"], row["recall@5"], row.model_name) for row in whole] == [(0.25, 0.75, "plain")]
    assert read_stored(spark, paths.duration).first()["duration_all"] == 6.5
