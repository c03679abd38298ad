"""The closed-form click model: weights, interactions, importances, refits from stored sums."""

import random
from itertools import combinations
from math import exp, factorial, log

import pytest
from pyspark.sql import functions as F

from affinary.operators.additive import ALL_ROWS, click_counts, fit_additive_model, search_smoothing
from affinary.operators.learning import clicked
from affinary.operators.metrics import auc
from affinary.operators.refit import CountStore, refit, window_days
from affinary.roles import Roles
from affinary.sources.scratch import new_path

FEATURES = ["taste", "kind", "time"]
CROSSES = (("taste", "kind"), ("kind", "time"))


def rows_of(seed, n=400, days=1):
    rng = random.Random(seed)
    made = []
    for _ in range(n):
        taste, kind, time = rng.choice("abc"), rng.choice("xyz"), rng.choice(["am", "pm"])
        chance = 0.85 if (taste, kind) in {("a", "x"), ("b", "y")} else 0.2
        made.append((taste, kind, time, 2 if rng.random() < chance else 1, rng.choice([0.5, 1.0, 2.5]), 20240228 + rng.randrange(days)))
    return made


def table(spark, rows):
    return spark.createDataFrame(rows, "taste string, kind string, time string, is_interacted int, weighted_lr double, filename_date int")


def by_hand(rows, smoothing=1.0, cross_smoothing=10.0, crosses=CROSSES):
    """base, part per (feature, value), part per (cross, values)"""

    def odds(picked):
        pos = sum(row[4] for row in picked if row[3] > 1)
        neg = sum(row[4] for row in picked if row[3] <= 1)
        return pos, neg

    pos, neg = odds(rows)
    base = log((pos + smoothing) / (neg + smoothing))
    parts, pairs = {}, {}
    for place, name in enumerate(FEATURES):
        for value in {row[place] for row in rows}:
            pos, neg = odds([row for row in rows if row[place] == value])
            parts[name, value] = log((pos + smoothing) / (neg + smoothing)) - base
    for a, b in crosses:
        i, j = FEATURES.index(a), FEATURES.index(b)
        for one, two in {(row[i], row[j]) for row in rows}:
            pos, neg = odds([row for row in rows if (row[i], row[j]) == (one, two)])
            expected = base + parts[a, one] + parts[b, two]
            p = 1 / (1 + exp(-expected))
            pairs[a, b, one, two] = log((pos + cross_smoothing * p) / (neg + cross_smoothing * (1 - p))) - expected
    return base, parts, pairs


def logit_by_hand(model, values, crosses=CROSSES):
    base, parts, pairs = model
    known = dict(zip(FEATURES, values))
    total = base + sum(parts.get(item, 0.0) for item in known.items())
    return total + sum(pairs.get((a, b, known[a], known[b]), 0.0) for a, b in crosses)


def test_interactions_fall_back_to_their_features(spark):
    rows = rows_of(1)
    rows = [row for row in rows if row[:2] != ("c", "z")]
    model = fit_additive_model(table(spark, rows), FEATURES, crosses=CROSSES)
    wanted = [("a", "x", "am"), ("c", "z", "pm"), ("new", "x", "am"), ("new", "new", "new")]
    asked = spark.createDataFrame(wanted, "taste string, kind string, time string")
    found = {tuple(row)[:3]: row.logit for row in model.score(asked).collect()}
    hand = by_hand(rows)
    for values in wanted:
        assert found[values] == pytest.approx(logit_by_hand(hand, values), abs=1e-9)
    assert ("taste", "kind", "c", "z") not in hand[2]


def test_weights_change_the_fit_and_count_as_rows(spark):
    rows = rows_of(2, 120)
    doubled = [(*row[:4], 2.0 if row[1] == "x" else 1.0, row[5]) for row in rows]
    repeated = [(*row[:4], 1.0, row[5]) for row in rows for _ in range(2 if row[1] == "x" else 1)]
    plain = [(*row[:4], 1.0, row[5]) for row in rows]

    def parts(given):
        model = fit_additive_model(table(spark, given), FEATURES, crosses=CROSSES)
        found = {tuple(row)[:3]: row.part for row in model.cross_parts.collect()}
        return found | {tuple(row)[:2]: row.part for row in model.parts.collect()}

    assert parts(doubled) == pytest.approx(parts(repeated))
    assert parts(doubled) != pytest.approx(parts(plain), abs=1e-3)


def test_interactions_predict_what_single_features_cannot(spark):
    train, held_out = table(spark, rows_of(3, 3000)), table(spark, rows_of(4, 1500))
    areas = []
    for crosses in ((), CROSSES):
        scored = fit_additive_model(train, FEATURES, crosses=crosses).score(held_out)
        areas.append(auc(scored, "logit", clicked()).first().auc)
    assert areas[1] > areas[0] + 0.05


def test_importance_equals_shapley_values_over_subsets(spark):
    rows = rows_of(5, 60)
    background = rows_of(6, 40) + [("new", "x", "am", 1, 1.0, 20240228)]
    model = fit_additive_model(table(spark, rows), FEATURES, crosses=CROSSES)
    found = {row.feature: row.importance for row in model.importance(table(spark, background)).collect()}
    hand = by_hand(rows)
    points = [row[:3] for row in background]

    def value(point, subset):
        mixed = [tuple(point[i] if i in subset else other[i] for i in range(3)) for other in points]
        return sum(logit_by_hand(hand, one) for one in mixed) / len(mixed)

    for i, name in enumerate(FEATURES):
        others = [j for j in range(3) if j != i]
        total = 0.0
        for point in points:
            share = 0.0
            for size in range(3):
                for subset in combinations(others, size):
                    weight = factorial(size) * factorial(2 - size) / factorial(3)
                    share += weight * (value(point, {*subset, i}) - value(point, set(subset)))
            total += abs(share)
        assert found[name] == pytest.approx(total / len(points), abs=1e-9)


def test_odd_rows_and_clashing_names(spark):
    rows = rows_of(7, 50)
    holed = [(None, *rows[0][1:]), (*rows[0][:3], None, 1.0, 20240228), (*rows[0][:4], None, 20240228)]
    clean = fit_additive_model(table(spark, rows), FEATURES, crosses=CROSSES)
    given = fit_additive_model(table(spark, rows + holed), FEATURES, crosses=CROSSES)
    assert sorted(clean.cross_parts.collect()) == sorted(given.cross_parts.collect())
    asked = table(spark, rows).withColumns({"_part0": F.lit("mine"), "_p1": F.lit("too"), "_key0": F.lit(1), "_price": F.lit(2)})
    scored = given.score(asked)
    assert scored.columns == [*asked.columns, "logit", "prediction"]
    assert scored.filter("_part0 = 'mine' and _p1 = 'too' and _price = 2").count() == 50
    nothing = fit_additive_model(table(spark, []), FEATURES, crosses=CROSSES)
    assert nothing.base == 0 and {row.logit for row in nothing.score(table(spark, rows)).collect()} == {0.0}
    assert nothing.importance(table(spark, [])).count() == 3
    with pytest.raises(ValueError):
        click_counts(table(spark, rows), ["taste"], crosses=[("taste", "kind")])


def test_search_has_as_many_jobs_for_many_trials(spark):
    train, held_out = table(spark, rows_of(8)), table(spark, rows_of(9, 200))
    tracker = spark.sparkContext.statusTracker()
    jobs, results = [], []
    for number, trials in enumerate(([1.0], [0.1, 1.0, 10.0, 100.0, 1000.0])):
        spark.sparkContext.setJobGroup(f"search-{number}", "")
        results.append({row.smoothing: row.auc for row in search_smoothing(train, held_out, FEATURES, trials).collect()})
        jobs.append(len(tracker.getJobIdsForGroup(f"search-{number}")))
    spark.sparkContext.setJobGroup("", "")
    assert jobs[1] <= jobs[0] + 1 and results[0][1.0] == results[1][1.0] and len(results[1]) == 5
    for smoothing, area in results[1].items():
        scored = fit_additive_model(train, FEATURES, smoothing=smoothing).score(held_out).withColumn("logit", F.round("logit", 9))
        assert area == pytest.approx(auc(scored, "logit", clicked()).first().auc)


@pytest.mark.parametrize("decay", [1.0, 0.5])
def test_refit_equals_a_fit_from_scratch(spark, decay):
    days = window_days(20240301, 3)
    assert days == [20240228, 20240229, 20240301]
    made = [(*row[:5], days[i % 4 % 3]) for i, row in enumerate(rows_of(10, 300))]
    store = CountStore(new_path(spark, "counts"), tuple(FEATURES), CROSSES)
    whole = table(spark, made)
    assert store.days(spark) == set()
    refit(whole.filter("filename_date < 20240301"), store, 20240229, 2, decay)
    assert store.days(spark) == {20240228, 20240229}
    newest = whole.filter("filename_date = 20240301")  # all that the refit has to read
    first = refit(newest, store, 20240301, 3, decay)
    again = refit(newest, store, 20240301, 3, decay)
    weighed = [(*row[:4], row[4] * decay ** (2 - days.index(row[5])), row[5]) for row in made]
    scratch = fit_additive_model(table(spark, weighed), FEATURES, crosses=CROSSES)
    for model in (first, again):
        assert model.base == pytest.approx(scratch.base)
        for ours, theirs in ((model.parts, scratch.parts), (model.cross_parts, scratch.cross_parts)):
            ours, theirs = ({tuple(row)[:-1]: row.part for row in side.collect()} for side in (ours, theirs))
            assert ours == pytest.approx(theirs)


def test_store_knows_days_without_rows(spark):
    store = CountStore(new_path(spark, "counts"), tuple(FEATURES), (), Roles())
    model = refit(table(spark, []), store, 20240301, 2)
    assert store.days(spark) == {20240229, 20240301} and model.base == 0
    state = store.merged(spark, [20240229, 20240301], 20240301).collect()
    assert [(row.feature, row.pos, row.neg) for row in state] == [(ALL_ROWS, 0.0, 0.0)]
