"""Operators on small hand-made or generated tables, checked against plain Python."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict
from dataclasses import replace
from math import log2

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RankingEvaluator
from pyspark.sql import functions as F

from affinary.functions.columns import shuffle_hash
from affinary.operators import ordering
from affinary.operators.batching import add_batches, batch_order, read_batch, training_batch_key
from affinary.operators.metrics import CUTOFFS, Metric, auc, duration_at_k, evaluate, log_loss, metric_named, register
from affinary.operators.pairs import anti_join, drop_seen_pairs, first_per_key, latest_per_key, resolve_labels, union_all
from affinary.operators.ranking import (
    attach_ranks,
    candidate_counts,
    catalog_positions,
    open_positions,
    rank_pairs,
    rank_scored,
    top_items,
)
from affinary.operators.retrieval import cosine_top_k, norm_blocks, users_in_reach, vector_top_k
from affinary.operators.sampling import (
    add_synthetic_negatives,
    synthetic_negative_counts,
    synthetic_negatives,
    take_by_hash,
    thin_negatives,
)
from affinary.operators.slices import slice_report
from affinary.roles import Resampling, Roles, spec_from_mapping
from affinary.sources.scan import scan
from affinary.sources.sinks import to_driver, write_table, write_training_set

ROLES = Roles(row_id="event_id")


# ---- pairs ----------------------------------------------------------------


def test_anti_join_matches_null_keys(spark, rows):
    left = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (None, None, "c"), (3, 4, "d")], "u int, i int, x string")
    right = spark.createDataFrame([(1, None), (1, None), (3, 4)], "u int, i int")
    assert rows(anti_join(left, right, ["u", "i"]), "x") == [("b",), ("c",)]


def test_drop_seen_pairs_needs_the_seen_side(spark):
    with pytest.raises(ValueError):
        drop_seen_pairs(spark.range(1), None)


def test_resolve_labels(spark, rows):
    cases = {
        1: [2, 1],  # the positive wins
        2: [0, 1],  # exclude-only removes the negative
        3: [2, 1, 0],
        4: [1, 1],
        5: [2, 2],
        6: [0],
    }
    data = [(u, 7, label) for u, labels in cases.items() for label in labels]
    data += [(None, 7, 2), (None, 7, 1), (None, 8, 1)]
    log = spark.createDataFrame(data, "user_id int, item_id int, is_interacted int")
    kept = rows(resolve_labels(log))
    expected = [(1, 7, 2), (3, 7, 2), (4, 7, 1), (4, 7, 1), (5, 7, 2), (5, 7, 2), (None, 7, 2), (None, 8, 1)]
    assert Counter(kept) == Counter(expected)
    # no pair is both positive and negative
    signs = defaultdict(set)
    for u, i, label in kept:
        signs[u, i].add(label)
    assert all(len(found) == 1 for found in signs.values())


def test_first_and_latest_per_key(spark, rows):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 9, "z")], "k int, v int, x string")
    assert rows(first_per_key(df, ["k"], ["v"])) == [(1, 1, "a"), (2, 9, "z")]
    assert rows(latest_per_key(df, ["k"], "v", 3)) == [(1, 2, "b")]
    assert rows(latest_per_key(df, ["k"], "v", 3, inclusive=True)) == [(1, 3, "c")]


def test_union_needs_the_same_columns(spark):
    with pytest.raises(Exception):
        union_all(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(1,)], "b int")).collect()


# ---- order ----------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows in one group, most values tied."""
    rng = random.Random(5)
    data = [(n, "hot" if n % 3 else f"g{n % 7}", float(rng.choice([1, 1, 1, 2, rng.random()]))) for n in range(6000)]
    return data, spark.createDataFrame(data, "event_id int, g string, v double")


NUMBERINGS = pytest.mark.parametrize("number", [ordering.hash_running_sum, ordering.shuffled_positions])


@NUMBERINGS
def test_hash_positions_are_whole_and_ordered(skewed, number):
    data, df = skewed
    placed = number(df, ["g"], ["event_id"], "s").withColumn("h", shuffle_hash("s", "event_id"))
    groups = defaultdict(list)
    for row in placed.collect():
        groups[row.g].append((row.position, row.h))
    assert sum(map(len, groups.values())) == len(data)
    for members in groups.values():
        assert [at for at, _ in sorted(members)] == list(range(len(members)))
        assert [h for _, h in sorted(members)] == sorted(h for _, h in members)


@NUMBERINGS
def test_positions_do_not_depend_on_partitions(spark, skewed, number):
    _, df = skewed
    first = {r.event_id: r.position for r in number(df, ["g"], ["event_id"], "s").collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        again = number(df.repartition(9), ["g"], ["event_id"], "s")
        assert {r.event_id: r.position for r in again.collect()} == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@NUMBERINGS
def test_null_groups_keep_their_rows(spark, number):
    df = spark.createDataFrame([(n, None if n % 2 else "a") for n in range(10)], "event_id int, g string")
    placed = number(df, ["g"], ["event_id"], "s").collect()
    assert sorted(r.position for r in placed if r.g is None) == list(range(5))


def test_batches_come_from_one_exchange(spark, labelled, tmp_path):
    """Numbered rows lie in the order of their batches, so neither reading nor writing them shuffles them again."""
    _, df = labelled
    batched = add_batches(df.drop("batch_idx").repartition(7), 100, training_batch_key(ROLES), ROLES)
    plan = batched._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    path = tmp_path / "set"
    write_training_set(batched, str(path), ROLES, ["duration"], gather=False)
    whole = df.select("filename_date", "duration", "weighted_lr", "is_interacted").dropna("any")
    stored = spark.read.parquet(str(path))
    assert stored.count() == whole.count()
    n_directories = stored.select("filename_date", "batch_idx", "is_interacted").distinct().count()
    assert n_directories <= len(list(path.rglob("*.parquet"))) <= 2 * n_directories


def test_positions_of_an_empty_table(spark):
    df = spark.createDataFrame([], "event_id int, g string, v double")
    assert ordering.shuffled_positions(df, ["g"], ["event_id"], "s").collect() == []
    assert ordering.value_positions(df, "v", ["event_id"]).collect() == []


def test_auc_over_many_chunks(spark):
    """Scores in more chunks than one, most of them distinct, against ranks; two groups, one of them null."""
    rng = random.Random(3)
    data = [("a" if n % 3 else None, round(rng.random(), 5), rng.random() < 0.3) for n in range(30_000)]
    df = spark.createDataFrame(data, "g string, s double, t boolean")
    from affinary.operators.metrics import auc

    def plain(members):
        ordered, wins, below = sorted(members), 0.0, 0
        for _, tied in itertools.groupby(ordered, key=lambda m: m[0]):
            flags = [t for _, t in tied]
            negatives = len(flags) - sum(flags)
            wins += sum(flags) * (below + negatives / 2)
            below += negatives
        return wins / (below * (len(members) - below))

    found = {r.g: r.auc for r in auc(df, "s", F.col("t"), ["g"]).collect()}
    assert found == pytest.approx({g: plain([(s, t) for h, s, t in data if h == g]) for g in ("a", None)})
    assert auc(df, "s", F.col("t")).first()[0] == pytest.approx(plain([(s, t) for _, s, t in data]))


def test_value_positions_with_heavy_ties(skewed):
    data, df = skewed
    placed = ordering.value_positions(df, "v", ["event_id"])
    placed = placed.withColumn("h", shuffle_hash("tie", "event_id"))
    found = sorted((r.position, -r.v, r.h) for r in placed.collect())
    assert [at for at, _, _ in found] == list(range(1, len(data) + 1))
    assert [entry[1:] for entry in found] == sorted(entry[1:] for entry in found)


def test_value_positions_leave_out_null_and_nan(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, 0.5)], "k int, v double")
    assert [(r.k, r.position) for r in ordering.value_positions(df, "v", ["k"]).collect()] == [(3, 1)]


def test_top_per_group(skewed):
    data, df = skewed
    top = ordering.top_per_group(df, ["g"], [F.desc("v"), F.col("event_id")], 50).collect()
    expected = set()
    for g in {row[1] for row in data}:
        members = sorted((row for row in data if row[1] == g), key=lambda row: (-row[2], row[0]))
        expected |= {(g, row[0], rank) for rank, row in enumerate(members[:50], start=1)}
    assert {(r.g, r.event_id, r["rank"]) for r in top} == expected


def test_explode_range_over_chunks(spark, rows):
    df = spark.createDataFrame([("a", 10), ("b", 0), ("c", 1)], "k string, n bigint")
    assert rows(ordering.explode_range(df, "n", "i", chunk=4)) == [("a", 10, i) for i in range(10)] + [("c", 1, 0)]


def test_number_copies(spark):
    df = spark.createDataFrame([(1, "x")] * 500 + [(2, None)] * 3, "a int, b string")
    numbered = Counter((r.a, r.copy_no) for r in ordering.number_copies(df).collect())
    assert numbered == Counter([(1, n) for n in range(500)] + [(2, n) for n in range(3)])


# ---- ranking --------------------------------------------------------------


@pytest.fixture(scope="module")
def market(spark):
    """Users with few, many and all items seen; half of the scores tied."""
    rng = random.Random(11)
    users, items = list(range(12)), list(range(60))
    scores = {i: float(i % 9 if i % 2 else i) for i in items}
    seen = {(u, i) for u in users for i in items if rng.random() < u / 14}
    seen |= {(11, i) for i in items}
    frames = (
        spark.createDataFrame([(u,) for u in users], "user_id int"),
        spark.createDataFrame(list(scores.items()), "item_id int, score double"),
        spark.createDataFrame(sorted(seen), "user_id int, item_id int"),
    )
    hashes = {r.item_id: r.h for r in frames[1].withColumn("h", shuffle_hash("tie", "item_id")).collect()}
    ranks = {}
    for u in users:
        unseen = sorted((i for i in items if (u, i) not in seen), key=lambda i: (-scores[i], hashes[i]))
        ranks |= {(u, i): rank for rank, i in enumerate(unseen, start=1)}
    return frames, ranks


@pytest.mark.parametrize("bits", [2, 20])
def test_ranks_equal_those_of_all_candidates(monkeypatch, market, bits):
    """Also with tiny spans, so that groups are cut."""
    monkeypatch.setattr("affinary.operators.ranking.SPAN_BITS", bits)
    (users, items, seen), expected = market
    catalog = catalog_positions(items, "score")
    counts = {r.user_id: r.n_candidates for r in candidate_counts(users, items, seen).collect()}
    assert counts == {u: sum(1 for pair in expected if pair[0] == u) for u in counts}
    asked = users.crossJoin(items.select("item_id"))
    found = {(r.user_id, r.item_id): r.prediction_rank for r in rank_pairs(asked, catalog, seen).collect()}
    assert found == expected
    for k in (1, 7, 1000):
        top = top_items(users, catalog, seen, k).collect()
        best = {(r.user_id, r.item_id): r.prediction_rank for r in top}
        assert best == {pair: rank for pair, rank in expected.items() if rank <= k}
        assert len(top) == len(best)


def test_open_positions(spark):
    groups = spark.createDataFrame([("a", 6, 3), ("b", 4, 9), ("c", 2, 2)], "g string, _end bigint, _limit bigint")
    taken = spark.createDataFrame([("a", 0), ("a", 2), ("c", 0), ("c", 1)], "g string, p bigint")
    runs = open_positions(groups, taken, "g", "p").collect()
    filled = sorted((r.g, r._start_at + n, r._before + n) for r in runs for n in range(r._length))
    assert filled == [("a", 1, 0), ("a", 3, 1), ("a", 4, 2), ("b", 0, 0), ("b", 1, 1), ("b", 2, 2), ("b", 3, 3)]


def test_rank_scored_drops_nan_and_null(spark, rows):
    df = spark.createDataFrame(
        [(1, 1, 0.5), (1, 2, float("nan")), (1, 3, None), (1, 4, 0.5), (1, 5, 0.9)], "user_id int, item_id int, s double"
    )
    assert rows(rank_scored(df, "s"), "item_id", "prediction_rank") == [(1, 2), (4, 3), (5, 1)]


def test_attach_ranks(spark, rows):
    evaluated = spark.createDataFrame([(1, 1), (1, 2)], "user_id int, item_id int")
    ranks = spark.createDataFrame([(1, 1, 3)], "user_id int, item_id int, prediction_rank bigint")
    assert rows(attach_ranks(evaluated, ranks)) == [(1, 1, 3), (1, 2, 9999)]


def test_cosine_top_k_in_many_cells(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    u, v = rng.normal(size=(23, 6)), rng.normal(size=(31, 6))
    v[5] = v[6]  # a tie
    seen = {(a, b) for a in range(23) for b in range(31) if rng.random() < 0.2}
    users = spark.createDataFrame([(n, row.tolist()) for n, row in enumerate(u)], "user_id int, vector array<double>")
    items = spark.createDataFrame([(n, row.tolist()) for n, row in enumerate(v)], "item_id int, vector array<double>")
    pairs = spark.createDataFrame([(int(a), int(b)) for a, b in seen], "user_id int, item_id int")
    found = cosine_top_k(users, items, 4, pairs, users_per_cell=5, items_per_cell=7).collect()
    scores = (u / np.linalg.norm(u, axis=1)[:, None]) @ (v / np.linalg.norm(v, axis=1)[:, None]).T
    scores = np.round((scores + 1) / 2, 6)
    for a in range(23):
        order = sorted((b for b in range(31) if (a, b) not in seen), key=lambda b: (-scores[a, b], b))[:4]
        mine = sorted((r.prediction_rank, r.item_id) for r in found if r.user_id == a)
        assert mine == [(rank, b) for rank, b in enumerate(order, start=1)]


def test_cosine_top_k_keeps_long_ids_and_close_scores(spark):
    big = 2**60
    angles = [0.5 + step * 1e-8 for step in range(10)]
    users = spark.createDataFrame([(big + n, [1.0, 0.0]) for n in range(3)], "user_id bigint, vector array<double>")
    vectors = [(big + n, [math.cos(angle), math.sin(angle)]) for n, angle in enumerate(angles)]
    items = spark.createDataFrame(vectors, "item_id bigint, vector array<double>")
    pairs = spark.createDataFrame([(big, big), (big + 1, big + 1)], "user_id bigint, item_id bigint")
    found = {(r.user_id - big, r.prediction_rank): r.item_id - big for r in cosine_top_k(users, items, 2, pairs).collect()}
    assert found == {(0, 1): 1, (0, 2): 2, (1, 1): 0, (1, 2): 2, (2, 1): 0, (2, 2): 1}


def dot_products_by_hand(users, items, seen, k):
    import numpy as np

    best = set()
    for user, u in users:
        scored = sorted((-round(float(np.dot(u, v)), 12), item) for item, v in items if (user, item) not in seen)
        best |= {(user, item, rank) for rank, (_, item) in enumerate(scored[:k], start=1)}
    return best


@pytest.mark.parametrize("spread", [0.0, 3.0])
def test_vector_top_k_over_blocks_of_falling_norm(spark, spread):
    import numpy as np

    rng = np.random.default_rng(8)
    norms = np.exp(-spread * rng.random(300))
    directions = rng.normal(size=(300, 5))
    vectors = directions / np.linalg.norm(directions, axis=1)[:, None] * norms[:, None]
    vectors[7] = vectors[8] = 0.0
    vectors[11] = vectors[12] = vectors[13]
    goods = [(f"item-{n:03}", row.tolist()) for n, row in enumerate(vectors)]
    people = [(n, row.tolist()) for n, row in enumerate(rng.normal(size=(40, 5)))] + [(40, [0.0] * 5)]
    seen = {(user, item) for user, _ in people for item, _ in goods if rng.random() < 0.1}
    seen |= {(1, item) for item, _ in goods[:-2]} | {(2, item) for item, _ in goods}
    users = spark.createDataFrame(people, "user_id int, vector array<double>")
    items = spark.createDataFrame(goods, "item_id string, vector array<double>")
    pairs = spark.createDataFrame([*seen, (3, None), (None, "item-001"), (99, "item-002")], "user_id int, item_id string")
    for given, known in ((pairs, seen), (None, set())):
        found = vector_top_k(users, items, 6, given, users_per_cell=16, items_per_cell=20).collect()
        assert {(r.user_id, r.item_id, r.prediction_rank) for r in found} == dot_products_by_hand(people, goods, known, 6)


def test_blocks_out_of_reach_are_skipped(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    lengths = 0.9 ** np.arange(200)
    directions = rng.normal(size=(200, 4))
    vectors = directions / np.linalg.norm(directions, axis=1)[:, None] * lengths[:, None]
    items = spark.createDataFrame([(n, row.tolist()) for n, row in enumerate(vectors)], "item_id int, vector array<double>")
    blocks = norm_blocks(items, "item_id", "vector", 10, unit=False)
    assert len(blocks.norms) > 10 and list(blocks.norms) == sorted(blocks.norms, reverse=True)
    assert blocks.rows.count() == 200 and blocks.rows.select("_block").distinct().count() == len(blocks.norms)
    people = rng.normal(size=(30, 4))
    fifth = np.sort(people @ vectors.T, axis=1)[:, -5]
    rows = [(n, u.tolist(), float(np.linalg.norm(u)), float(floor), None) for n, (u, floor) in enumerate(zip(people, fifth))]
    asking = spark.createDataFrame(rows, "_id int, _v array<double>, _norm double, _floor double, _seen map<int,bigint>")
    met = users_in_reach(asking, blocks.norms, 0, len(blocks.norms)).select("_id", "_block").collect()
    expected = {(n, b) for n, u in enumerate(people) for b, norm in enumerate(blocks.norms) if np.linalg.norm(u) * norm >= fifth[n]}
    assert set(map(tuple, met)) == expected and len(expected) < 0.5 * 30 * len(blocks.norms)


def test_vector_top_k_runs_in_several_tasks(spark):
    from affinary.operators.retrieval import _cells, _usable

    users = spark.range(1500).select(F.col("id").alias("user_id"), F.array(F.lit(1.0), F.rand(1)).alias("vector"))
    blocks = norm_blocks(users.limit(100).withColumnRenamed("user_id", "item_id"), "item_id", "vector", 4096, unit=False)
    visits = _usable(users, "user_id", "vector").select("*", F.lit(0).alias("_block"), F.lit(0.0).alias("_floor"), F.lit(None).cast("map<int,bigint>").alias("_seen"))
    cells = _cells(visits, blocks.rows, 5, 2, 1).select(F.spark_partition_id().alias("task"), "_slot").distinct().collect()
    assert len({row.task for row in cells}) > 1 and {row._slot for row in cells} == {0, 1}


def test_vector_top_k_leaves_unusable_vectors_out(spark):
    nan, inf = float("nan"), float("inf")
    people = [(1, [1.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [1.0, None]), (None, [1.0, 1.0]), (5, []), (6, [1e200, 1.0])]
    goods = [(1, [0.5, 0.5]), (2, [inf, 0.0]), (3, [2.0, 0.0]), (4, [None, 1.0]), (None, [9.0, 9.0]), (5, [1e200, 0.0])]
    users = spark.createDataFrame(people, "user_id int, vector array<double>")
    items = spark.createDataFrame(goods, "item_id int, vector array<double>")
    found = sorted((r.user_id, r.item_id, r.prediction_rank) for r in vector_top_k(users, items, 5, items_per_cell=2).collect())
    assert found == [(1, 1, 3), (1, 3, 2), (1, 5, 1), (6, 1, 2), (6, 3, 1)]  # 1e200 * 1e200 overflows
    found = sorted((r.user_id, r.item_id, r.prediction_rank) for r in cosine_top_k(users, items, 1).collect())
    assert found == [(1, 3, 1), (6, 3, 1)]
    assert vector_top_k(users, items.limit(0), 5).count() == 0 and vector_top_k(users.limit(0), items, 5).count() == 0


# ---- resampling -----------------------------------------------------------


PLAN = Resampling(popular={1: 0.3, 2: 0.5}, tail={3: 0.5, 4: 0.0, 5: 1.0})


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    data = []
    for event in range(3000):
        band = rng.choice([1, 2, 3, 3, 3, 4, 5, 9])
        day = 20240101 if rng.random() < 0.6 else 20240100 + rng.randint(2, 5)
        data.append((event, rng.randint(1, 40), band * 100 + rng.randint(1, 5), day, rng.choice([1, 1, 2]), 1.5, band, 10.0))
    columns = "event_id int, user_id int, item_id int, filename_date int, is_interacted int, weighted_lr double, popularity_item_group int, duration double"
    return data, spark.createDataFrame(data, columns)


def test_thin_negatives_takes_exact_fractions(labelled):
    data, df = labelled
    kept = thin_negatives(df, PLAN, training_batch_key(ROLES), ROLES).collect()

    def sizes(found):
        return Counter((band, day) for _, _, _, day, label, _, band, _ in found if label == 1)

    before, after = sizes(data), sizes(kept)
    for (band, day), n in before.items():
        fraction = {1: 1, 2: 1, 3: 0.5, 4: 0, 5: 1, 9: 0}[band]
        assert after[band, day] == round(fraction * n), (band, day)
    assert sum(r.is_interacted == 2 for r in kept) == sum(row[4] == 2 for row in data)
    for other in (df.repartition(7), df):
        again = thin_negatives(other, PLAN, training_batch_key(ROLES), ROLES)
        assert {r.event_id for r in again.collect()} == {r.event_id for r in kept}


def test_nothing_is_thinned_when_all_fractions_are_one(labelled):
    data, df = labelled
    plan = Resampling(popular={1: 0.0}, tail={3: 1.0, 4: 1.0})
    assert not plan.active and not plan.adds_negatives
    kept = thin_negatives(df, plan, training_batch_key(ROLES), ROLES)
    assert kept.count() == sum(row[4] != 1 or row[6] in (1, 3, 4) for row in data)


def test_synthetic_negatives(spark, labelled):
    data, df = labelled
    positives = [row for row in data if row[4] == 2]
    pool_rows = sorted({(row[2], row[3], row[6]) for row in positives if row[6] in (1, 2)})
    active = {(row[1], row[3]) for row in positives}
    known = {(row[1], row[2]) for row in positives}
    supply = Counter()
    free = set()
    for item, day, band in pool_rows:
        for user, on in active:
            if on == day and (user, item) not in known:
                supply[day, band] += 1
                free.add((user, item, day))
    pool = spark.createDataFrame(pool_rows, "item_id int, filename_date int, popularity_item_group int")
    counted = synthetic_negative_counts(df, pool, PLAN, ROLES).collect()
    assert {(r.filename_date, r.popularity_item_group): r.n_pairs for r in counted if r.n_pairs} == dict(supply)

    drawn = [(r.user_id, r.item_id, r.filename_date, r.popularity_item_group) for r in synthetic_negatives(df, pool, PLAN, ROLES).collect()]
    assert len(drawn) == len(set(drawn))
    assert {pair[:3] for pair in drawn} <= free
    for band in (1, 2):
        total = sum(n for (_, b), n in supply.items() if b == band)
        assert sum(pair[3] == band for pair in drawn) == round(PLAN.popular[band] * total)
    # the sample is spread over users, not packed on a few
    per_user = Counter(pair[0] for pair in drawn)
    assert len(per_user) > 30

    columns = df.columns
    grown = add_synthetic_negatives(df, pool, PLAN, columns, ROLES)
    added = grown.filter("event_id is null")
    assert added.count() == len(drawn)
    assert added.select("is_interacted", "weighted_lr").distinct().collect() == [(1, 1.0)]
    assert add_synthetic_negatives(df, None, PLAN, columns, ROLES).count() == len(data)


def test_null_groups_are_thinned_like_others(spark):
    df = spark.createDataFrame([(n, None if n % 2 else "a") for n in range(20)], "event_id int, g string")
    kept = take_by_hash(df, ["g"], F.lit(0.5), ["event_id"], "s").collect()
    assert Counter(r.g for r in kept) == {None: 5, "a": 5}


def test_synthetic_negatives_tell_null_features_apart(spark):
    """Features that only differ in where a null stands, or hold the separator, are different pool rows."""
    roles = replace(ROLES, item_features=("f1", "f2"), context_features=())
    pool_rows = [(1, 20240101, None, "X", 1), (1, 20240101, "X", None, 1), (1, 20240101, "X|Y", "Z", 1), (1, 20240101, "X", "Y|Z", 1)]
    pool = spark.createDataFrame(pool_rows, "item_id int, filename_date int, f1 string, f2 string, popularity_item_group int")
    rows = [(n, n, 2, 20240101, 2, 1.0, 1, 5.0, None, None) for n in range(10)]
    columns = "event_id int, user_id int, item_id int, filename_date int, is_interacted int, weighted_lr double, popularity_item_group int, duration double, f1 string, f2 string"
    df = spark.createDataFrame(rows, columns)
    plan = Resampling(popular={1: 0.5}, tail={3: 0.5})
    drawn = [tuple(r) for r in synthetic_negatives(df, pool, plan, roles).collect()]
    assert len(drawn) == len(set(drawn)) == 20


def test_empty_pool_adds_nothing(spark, labelled):
    data, df = labelled
    pool = spark.createDataFrame([], "item_id int, filename_date int, popularity_item_group int")
    assert add_synthetic_negatives(df, pool, PLAN, df.columns, ROLES).count() == len(data)


# ---- batches --------------------------------------------------------------


def test_batches_are_full_but_the_last(labelled):
    data, df = labelled
    batched = add_batches(df, 70, training_batch_key(ROLES), ROLES, mini_batches=2).collect()
    sizes = Counter((r.filename_date, r.batch_idx) for r in batched)
    for day in {row[3] for row in data}:
        mine = [sizes[day, b] for b in range(len([1 for d, _ in sizes if d == day]))]
        assert all(n == 35 for n in mine[:-1]) and 0 < mine[-1] <= 35


def test_batch_order_keeps_days_in_order(spark):
    catalog = spark.createDataFrame([(20240100 + d, b) for d in range(1, 12) for b in range(5)], "filename_date int, batch_idx int")
    for by_week in (False, True):
        order = sorted(batch_order(catalog, by_week=by_week).collect(), key=lambda r: r.read_index)
        assert [r.read_index for r in order] == list(range(55))
        if not by_week:
            assert [r.filename_date for r in order] == sorted(r.filename_date for r in order)
    days = [r.filename_date for r in order]
    assert days != sorted(days) and set(days[:35]) == set(range(20240101, 20240108))


def test_training_set_round_trip(spark, tmp_path, labelled):
    _, df = labelled
    batched = add_batches(df.drop("batch_idx"), 100, training_batch_key(ROLES), ROLES)
    holed = batched.withColumn("duration", F.when(F.col("event_id") % 10 > 0, F.col("duration")))
    path = str(tmp_path / "set")
    write_training_set(holed, path, ROLES, ["duration", "popularity_item_group"])
    stored = spark.read.parquet(path)
    assert stored.count() == sum(1 for row in labelled[0] if row[0] % 10)
    assert stored.columns[-1] == "is_interacted"
    day, batch = stored.select("filename_date", "batch_idx").first()
    one = read_batch(spark, path, day, batch, ["duration", "popularity_item_group"], ROLES)
    assert one.columns == ["values", "label", "weight"]
    assert one.count() == stored.filter((F.col("filename_date") == day) & (F.col("batch_idx") == batch)).count()


def test_write_modes(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    write_table(first, path, ["p"])
    write_table(spark.createDataFrame([(9, "b")], "v int, p string"), path, ["p"], "replace_partitions")
    assert rows(scan(spark, path), "v", "p") == [(1, "a"), (9, "b")]
    write_table(spark.createDataFrame([(5, "a")], "v int, p string"), path, ["p"], "append")
    assert scan(spark, path).count() == 3
    write_table(first, path, ["p"])
    assert rows(scan(spark, path, ["v"], ["p == 'b'"])) == [(2,)]
    with pytest.raises(ValueError):
        write_table(first, path, mode="errorifexists")
    with pytest.raises(ValueError):
        scan(spark, [])


def test_partition_filters_prune(spark, tmp_path):
    path = str(tmp_path / "log")
    write_table(spark.range(100).selectExpr("id", "id % 5 as d"), path, ["d"])
    plan = scan(spark, path, ["id"], ["d >= 3", "d != 4", "id < 50"])._jdf.queryExecution().executedPlan().toString()
    line = next(part for part in plan.splitlines() if "FileScan" in part)
    assert "d#" in line.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "LessThan(id,50)" in line and "ReadSchema: struct<id:bigint>" in line


def test_to_driver_refuses_large_results(spark):
    assert len(to_driver(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        to_driver(spark.range(6), 5)


# ---- metrics --------------------------------------------------------------


@pytest.fixture(scope="module")
def evaluated(spark):
    rng = random.Random(8)
    data = [
        (u, rng.choice([1, 3, 9, 15, 60, 150, 400, 900, 9999, rng.randint(1, 2000)]), 2, float(rng.randint(1, 9)), rng.choice(["x", "y", None]))
        for u in range(30)
        for _ in range(rng.randint(1, 6))
    ]
    data += [(99, n + 1, 2, 1.0, "x") for n in range(150)]  # more than 100 relevant items
    columns = "user_id int, prediction_rank int, is_interacted int, duration double, side string"
    return data, spark.createDataFrame(data, columns)


def _expected(data):
    users = defaultdict(list)
    for row in data:
        users[row[0]].append(row[1])
    scores = {}
    for k in CUTOFFS:
        hits = {u: sum(r <= k for r in ranks) for u, ranks in users.items()}
        gain = {u: sum(1 / log2(r + 1) for r in ranks if r <= k) for u, ranks in users.items()}
        ideal = {u: sum(1 / log2(n + 1) for n in range(1, min(len(ranks), k) + 1)) for u, ranks in users.items()}
        n = len(users)
        scores[f"recall@{k}"] = sum(hits[u] / len(users[u]) for u in users) / n
        scores[f"precision@{k}"] = sum(hits.values()) / k / n
        scores[f"ndcg@{k}"] = sum(gain[u] / ideal[u] for u in users) / n
    return scores


def test_metrics(evaluated):
    data, df = evaluated
    found = evaluate(df, ["recall_at_k", "precision_at_k", "ndcg_at_k"]).first().asDict()
    assert found.pop("sample_count") == len(data)
    assert found == pytest.approx(_expected(data))
    recalls = [found[f"recall@{k}"] for k in CUTOFFS]
    assert recalls == sorted(recalls)


def test_slices_leave_nulls_to_the_overall_row(evaluated):
    data, df = evaluated
    report = slice_report(df, ["side"], ["recall_at_k", "ndcg_at_k"]).collect()
    by_value = {r["value"]: r.asDict() for r in report}
    assert set(by_value) == {"x", "y", "OVERALL"}
    for value, row in by_value.items():
        mine = [d for d in data if value in ("OVERALL", d[4])]
        assert row["sample_count"] == len(mine)
        expected = _expected(mine)
        for k in CUTOFFS:
            assert row[f"recall@{k}"] == pytest.approx(expected[f"recall@{k}"])
            assert row[f"ndcg@{k}"] == pytest.approx(expected[f"ndcg@{k}"])
    assert [r["recall@1"] for r in report] == sorted(r["recall@1"] for r in report)


def test_slices_per_separating_value(evaluated):
    data, df = evaluated
    report = slice_report(df.withColumn("part", F.col("user_id") % 2), ["side"], ["recall_at_k"], separate_by="part")
    overall = {r.part: r.sample_count for r in report.filter("value = 'OVERALL'").collect()}
    assert overall == Counter(row[0] % 2 for row in data)


def test_user_metrics_agree_with_ml(spark):
    data = [(u, list(range(10)), sorted(random.Random(u).sample(range(20), 5))) for u in range(20)]
    lists = spark.createDataFrame([(float(u), [float(x) for x in p], [float(x) for x in t]) for u, p, t in data], "id double, prediction array<double>, label array<double>")
    ranked = spark.createDataFrame(
        [(u, p.index(x) + 1 if x in p else 9999, 2) for u, p, t in data for x in t], "user_id int, prediction_rank int, is_interacted int"
    )
    mine = evaluate(ranked, ["recall_at_k", "precision_at_k", "ndcg_at_k"]).first()
    for name, score in (("recallAtK", "recall@10"), ("precisionAtK", "precision@10"), ("ndcgAtK", "ndcg@10")):
        assert RankingEvaluator(metricName=name, k=10).evaluate(lists) == pytest.approx(mine[score])


def test_rows_without_user_or_rank(spark):
    df = spark.createDataFrame([(1, 1, 2), (None, 1, 2), (2, None, 2)], "user_id int, prediction_rank int, is_interacted int")
    row = evaluate(df, ["recall_at_k", "ndcg_at_k"]).first()
    assert row["sample_count"] == 3 and row["recall@1"] == 1.0 and row["ndcg@1"] == 1.0


def test_duration(evaluated, spark):
    data, df = evaluated
    row = duration_at_k(df).first()
    users = len({d[0] for d in data})
    assert row["active_users"] == users
    assert row["duration@10"] == pytest.approx(sum(d[3] for d in data if d[1] <= 10) / users)
    assert row["duration_all"] == pytest.approx(sum(d[3] for d in data) / users)
    nobody = duration_at_k(df.withColumn("is_interacted", F.lit(1))).first()
    assert nobody["active_users"] == 0 and nobody["duration@1"] is None


def test_auc_agrees_with_ml(spark):
    rng = random.Random(4)
    data = [(round(rng.random(), 2), rng.choice([1, 2])) for _ in range(2000)]
    df = spark.createDataFrame(data, "s double, is_interacted int")
    exact = auc(df, "s", F.col("is_interacted") > 1).first()["auc"]
    as_ml = df.select(F.col("s").alias("rawPrediction"), (F.col("is_interacted") > 1).cast("double").alias("label"))
    assert BinaryClassificationEvaluator(numBins=0).evaluate(as_ml) == pytest.approx(exact)
    assert auc(df.filter("is_interacted = 2"), "s", F.col("is_interacted") > 1).first()["auc"] is None


def test_log_loss_does_not_overflow(spark):
    df = spark.createDataFrame([(800.0, 2, 1.0), (-800.0, 1, 3.0), (0.0, 2, 2.0)], "z double, y int, w double")
    row = log_loss(df, "z", F.col("y") > 1, "w").first()
    assert row["log_loss"] == pytest.approx(0.693147 * 2 / 6, abs=1e-6)
    assert row["log_loss_times_mean_weight"] == pytest.approx(0.693147 / 3 * 2, abs=1e-6)


def test_metric_registry(spark, evaluated):
    _, df = evaluated
    register(Metric("top1", ("top1",), True, lambda i: {"best": F.min(i.rank)}, lambda: {"top1": (F.col("best") == 1).cast("double")}))
    assert 0 <= evaluate(df, ["top1"]).first()["top1"] <= 1
    register(Metric("broken", ("a", "b"), True, lambda i: {"n": F.count(i.rank)}, lambda: {"a": F.col("n")}))
    with pytest.raises(ValueError):
        evaluate(df, ["broken"])
    with pytest.raises(ValueError):
        metric_named("unheard of")


# ---- settings -------------------------------------------------------------


def test_spec_from_mapping():
    spec = spec_from_mapping(
        {
            "config_name": "m",
            "data_loader": {
                "user_id_col": "u",
                "item_id_col": "i",
                "label_col": "y",
                "weight_col": "w",
                "duration_col": "d",
                "item_feature_names": ["f"],
                "context_feature_names": [],
                "popularity_sample_groups": ["1", 2],
                "factor_popularity_sample_groups": [0.0, 0.1],
                "tail_sample_groups": [3],
                "factor_tail_sample_groups": [1],
                "batch_size": 10,
            },
            "model_analysis": {"metrics": ["recall_at_k"], "by_features": ["f"]},
        }
    )
    assert spec.resampling.popular == {1: 0.0, 2: 0.1} and spec.resampling.tail == {3: 1.0}
    assert spec.roles.all_columns == ["u", "i", "f", "y", "w", "d"]
    assert spec.roles.select_order({"y", "f"}) == ["f", "y"]
    assert spec.slice_by == ("f",) and spec.batch_size == 10


def test_stored_batches_read_only_their_files(spark):
    from affinary.operators.batching import StoredBatches
    from affinary.sources.scratch import new_path
    from affinary.sources.sinks import write_training_set

    data = [(20240101 + n % 5, n // 20, float(n), 1.0, 1 + n % 2) for n in range(200)]
    rows = spark.createDataFrame(data, "filename_date int, batch_idx bigint, x double, weighted_lr double, is_interacted int")
    stored = StoredBatches(new_path(spark, "set"), new_path(spark, "manifest"))
    write_training_set(rows, stored.path, stored.roles, ["x"])
    manifest = {row.read_index: row for row in stored.write_manifest(spark).collect()}
    assert sorted(manifest) == list(range(50)) and sum(row.n_rows for row in manifest.values()) == 200
    found = stored.read(spark, ["x"], [7, 21])
    wanted = {name for place in (7, 21) for name in manifest[place].files}
    def plain(names):
        return {name.replace("file:///", "/").replace("file:/", "/") for name in names}

    assert plain(found.inputFiles()) == plain(wanted) and len(wanted) <= 4 < len(spark.read.parquet(stored.path).inputFiles())
    expected = {
        (place, x) for place in (7, 21) for day, batch, x, _, _ in data if (day, batch) == (manifest[place].filename_date, manifest[place].batch_idx)
    }
    assert {(row.read_index, row["values"][0]) for row in found.collect()} == expected and expected
    assert stored.read(spark, ["x"], [999]).count() == 0
    days = [row.filename_date for _, row in sorted(manifest.items())]
    assert days == sorted(days)


def test_stored_batches_without_a_directory_each(spark, tmp_path):
    """Files do not grow with the batches; each batch is read back whole, from its own files."""
    from affinary.operators.batching import StoredBatches

    data = [(n, n % 40, n % 30, 20240101 + n % 5, 1 + n % 2, float(n), 1.0) for n in range(10_000)]
    df = spark.createDataFrame(data, "event_id int, user_id int, item_id int, filename_date int, is_interacted int, x double, weighted_lr double")
    batched = add_batches(df.repartition(3), 10, training_batch_key(ROLES), ROLES)
    for gather in (False, True):
        stored = StoredBatches(str(tmp_path / f"set{gather}"), str(tmp_path / f"manifest{gather}"), ROLES)
        write_training_set(batched, stored.path, ROLES, ["x"], gather=gather, batch_directories=False)
        # 5 days, 2 labels, and the days that two of at most 8 tasks share
        assert len(spark.read.parquet(stored.path).inputFiles()) <= 2 * (5 + 8)
        manifest = {row.read_index: row for row in stored.write_manifest(spark).collect()}
        assert sorted(manifest) == list(range(1000)) and {row.n_rows for row in manifest.values()} == {10}
        members = {}
        for row in batched.select("filename_date", "batch_idx", "x").collect():
            members.setdefault((row.filename_date, row.batch_idx), set()).add(row.x)
        found = stored.read(spark, ["x"], [3, 640, 5000])
        assert "In(batch_idx" in found._jdf.queryExecution().executedPlan().toString()
        for place in (3, 640):
            asked = {row["values"][0] for row in found.filter(F.col("read_index") == place).collect()}
            assert asked == members[manifest[place].filename_date, manifest[place].batch_idx]
        assert stored.read(spark, ["x"], [5000]).count() == 0


def test_stored_training_set_has_no_file_per_batch(spark, tmp_path, monkeypatch):
    from affinary.catalog import QUERIES

    monkeypatch.setattr("affinary.catalog.training.new_path", lambda _, name: str(tmp_path / name))
    found = QUERIES["stored_training_set"](spark, "/root/testdata/sf0.01")
    days = found.select("filename_date", "is_interacted").distinct().count()
    assert len(list((tmp_path / "training").rglob("*.parquet"))) <= days + 2 * 8 < found.count()


def test_slice_report_brings_narrow_rows_together(spark, monkeypatch):
    """Sums of users are not shuffled, parts hold a bounded number of rows, heavy users give the same scores."""
    from affinary.operators import slices

    data = [(n % 7 if n % 5 else None, n % 40 + 1, 1 + n % 2, 0.5, "a" if n % 3 else None, "OVERALL") for n in range(3000)]
    df = spark.createDataFrame(data, "user_id int, prediction_rank int, is_interacted int, prediction double, side string, name string")
    asked = ["recall_at_k", "ndcg_at_k", "rmse"]
    staged, keep = [], slices.materialize

    def stage(table, name):
        staged.append((name, table.columns))
        return keep(table, name)

    monkeypatch.setattr(slices, "TASK_ROWS", 1000)
    whole = slice_report(df, ["side", "name"], asked, stage=stage)
    assert staged[0][1] == ["user_id", "_f0", "_f1", "_label", "_prediction", "_rank"]
    # one exchange of rows by user; sums are shuffled by user and slice for heavy users alone
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"hashpartitioning\(user_id#\d+, (\d+)\)", plan) == ["9"]
    assert len(re.findall(r"hashpartitioning\(user_id#\d+, _at", plan)) == 1
    monkeypatch.setattr(slices, "HEAVY_ROWS", 500)
    cut = slice_report(df, ["side", "name"], asked)

    def plain(report):
        return sorted((r.feature, r.value, r.sample_count, *[round(v, 9) for v in r[3:]]) for r in report.collect())

    assert plain(cut) == plain(whole) and len(plain(whole)) == 4
    # a row without a user counts as a row only
    assert [row[2] for row in plain(whole)] == [3000, 3000, 3000, 2000]


def test_slice_report_reads_what_its_metrics_read(spark):
    df = spark.createDataFrame([(1, 2, "a"), (1, 3, None)], "user_id int, prediction_rank int, side string")
    found = {(r.feature, r.value): r["recall@1"] for r in slice_report(df, ["side"], ["recall_at_k"]).collect()}
    assert found == {("side", "a"): 0.0, ("side", "OVERALL"): 0.0}


def test_batches_stage_only_what_is_kept(spark, labelled):
    """The hash is sorted by, not stored; the batches are those of the whole table."""
    _, df = labelled
    tables = []

    def stage(table, name):
        tables.append((name, table.columns))
        return table.localCheckpoint()

    key = training_batch_key(ROLES)
    kept = add_batches(df.drop("batch_idx"), 100, key, ROLES, stage=stage, keep=["event_id"])
    assert tables[0] == ("sorted", ["event_id", "filename_date", "__at"]) and tables[1][0] == "offsets"
    assert kept.columns == ["event_id", "filename_date", "batch_idx"]
    whole = add_batches(df.drop("batch_idx"), 100, key, ROLES, stage=stage)
    assert "__h" not in tables[2][1] and set(df.columns) <= {*tables[2][1], "batch_idx"}
    assert sorted(kept.collect()) == sorted(whole.select(*kept.columns).collect())


def test_order_lines_are_staged_once_and_narrow(spark, monkeypatch):
    from affinary.catalog import QUERIES
    from affinary.operators import batching, ordering

    tables, keep = [], ordering.materialize

    def stage(table, name):
        tables.append((name, table.columns))
        return keep(table, name)

    monkeypatch.setattr("affinary.catalog.training.materialize", stage)
    monkeypatch.setattr(batching.add_batches, "__defaults__", (*batching.add_batches.__defaults__[:-2], stage, None))
    QUERIES["batch_index_orders"](spark, "/root/testdata/sf0.001")
    assert (tables[0][0], sorted(tables[0][1])) == ("sorted", ["__at", "event_id", "filename_date"])


def test_sample_shuffles_the_cut_slots_only(spark):
    """The rows are not shuffled to find the cut-offs: the slots that hold them are sent to the rows."""
    from affinary.operators import ordering

    plans = {}

    def stage(table, name):
        plans[name] = table._jdf.queryExecution().executedPlan().toString()
        return ordering.materialize(table, name)

    df = spark.createDataFrame([(n, n % 3 if n % 7 else None) for n in range(2000)], "event_id int, g int").repartition(3)
    kept = take_by_hash(df, ["g"], F.lit(0.5), ["event_id"], "s", stage)
    assert "BroadcastHashJoin" in plans["cuts"] and "SortMergeJoin" not in plans["cuts"]
    sizes = Counter(n % 3 if n % 7 else None for n in range(2000))
    assert Counter(row.g for row in kept.collect()) == {g: round(n / 2) for g, n in sizes.items()}


def test_order_lines_join_in_parts_of_bounded_rows(spark, monkeypatch):
    """The parts follow the lines, not the setting; lines meet their items without being sorted by them."""
    from affinary.catalog import logs, scores

    whole = logs.order_lines(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(logs, "JOIN_ROWS", 500)
    n_parts = -(-spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count() // 500)
    cut = logs.order_lines(spark, "/root/testdata/sf0.001")
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"orderkey#\d+L, (\d+)\)", plan)) == {str(n_parts)}
    assert sorted(cut.collect()) == sorted(whole.collect())
    ranked = scores._ranked_lines(spark, "/root/testdata/sf0.001")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"(\w+) \[item_id#\d+L\], \[item_id#\d+L\], Inner", plan)[0] == "ShuffledHashJoin"
