from zlib import crc32

import numpy as np
import pytest

from affinary.llm import quality
from affinary.llm.queries import QUERIES


def machine(features, rank=3, seed=0):
    random = np.random.default_rng(seed)
    return quality.Machine(float(random.normal()), random.normal(size=features), random.normal(size=(features, rank)))


def test_linear_time_score_equals_all_pairs():
    random = np.random.default_rng(4)
    made = machine(50)
    docs = [(np.sort(random.choice(50, n, replace=False)), random.normal(size=n)) for n in (1, 2, 9, 50)]
    expected = []
    for places, x in docs:
        raw = made.bias + made.weights[places] @ x
        for i in range(len(places)):
            for j in range(i + 1, len(places)):
                raw += made.factors[places[i]] @ made.factors[places[j]] * x[i] * x[j]
        expected.append(raw)
    starts = np.cumsum([0, *[len(p) for p, _ in docs[:-1]]])
    found = quality.raw_scores(made, np.concatenate([p for p, _ in docs]), np.concatenate([x for _, x in docs]), starts)
    np.testing.assert_allclose(found, expected)


def test_gradients_match_differences():
    random = np.random.default_rng(2)
    rows, answers = random.normal(size=(20, 6)), random.integers(0, 2, 20).astype(float)
    made = machine(6, 2)
    _, found = quality.loss_and_gradients(made, rows, answers, 0.01)
    step = 1e-6

    def loss(bias=0.0, weights=0.0, factors=0.0):
        return quality.loss_and_gradients(quality.Machine(made.bias + bias, made.weights + weights, made.factors + factors), rows, answers, 0.01)[0]

    assert (loss(bias=step) - loss(bias=-step)) / (2 * step) == pytest.approx(found.bias, abs=1e-6)
    for i in range(6):
        move = np.eye(6)[i] * step
        assert (loss(weights=move) - loss(weights=-move)) / (2 * step) == pytest.approx(found.weights[i], abs=1e-6)
        for f in range(2):
            move = np.zeros((6, 2))
            move[i, f] = step
            assert (loss(factors=move) - loss(factors=-move)) / (2 * step) == pytest.approx(found.factors[i, f], abs=1e-6)


def test_learns_interactions_that_no_linear_model_can():
    random = np.random.default_rng(3)
    signs = random.integers(0, 2, (400, 2))
    rows = np.zeros((400, 4))
    rows[np.arange(400), signs[:, 0]] = 1
    rows[np.arange(400), 2 + signs[:, 1]] = 1
    answers = (signs[:, 0] ^ signs[:, 1]).astype(float)
    made = quality.train(rows, answers, rank=2, epochs=40)
    starts = np.arange(0, 800, 2)
    found = quality.raw_scores(made, np.nonzero(rows)[1], np.ones(800), starts)
    assert ((found > 0) == answers).mean() > 0.99


def test_features_read_whole_texts(monkeypatch, words):
    text = "Über  zwei!\nÜber  zwei!\n\x0b" + words(3000, 1) + "\n" + "y" * 500 + " end### 　x y"
    whole = quality.text_features(text)
    monkeypatch.setattr(quality, "_PIECE", 100)
    assert quality.text_features(text) == whole
    assert quality.text_features(text + " more words")[0] != whole[0]
    assert quality.text_features(None) == quality.text_features("") and not quality.text_features("")[0]
    for odd in (None, "", " \n", "\ud800", "\0", "a", "é" * 10):
        places, values = quality.places_and_values(odd, (None, 3.0, float("nan"), -1.0))
        assert (np.diff(places) > 0).all() and places[-1] < quality.feature_count(4) and np.isfinite(values).all()


@pytest.fixture(scope="module")
def small(spark, documents, words):
    rows = [(i, words(30 + i % 40, i) if i % 3 else " ".join(w + "&&&" for w in words(20 + i % 9, i).split()), "en", f"s{i % 2}") for i in range(240)]
    rows += [(1000, None), (1001, ""), (None, words(40, 5)), (None, None), (1002, "x" * 2_000_000), (1003, "# " * 300_000), (7, rows[7][1]), (7, "other text of one id")]
    labels = [(i, int(i % 3 > 0), "x") for i in range(0, 240)] + [(5, 1, "x"), (6, None, "x"), (None, 1, "x"), (99999, 0, "x"), (1000, 1, "x")]
    return documents(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, answer string")


def test_scores_of_odd_rows(small):
    docs, labels = small
    found = quality.score(docs, quality.fit(docs, labels)).select("doc_id", "score", "predicted", "size").collect()
    assert len(found) == docs.count() and all(0 <= row.score <= 1 and row.size == "x" for row in found)
    assert all(row.predicted == int(row.score >= 0.7) for row in found)
    unseen = [row for row in found if row.doc_id is not None and row.doc_id < 240 and row.doc_id != 7 and crc32(str(row.doc_id).encode()) % 4 == 2]
    assert sum(row.predicted == int(row.doc_id % 3 > 0) for row in unseen) >= 0.95 * len(unseen)
    empty = [row.score for row in found if row.doc_id in (1000, 1001)]
    assert len(empty) == 2


def test_held_out_labels_and_other_columns_change_nothing(spark, small):
    docs, labels = small
    from pyspark.sql import functions as F

    flipped = labels.withColumn("quality", F.when(quality.fold(F.col("doc_id")) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("q"))
    first, second = quality.fit(docs, labels, training_rows=64), quality.fit(other, flipped, training_rows=64)
    assert first.bias == second.bias and (first.weights == second.weights).all() and (first.factors == second.factors).all()


def test_nothing_to_learn_from(spark, small):
    docs, labels = small
    assert quality.fit(docs, labels.limit(0)) is None and quality.fit(docs.limit(0), labels) is None
    found = quality.score(docs.withColumn("score", docs.doc_id), None).select("score", "predicted").distinct().collect()
    assert [tuple(row) for row in found] == [(0.5, 0)]
    assert quality.score(docs.limit(0), None).count() == 0
    one_kind = quality.fit(docs, labels.filter("quality = 1"))
    assert {row.predicted for row in quality.score(docs, one_kind).select("predicted").collect()} == {1}


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = QUERIES["op13_factorisation_machine"](spark, sf_dir)
    assert found.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    truth = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = found.filter("held_out").join(truth, "doc_id").collect()
    assert sum(row.predicted == row.quality for row in rows) >= 0.95 * len(rows) > 50
    clean = [row.predicted for row in rows if row.quality == 1]
    assert sum(clean) >= 0.97 * len(clean)
