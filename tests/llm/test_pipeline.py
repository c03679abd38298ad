"""The registered queries and the pipeline on the smallest tables."""

import pytest
from test_groups import plain_components

import corpus_pipeline
from affinary.llm import secret_spans
from affinary.llm.queries import QUERIES
from affinary.sources.scratch import materialize

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op2": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op3": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op4": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op5": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op6": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op7": {"length": "bigint", "n_docs": "bigint", "truncated_total": "bigint", "share_up_to": "double"},
    "op8": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op9": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op10": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op11": {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"},
    "op12": {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"},
    "op13": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
}


def test_all_numbers_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == set(COLUMNS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_returns_its_columns(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    kinds = dict(df.dtypes)
    for column, kind in COLUMNS[name.split("_")[0]].items():
        assert kinds[column] == kind
    table = {"op2": "pages", "op9": "pages", "op6": "embeddings", "op12": "embeddings"}.get(name.split("_")[0], "documents")
    if not name.startswith(("op7_", "op8_", "op11_")):
        assert df.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, dtypes = docs.columns, docs.dtypes
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        out = materialize(stage(spark, docs, SF_DIR), f"test-{name}")
        rows = out.collect()
        if number < 4:
            assert out.columns == columns and out.dtypes == dtypes
            assert all(r.doc_id in before for r in rows)
        if name == "language_id":
            assert len(rows) >= 0.97 * len(before)
            assert all(r == before[r.doc_id] for r in rows if before[r.doc_id].lang)
        if name == "near_duplicates":
            groups = plain_components([(i, r.text) for i, r in before.items()], 80, 5)
            assert {r.doc_id for r in rows} == {i for i, (_, c) in groups.items() if i == c}
        if name == "secrets":
            assert len(rows) == len(before)
            assert all(not secret_spans.find_spans(r.text) and r.n_chars == len(r.text) for r in rows)
            leaking = {i for i, r in before.items() if secret_spans.find_spans(r.text)}
            assert all(("[SECRET]" in r.text) if r.doc_id in leaking else r == before[r.doc_id] for r in rows)
        if name == "packing":
            assert {r.doc_id for r in rows} == set(before)
        docs = out


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


def test_odd_rows_pass_all_stages(spark, documents, words):
    given = [(i, words(30, i), "en", "s") for i in range(40)] + [(50, None, None, None), (51, "", "fr", "s"), (None, words(30, 99), None, None), (3, words(30, 3), "en", "s"), (60, "- - -", None, "t")]
    docs = documents(given)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF_DIR), f"odd-{name}")
    assert docs.count() > 0
    empty = documents([])
    for name, stage in corpus_pipeline.STAGES:
        empty = materialize(stage(spark, empty, SF_DIR), f"none-{name}")
    assert empty.count() == 0


def test_repeated_ids_lose_no_text(spark, documents, words):
    a, b, c = words(60, 1), words(60, 2), words(60, 3)
    stage = corpus_pipeline.one_of_each_group
    twice = documents([(5, a), (5, a), (5, a, None, "s"), (6, ""), (6, ""), (None, c), (None, c)])
    assert sorted((r.doc_id or 0, r.text) for r in stage(spark, twice, SF_DIR).collect()) == [(0, c), (0, c), (5, a), (6, "")]
    shared = documents([(3, a), (7, a), (7, b), (7, b), (8, b + " end"), (9, None), (9, c), (9, c.upper()), (11, a + " end")])
    kept = stage(spark, shared, SF_DIR)
    assert kept.columns == shared.columns
    found = sorted((r.doc_id, (r.text or "").lower()) for r in kept.collect())
    assert found == sorted([(3, a), (7, b), (9, ""), (9, c)])


def test_columns_of_any_name_go_through(spark, documents, words):
    """Names that stages use inside, as columns of the documents."""
    from pyspark.sql import functions as F

    docs = documents([(i, words(30, i), "en", "s") for i in range(30)] + [(3, words(30, 3), "en", "s"), (4, words(9, 400), None, None)])
    names = ["_found", "_score", "_text", "_id", "id", "own", "found", "score", "row", "given", "place", "first", "copies", "component_id", "number", "slot", "kept"]
    docs = docs.withColumns({name: F.lit(name) for name in names})
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = materialize(stage(spark, docs, SF_DIR), f"names-{name}")
        rows = docs.collect()
        assert set(names) <= set(docs.columns) and rows and all(row[n] == n for row in rows for n in names)


def test_junk_goes_at_the_first_stage(spark, documents):
    import numpy as np

    random = np.random.default_rng(3)
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    junk = ["".join(map(chr, random.integers(33, 127, 500))) for _ in range(8)] + ["".join(map(chr, random.integers(0x410, 0x450, 300))) for _ in range(8)]
    docs = documents([tuple(row) for row in given] + [(10**9 + i, text, None, "junk") for i, text in enumerate(junk)])
    kept = {row.doc_id: row for row in corpus_pipeline.in_one_language(spark, docs, SF_DIR).collect()}
    assert sum(10**9 + i in kept for i in range(16)) <= 1
    clean = [row for row in given if row.text and any(map(str.isalpha, row.text))]
    assert sum(row.doc_id in kept for row in clean) >= 0.998 * len(clean)
