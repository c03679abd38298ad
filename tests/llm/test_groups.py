import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from affinary.llm import jaccard_join, near_vectors
from affinary.llm.components import connected_components, smallest_reached, sorted_groups
from affinary.llm.shingles import shingle_sets


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    random = np.random.default_rng(seed)
    links = [tuple(map(int, pair)) for pair in random.integers(0, 150, (90, 2))] + [(i, i + 1) for i in range(500, 560)] + [(900, i) for i in range(901, 950)]
    expected = roots({n for e in links for n in e}, links)
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {n: found.get(n, n) for n in expected} == expected
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_smallest_reached():
    assert smallest_reached(6, np.array([4, 2, 5]), np.array([2, 0, 5])).tolist() == [0, 1, 0, 3, 0, 5]


def test_sorted_groups_across_batches():
    keys = np.repeat([1, 2, 3, 5], [3, 1, 6, 2])
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[a:b]), pa.array(range(a, b))], ["k", "v"]) for a, b in [(0, 2), (2, 5), (5, 5), (5, 10), (10, 12)]]
    groups = [(g.column(0)[0].as_py(), g.column(1).to_pylist()) for g in sorted_groups(batches, 1)]
    assert groups == [(1, [0, 1, 2]), (2, [3]), (3, [4, 5, 6, 7, 8, 9]), (5, [10, 11])]


def plain_set(text, words=3):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0d]+", lowered)
    return frozenset(zip(*[found[j:] for j in range(words)])) if len(found) >= words else frozenset([tuple(found)] if found else [])


def test_shingle_sets_match_plain(words):
    texts = [None, "", " ", "One", "one  TWO", "a b c", "a b c a b c a b c", "É é\u00a0x y\tz\x0bq", words(5000, 1), "x" * 3_000_000 + " y z", *[words(i, i) for i in range(50)]]
    for size in (3, 5):
        found = list(shingle_sets(pa.array(texts, pa.string()), size))
        assert [len(s) for s in found] == [len(plain_set(t, size)) for t in texts]
    sets = [set(s.tolist()) for s in shingle_sets(pa.array(["A b c d", "a B c d", "b c d", "c b a", "a b", "ab"]), 3)]
    assert sets[0] == sets[1] and sets[2] < sets[0] and not sets[3] & sets[0] and sets[4] != sets[5]


def edited(text, count, random):
    parts = text.split(" ")
    for place in random.integers(0, len(parts), count):
        parts[place] = f"new{random.integers(1 << 30)}"
    return " ".join(parts)


def corpus(words):
    """Groups of copies, chains of near copies, a passage that many documents share, short and odd texts."""
    random = np.random.default_rng(3)
    rows, passage = [], words(60, 999)
    for i in range(60):
        rows.append((i, words(int(random.integers(5, 200)), i)))
    for i in range(60, 140):
        rows.append((i, passage + " " + words(int(random.integers(1, 90)), i)))
    for base in range(8):
        text = words(120 + 40 * base, 500 + base)
        for j in range(25):
            rows.append((1000 + 100 * base + j, edited(text, j % 6, random)))
        for j in range(10):
            text = edited(text, 2, random)
            rows.append((1050 + 100 * base + j, text))
    rows += [(5000 + i, "Copy of a text with some words in it") for i in range(40)]
    rows += [(6000, None), (6001, ""), (6002, " \n"), (6003, "one"), (6004, "ONE"), (6005, "one two"), (None, "one"), (6003, "one"), (6100, words(20000, 42)), (6101, words(20000, 42) + " end")]
    return rows


def plain_components(rows, percent, words):
    sets = {}
    for doc_id, text in rows:
        if doc_id is not None:
            sets[doc_id] = plain_set(text, words)
    ids = sorted(sets)
    links = []
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links.append((i, j))
    return {i: (len(sets[i]), c) for i, c in roots(ids, links).items()}


@pytest.mark.parametrize("percent, words_each, options", [(90, 3, {}), (90, 3, {"most_sets": 12}), (80, 5, {}), (80, 5, {"most_sets": 8, "most_shingles": 2000})])
def test_jaccard_join_matches_plain(documents, words, percent, words_each, options):
    rows = corpus(words)
    expected = plain_components(rows, percent, words_each)
    result = jaccard_join.components_of(documents(rows), percent=percent, words=words_each, **options).collect()
    assert len(result) == len(rows)
    for r in result:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id]


def test_jaccard_join_of_empty_table(documents):
    assert jaccard_join.components_of(documents([])).count() == 0
    assert [(r.n_shingles, r.component_id) for r in jaccard_join.components_of(documents([(3, None)])).collect()] == [(0, 3)]


def test_bit_map_holds_hash_zero(spark, documents, words, monkeypatch):
    monkeypatch.setattr(jaccard_join, "_BITS", 64)
    hashed = spark.range(4000).selectExpr("id", "pmod(xxhash64(id), 64) bit").collect()
    ids = sorted(r.id for r in hashed if r.bit == 0)[:3] + sorted(r.id for r in hashed if r.bit == 63)[:2]
    text = words(80, 5)
    rows = [(i, text + f" end{n}") for n, i in enumerate(ids)] + [(9000, words(80, 6))]
    found = {r.doc_id: r.component_id for r in jaccard_join.components_of(documents(rows)).collect()}
    assert found == {**dict.fromkeys(ids, min(ids)), 9000: 9000}
    pages = jaccard_join._bit_map(spark.createDataFrame([(i,) for i in ids], "node bigint"))
    assert np.flatnonzero(np.unpackbits(pages, bitorder="little")).tolist() == [0, 63]


@pytest.mark.parametrize("percent", [70, 80, 90, 97])
def test_linked_sets_share_a_cell(percent):
    """The promise of the first step, at sizes around the bounds of levels and with the most differences allowed."""
    random = np.random.default_rng(percent)
    table = jaccard_join.class_table(percent)
    for n in [9, 10, 13, 20, 50, 99, 100, 101, 150, 400, 1000]:
        for _ in range(20):
            base = random.integers(0, 1 << 62, 2 * n).astype(np.uint64)
            shared = int(random.integers(1, n + 1))
            a, b = base[:n], np.concatenate([base[:shared], base[n : n + int(random.integers(0, n // 3 + 1))]])
            common = shared
            if 100 * common < percent * (len(a) + len(b) - common) or len(a) == len(b) == common:
                continue
            assert set(jaccard_join.cells_of(a, percent, table).tolist()) & set(jaccard_join.cells_of(b, percent, table).tolist())
            i, _ = jaccard_join.candidates([jaccard_join.counts_of(a), jaccard_join.counts_of(b)], np.array([len(a), len(b)]), np.array([0]), np.array([1]), percent)
            assert len(i)


def plain_vectors(rows, least=0.98):
    usable = {}
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None or any(v is None or not np.isfinite(v) for v in vector) or not any(vector):
            continue
        v = np.array(vector, dtype=float)
        usable.setdefault(vec_id, []).append((label, v / np.linalg.norm(v)))
    flat = [(i, *item) for i, items in usable.items() for item in items]
    counts, links = defaultdict(int), []
    for n, (i, li, vi) in enumerate(flat):
        for m, (j, lj, vj) in enumerate(flat):
            if n != m and li == lj and len(vi) == len(vj) and vi @ vj >= least:
                counts[n] += 1
                links.append((i, j))
    parts = roots(set(usable), links)
    return {i: parts[i] for i in usable}, {i: counts[n] for n, (i, _, _) in enumerate(flat)}


def vector_rows():
    random = np.random.default_rng(1)
    rows = []
    for group in range(12):
        centre = random.normal(size=16)
        for _ in range(int(random.integers(1, 30))):
            rows.append((len(rows), (centre + random.normal(size=16) * random.choice([0, 0.02, 0.05, 0.09])).astype(np.float32).tolist(), group % 3))
    hot = random.normal(size=16).astype(np.float32).tolist()
    rows += [(len(rows) + i, hot, 1) for i in range(40)]
    n = 10_000
    rows += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [float("nan")] * 16, 1), (n + 3, [None] + [1.0] * 15, 1), (n + 4, hot, None), (n + 5, [1.0, 2.0], 1), (n + 6, [2.0, 4.0], 1), (n + 7, [], 1)]
    rows += [(None, hot, 1), (n + 8, [float("inf")] + [1.0] * 15, 1), (n + 9, [v * 1e30 for v in hot], 1)]
    return rows


@pytest.mark.parametrize("block", [512, 6])
def test_near_vectors_match_plain(spark, block):
    rows = vector_rows()
    frame = spark.createDataFrame([(*row, "x") for row in rows], "vec_id bigint, embedding array<float>, label int, rep string")
    parts, counts = plain_vectors(rows)
    result = near_vectors.near_vectors(frame, block=block).collect()
    assert len(result) == len(rows)
    for r in result:
        assert (r.n_links, r.component_id) == (counts.get(r.vec_id, 0), parts.get(r.vec_id, r.vec_id)), r
        assert r.kept == (r.vec_id == r.component_id)
    assert near_vectors.near_vectors(frame.limit(0)).count() == 0
