from itertools import islice
from math import floor, inf, isfinite, nan

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinary.llm import hard_negatives
from affinary.llm.queries import ORACLE, QUERIES

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("label", T.IntegerType()),
        *[T.StructField(name, T.StringType()) for name in ("v", "key", "cell", "list", "anchor", "score")],
    ]
)


def table(spark, rows):
    return spark.createDataFrame([(*row, *"abcdef") for row in rows], SCHEMA)


def plain(rows, every, positives, negatives, low=80, high=100):
    kept = [(i, label, [floor(256 * x) for x in v]) for i, v, label in rows if None not in (i, v, label) and v and all(x is not None and isfinite(x) for x in v)]
    kept = [key for key in dict.fromkeys((i, label, tuple(v)) for i, label, v in kept)]
    found = []
    for a, label, v in kept:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, own == label) for i, own, w in kept if i != a and len(w) == len(v))
        for score, positive, _ in [row for row in scored if row[2]][:positives]:
            inside = [row for row in scored if not row[2] and low * -score <= 100 * -row[0] <= high * -score]
            found += [(a, positive, rank, i, -score, -s) for rank, (s, i, _) in enumerate(inside[:negatives], 1)]
    return sorted(found)


def mined(spark, rows, **options):
    return sorted(map(tuple, hard_negatives.hard_negatives(table(spark, rows), **options).collect()))


def test_cells_come_in_order_of_their_bounds():
    random = np.random.default_rng(0)
    rows = random.normal(size=(300, 8))
    centres = hard_negatives.codebook(rows[:, :4], 6), hard_negatives.codebook(rows[:, 4:], 6)
    (i, r1), (j, r2) = hard_negatives._nearest(rows[:, :4], centres[0]), hard_negatives._nearest(rows[:, 4:], centres[1])
    radii = tuple(np.array([r[place == c].max(initial=0) for c in range(6)]) for place, r in ((i, r1), (j, r2)))
    cells = i * 6 + j
    order = hard_negatives.CellOrder(centres, radii, frozenset(cells.tolist()))
    anchor = rows[0]
    visits = list(order.visits(anchor))
    assert [cell for _, cell in visits] != sorted(cell for _, cell in visits) and {cell for _, cell in visits} == set(cells.tolist())
    assert all(a >= b for (a, _), (b, _) in zip(visits, visits[1:]))
    for bound, cell in visits:
        assert (rows[cells == cell] @ anchor).max() <= bound
    assert list(islice(order.visits(anchor), 3)) == visits[:3]


@pytest.mark.parametrize("seed,length,chunk", [(0, 6, 4096), (1, 6, 8), (2, 1, 16), (3, 7, 4096)])
def test_matches_plain_with_ties(spark, seed, length, chunk):
    random = np.random.default_rng(seed)
    rows = [(i, (random.integers(-3, 4, length) / 8).tolist(), int(random.integers(0, 3))) for i in range(160)]
    rows += [(i, rows[10][1], i % 3) for i in range(160, 200)]  # a group of equal vectors
    assert mined(spark, rows, every=10, entries=5, chunk=chunk) == plain(rows, 10, 5, 5)
    assert mined(spark, rows, every=25, entries=3, chunk=chunk, positives=2, negatives=9, low=50, high=90) == plain(rows, 25, 2, 9, 50, 90)


def test_search_stops_once_its_windows_are_certain(spark):
    """In far apart clusters, an anchor visits few cells."""
    random = np.random.default_rng(5)
    centres = random.normal(size=(12, 16)) * 4
    rows = [(i, (centres[i % 12] + random.normal(size=16) * 0.02).tolist(), i // 12 % 2) for i in range(600)]
    index_rows = hard_negatives.integer_rows(table(spark, rows))
    index = hard_negatives.MultiIndex(index_rows, 16, 12, 1000, 4096, 1)
    anchors = index.rows.filter("vec_id % 50 = 0").select("vec_id", "key", "label", "v", F.lit(0).alias("list"), F.lit(-(1 << 60)).alias("least"), F.lit(1 << 60).alias("most"))
    found = hard_negatives.search(index, anchors, same=True, count=5)
    last = {row.anchor: row.score for row in found.filter("rank = 5").collect()}
    for row in anchors.collect():
        needed = [bound for bound, _ in index.order.visits(np.array(row.v, dtype=float)) if bound >= last[row.vec_id]]
        assert len(needed) <= len(index.parts) / 4
    assert mined(spark, rows, every=50, entries=12) == plain(rows, 50, 5, 5)


def test_odd_rows(spark):
    good = [(i, [0.1 * (i % 7), -0.2, 0.3, 0.05 * i], i % 2) for i in range(0, 40)]
    odd = [
        (100, None, 1), (200, [], 1), (300, [0.1, None, 0.2, 0.3], 1), (400, [nan, 0.1, 0.1, 0.1], 1), (500, [inf, 0.1, 0.1, 0.1], 0),
        (600, [0.1] * 4, None), (None, [0.1] * 4, 1), (700, [0.5, 0.5], 1), (701, [0.4, 0.5], 1), (702, [0.5, 0.4], 0), (800, [0.0] * 4, 1),
        (10, good[10][1], 0), (10, good[10][1], 0), (20, [0.9] * 4, 1), (21, [0.9] * 4, 1), (-10, [0.3] * 4, 1), (900, [0.1] * 3, 1),
    ]
    assert mined(spark, good + odd, every=10, entries=4) == plain(good + odd, 10, 5, 5)
    assert mined(spark, good[:1], every=10) == [] and mined(spark, [], every=10) == [] and mined(spark, odd[:5]) == []
    huge = [(0, [1e300, 1.0], 0), (1, [1e300, 9.0], 0), (2, [1e299, 5.0], 1), (3, [-1e300, 0.0], 1)]
    assert [row[:4] for row in mined(spark, huge, every=100, entries=2)] == [(0, 1, 1, 2)]


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001"])
def test_query_matches_sql(spark, sf_dir):
    from oracle import connect, differences

    name = "op11_inverted_multi_index"
    problems = differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name])
    assert [p for p in problems if p.startswith("!")] == []
