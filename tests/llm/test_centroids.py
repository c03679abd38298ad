from hashlib import sha256
from math import floor, inf, isfinite, nan

import numpy as np
import pytest
from pyspark.sql import types as T

from affinary.llm import centroids
from affinary.llm.queries import ORACLE, QUERIES

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("v", T.StringType()),
        T.StructField("cluster", T.StringType()),
        T.StructField("distance", T.StringType()),
    ]
)


def table(spark, rows):
    return spark.createDataFrame([(i, v, None, "x", "y", "z") for i, v in rows], SCHEMA)


def plain(rows, clusters, rounds, size):
    kept = [(i, [floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and isfinite(x) for x in v)]
    order = sorted((sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    middle = [v for _, v in order[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middle))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        middle = [[sum(col) // len(groups[c]) for col in zip(*groups[c])] if c in groups else m for c, m in enumerate(middle)]
    found = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    by = {c: sum(d for _, k, d in found if k == c) for _, c, _ in found}
    names = [sha256(",".join(map(str, m)).encode()).hexdigest() for m in middle]
    return sorted(((i, c, d, by[c], sum(by.values()), names[c]) for i, c, d in found), key=str)


def test_hadamard_rows_are_orthogonal_and_ordered():
    made = centroids.hadamard(64)
    assert (made @ made.T == 64 * np.eye(64)).all() and (made == made.T).all()
    assert [int((row[1:] != row[:-1]).sum()) for row in made] == list(range(64))
    with pytest.raises(ValueError):
        centroids.hadamard(48)


@pytest.mark.parametrize("size,largest", [(1, 9), (8, 3), (64, 40), (64, centroids.LARGEST)])
def test_nearest_is_exact_with_ties(size, largest):
    random = np.random.default_rng(size)
    rows = random.integers(-largest, largest + 1, (400, size))
    middle = np.concatenate([rows[:7], rows[:3], random.integers(-largest, largest + 1, (6, size))])
    middle[12] = -middle[0]
    exact = ((rows[:, None, :] - middle[None]).astype(object) ** 2).sum(axis=2)
    cluster, distance, dropped = centroids.nearest(rows, middle)
    assert distance.tolist() == exact.min(axis=1).tolist()
    assert cluster.tolist() == [list(row).index(min(row)) for row in exact]
    assert size < 8 or dropped > 0


def test_progressive_search_drops_most_centroids():
    """Vectors near their centroid are settled by the first coefficients."""
    random = np.random.default_rng(1)
    middle = random.integers(-60, 60, (16, 64)).cumsum(axis=1) // 8
    rows = middle[random.integers(0, 16, 500)] + random.integers(-2, 3, (500, 64))
    assert centroids.nearest(rows, middle)[2] > 0.9 * 500 * 15


@pytest.mark.parametrize("seed", range(3))
def test_cluster_matches_plain(spark, seed):
    random = np.random.default_rng(seed)
    made = [(int(i), [float(x) for x in random.integers(-3, 4, 4) / 4]) for i in range(120)]
    made += [(i, made[5][1]) for i in range(200, 260)]  # a group of equal vectors
    found = centroids.cluster(table(spark, made), clusters=5, rounds=3, dimensions=4)
    assert sorted(map(tuple, found.collect()), key=str) == plain(made, 5, 3, 4)


def test_odd_rows(spark):
    made = [(1, None), (2, []), (3, [1.0, None, 0.0, 0.0]), (4, [nan, 0.0, 0.0, 0.0]), (5, [inf, 0.0, 0.0, 0.0]), (6, [1.0, 2.0, 3.0]), (7, [1.0] * 5)]
    good = [(8, [0.0] * 4), (9, [0.5, -0.5, 0.001, -0.001]), (9, [0.25] * 4), (10, [0.5, -0.5, 0.001, -0.001]), (None, [0.1] * 4)]
    found = centroids.cluster(table(spark, made + good), clusters=3, dimensions=4)
    assert sorted(map(tuple, found.collect()), key=str) == plain(made + good, 3, 3, 4)
    few = centroids.cluster(table(spark, good[:1]), clusters=16, dimensions=4).collect()
    assert [tuple(row)[:5] for row in few] == [(8, 0, 0, 0, 0)]
    nothing = centroids.cluster(table(spark, made), dimensions=4)
    assert nothing.count() == 0 and nothing.columns == centroids.cluster(table(spark, good), dimensions=4).columns
    assert centroids.cluster(table(spark, [(None, [0.1] * 4)]), dimensions=4).count() == 0
    assert centroids.cluster(table(spark, []), dimensions=4).count() == 0


def test_huge_components_are_held(spark):
    made = [(i, [s * x, 0.0, x, 1.0]) for i, (s, x) in enumerate([(1, 1e308), (-1, 1e308), (1, 1e20), (-1, 3e18), (1, 0.5)])]
    found = {row.vec_id: row for row in centroids.cluster(table(spark, made), clusters=2, dimensions=4).collect()}
    assert set(found) == set(range(5)) and found[0].cluster == found[2].cluster and all(row.distance >= 0 for row in found.values())
    assert found[0].distance == found[2].distance


def test_query_matches_sql(spark):
    from oracle import connect, differences

    sf_dir = "/root/testdata/sf0.001"
    name = "op12_hadamard_clustering"
    problems = differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name])
    assert [p for p in problems if p.startswith("!")] == []
