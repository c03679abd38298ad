"""Centroid clustering of integer vectors, with an exact progressive nearest-centroid search.

Components become ``floor(scale * x)``.  The Walsh-Hadamard transform keeps distances up to the factor
``dimensions``, is exact in integers, and gathers what neighbouring components share in its first (lowest sequency)
coefficients.  So the squared coefficient differences are added up coarse to fine: after each step a
centroid whose sum already exceeds the whole distance of some other centroid is dropped (strictly worse, so
no tie is lost), and those that stay are added up over all coefficients.

Every round reads the staged integer vectors once; a task returns one row per cluster with its sums, and
the driver reads ``clusters`` rows of ``dimensions`` sums.  Nothing else grows with the data on the driver.

Kept are vectors of exactly ``dimensions`` components, none null or NaN or infinite.  Integers are held to
-LARGEST..LARGEST (components beyond 262,144 in size at scale 64 count as that), within which all sums are exact.
Rows that repeat an id count as vectors of their own; among equal hashes the smaller vector seeds first.
Rows without id are clustered but seed nothing.  With fewer vectors than clusters there are as many
clusters as vectors that seed; an empty table, or one where none seeds, gives no rows.
Extra columns are not read.  Sums of distances beyond the largest long stay at it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinary.llm.slices import small_batches
from affinary.sources.scratch import materialize

LARGEST = 1 << 24  # 64 squared differences of transformed components then fit 63 bits
STEPS = (4, 4, 8, 16)  # coefficients added before centroids are dropped; the rest follows
_LONGEST = (1 << 63) - 1


def hadamard(dimensions: int) -> np.ndarray:
    """The symmetric Walsh-Hadamard matrix, rows ordered by sequency (number of sign changes)."""
    if dimensions & (dimensions - 1):
        raise ValueError("the transform needs a power of two")
    made = np.ones((1, 1), dtype=np.int64)
    while len(made) < dimensions:
        made = np.block([[made, made], [made, -made]])
    changes = (made[:, 1:] != made[:, :-1]).sum(axis=1)
    return made[np.argsort(changes, kind="stable")]


def transform(vectors: np.ndarray) -> np.ndarray:
    """Coefficients of integer rows, exact: their size stays below 2^31, so doubles hold every partial sum."""
    matrix = hadamard(vectors.shape[1]).astype(np.float64)
    return (vectors.astype(np.float64) @ matrix.T).astype(np.int64)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each row's nearest centroid (ties: the smaller number), and how many
    centroids were dropped before all coefficients were added."""
    rows, dimensions = vectors.shape
    coefficients, targets = transform(vectors), transform(centroids)
    row = np.repeat(np.arange(rows), len(centroids))
    candidate = np.tile(np.arange(len(centroids)), rows)
    sums = np.zeros(len(row), dtype=np.int64)
    bound = np.full(rows, _LONGEST)
    begin, dropped = 0, 0
    for width in STEPS:
        end = min(dimensions, begin + width)
        sums += _squares(coefficients, targets, row, candidate, begin, end)
        begin = end
        if begin >= dimensions:
            break
        # the whole distance of the candidate that leads so far is a bound for the others
        order = np.lexsort((sums, row))
        leads = order[np.unique(row[order], return_index=True)[1]]
        whole = sums[leads] + _squares(coefficients, targets, row[leads], candidate[leads], begin, dimensions)
        np.minimum.at(bound, row[leads], whole)
        stays = sums <= bound[row]
        dropped += int((~stays).sum())
        row, candidate, sums = row[stays], candidate[stays], sums[stays]
    if begin < dimensions:
        sums += _squares(coefficients, targets, row, candidate, begin, dimensions)
    order = np.lexsort((candidate, sums, row))
    best = order[np.unique(row[order], return_index=True)[1]]
    return candidate[best], sums[best] // dimensions, dropped


def _squares(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, begin: int, end: int) -> np.ndarray:
    part = left[i, begin:end] - right[j, begin:end]
    return np.einsum("ij,ij->i", part, part)


def _integers(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def integer_vectors(vectors: DataFrame, dimensions: int = 64, scale: int = 64) -> DataFrame:
    """(vec_id, v) of the kept vectors."""
    value = F.col("embedding").cast("array<double>")
    is_finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.filter(value.isNotNull() & (F.size(value) == dimensions) & is_finite)
    largest = F.lit(float(LARGEST))
    held = F.transform(value, lambda x: F.greatest(-largest, F.least(largest, F.floor(x * scale).cast("double"))).cast("bigint"))
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), held.alias("v"))


def seeds(vectors: DataFrame, clusters: int, prefix: str = "1:") -> np.ndarray:
    """The vectors whose hashed ids are smallest, in the order of the hashes."""
    digest = F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = vectors.filter("vec_id is not null").select(digest.alias("digest"), "v").orderBy("digest", "v").limit(clusters)
    return np.array([row["v"] for row in first.collect()], dtype=np.int64)


def updated(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids moved to the floors of their vectors' means; one that has none stays."""
    clusters, dimensions = centroids.shape

    def totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((clusters, dimensions), dtype=np.int64)
        counts = np.zeros(clusters, dtype=np.int64)
        for batch in small_batches(batches, 4096):
            if not len(batch):
                continue
            rows = _integers(batch.column(0), dimensions)
            cluster, _, _ = nearest(rows, centroids)
            counts += np.bincount(cluster, minlength=clusters)
            for number in np.unique(cluster):
                sums[number] += rows[cluster == number].sum(axis=0)
        used = np.flatnonzero(counts)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1, dtype=np.int32) * dimensions), pa.array(sums[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used]), lists], ["cluster", "n", "sums"])

    parts = vectors.select("v").mapInArrow(totals, "cluster bigint, n bigint, sums array<bigint>")
    # a task's sums fit 63 bits, those of all tasks may not
    each = [F.sum(F.col("sums")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(dimensions)]
    moved = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *each).collect():
        moved[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dimensions)]
    return moved


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    dimensions = centroids.shape[1]

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 4096):
            if len(batch):
                cluster, distance, _ = nearest(_integers(batch.column(1), dimensions), centroids)
                columns = [batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return vectors.select("vec_id", "v").mapInArrow(found, "vec_id bigint, cluster int, distance bigint")


def cluster(vectors: DataFrame, clusters: int = 16, rounds: int = 3, dimensions: int = 64, scale: int = 64) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    spark = vectors.sparkSession
    staged = materialize(integer_vectors(vectors, dimensions, scale), "integer-vectors")
    centroids = seeds(staged, clusters)
    if not len(centroids):
        nothing = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return spark.createDataFrame([], nothing)
    for _ in range(rounds):
        centroids = updated(staged, centroids)
    rows = materialize(assigned(staged, centroids), "assigned-vectors")
    totals = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("inertia")).collect()
    whole = min(_LONGEST, int(sum(row["inertia"] for row in totals)))
    named = [sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]
    about = [(row["cluster"], min(_LONGEST, int(row["inertia"])), whole, named[row["cluster"]]) for row in totals]
    told = spark.createDataFrame(about, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # one row per cluster
    return rows.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
