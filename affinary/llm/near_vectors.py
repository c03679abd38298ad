"""Near-duplicate vectors by p-stable hashing, with an exact check.

Unit vectors are projected on ``width``-quantised random normal directions; ``projections``
of them make a key, and each of ``tables`` tables buckets by its own key.  Two vectors with
cosine 0.98 lie 0.2 apart and share a bucket of some table with probability 0.998 for the
defaults; pairs that do are compared by their cosine in double precision, so no pair below
the bound is linked.

Equal vectors of a label are one class.  A bucket is dealt into blocks of at most ``block`` classes
and every pair of its blocks is one small task group, so a bucket may hold any share of the rows;
products of blocks are counted and joined inside the task, pairs are never rows.  A pair that
meets in several tables is counted in the first.

Vectors that are null, zero, or hold null or non-finite components, and rows with a null
label or id, link with nothing.  Vectors of different lengths are not compared.  An id is
taken to name one vector; repeated rows count as vectors of their own with the same id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinary.llm.components import connected_components, smallest_reached, sorted_groups
from affinary.sources.scratch import materialize


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of equal length as unit vectors in double precision."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    # scaled first: squares of large or tiny components would leave the range
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def hash_keys(units: np.ndarray, projections: int, tables: int, width: float, seed: int) -> np.ndarray:
    """(rows, tables): a key per table."""
    random = np.random.default_rng([seed, units.shape[1]])
    directions = random.normal(size=(units.shape[1], projections * tables))
    shifts = random.uniform(0, width, projections * tables)
    cells = np.floor((units @ directions + shifts) / width).astype(np.int64).astype(np.uint64)
    cells = cells.reshape(len(units), tables, projections)
    keys = np.zeros((len(units), tables), dtype=np.uint64)
    for j in range(projections):
        keys = (keys ^ cells[:, :, j]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def near_vectors(
    vectors: DataFrame,
    least: float = 0.98,
    projections: int = 10,
    tables: int = 24,
    width: float = 1.2,
    block: int = 512,
    seed: int = 11,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    value = F.col("embedding").cast("array<double>")
    is_finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = value.isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull() & is_finite & F.exists(value, lambda x: x != 0)
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.xxhash64("label").alias("label"),
        value.alias("vector"),
        F.coalesce(usable, F.lit(False)).alias("usable"),
    )
    exact = [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(seed), "vector", F.size("vector")).alias("h2")]
    good = rows.filter("usable").select("vec_id", "label", "vector", *exact)
    classes = good.groupBy("label", "h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("vector").alias("vector")
    )

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(6)
            lengths = column.value_lengths().to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                same = batch.filter(pa.array(lengths == length))
                if not len(same):
                    continue
                keys = hash_keys(_matrix(same.column(6)), projections, tables, width, seed)
                flat = pa.array(keys.ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(same) + 1, dtype=np.int32) * tables), flat)
                yield pa.RecordBatch.from_arrays([*same.columns, lists], [*same.schema.names, "keys"])

    columns = ["label", "h1", "h2", "rep", "n", "size", "vector"]
    sized = classes.withColumn("size", F.size("vector").cast("bigint")).select(*columns)
    schema = "label bigint, h1 bigint, h2 bigint, rep bigint, n bigint, size bigint, vector array<double>, keys array<bigint>"
    classes = materialize(sized.mapInArrow(keyed, schema), "vector-classes")

    entries = classes.select("rep", "label", "h1", "h2", "size", F.posexplode("keys").alias("table", "key"))
    entries = entries.select("rep", "label", "h1", "h2", "table", F.xxhash64("label", "size", "table", "key").alias("bucket"))
    full = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    blocks = F.ceil(F.col("members") / block).cast("bigint")
    # sizes of exploded rows are underestimated, so joins by sorting are asked for
    placed = entries.join(full.hint("merge"), "bucket").select("*", blocks.alias("blocks"), F.pmod(F.xxhash64("rep", F.lit(seed)), blocks).alias("mine"))
    dealt = placed.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select(
        "bucket", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "table", "label", "h1", "h2"
    )
    told = classes.select("label", "h1", "h2", "rep", "n", "size", "vector", "keys").hint("merge")
    tasks = dealt.join(told, ["label", "h1", "h2"]).select(
        "bucket", "low", "high", F.col("mine"), F.col("table").cast("bigint").alias("table"), "label", "size", "rep", "n", "keys", "vector"
    )
    tasks = tasks.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        waiting = 0

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(np.concatenate([part[i] for part in out])) for i in range(3)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, ["rep", "links", "root"])

        for group in sorted_groups(batches, 3):
            found = _links_of_group(group, least, tables)
            if found is not None:
                out.append(found)
                waiting += len(found[0])
                if waiting > 50_000:
                    yield flush()
                    waiting = 0
        if out:
            yield flush()

    links = materialize(tasks.mapInArrow(compared, "rep bigint, links bigint, root bigint"), "vector-links")
    parts = connected_components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    direct = links.groupBy("rep").agg(F.sum("links").alias("links"))
    about = classes.select("label", "h1", "h2", "rep", "n").join(direct, "rep", "left").join(
        parts.withColumnRenamed("node", "rep"), "rep", "left"
    )
    named = rows.select("vec_id", "usable", "label", *exact)
    joined = named.join(about, ["label", "h1", "h2"], "left")
    n_links = F.when(F.col("usable"), F.coalesce("links", F.lit(0)) + F.col("n") - 1).otherwise(0)
    component = F.when(F.col("usable"), F.coalesce("component", "rep")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id",
        n_links.cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _links_of_group(group: pa.Table, least: float, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(rep, links, root) of the classes in two blocks of a bucket that are linked; None if none is."""
    low, high = group.column(1)[0].as_py(), group.column(2)[0].as_py()
    mine, table, label, size = (group.column(i).to_numpy() for i in range(3, 7))
    if len(mine) < 2:
        return None
    reps, counts = group.column(7).to_numpy(), group.column(8).to_numpy()
    if (label != label[0]).any() or (size != size[0]).any() or (table != table[0]).any():
        # two buckets with one number: each on its own
        kinds = {key: None for key in zip(label.tolist(), size.tolist(), table.tolist())}
        parts = []
        for key in kinds:
            same = (label == key[0]) & (size == key[1]) & (table == key[2])
            parts.append(_links_of_group(group.filter(pa.array(same)), least, tables))
        parts = [part for part in parts if part is not None]
        return tuple(np.concatenate([part[i] for part in parts]) for i in range(3)) if parts else None  # type: ignore[return-value]
    units = _matrix(group.column(10))
    left = np.flatnonzero(mine == low)
    right = np.flatnonzero(mine == high)
    hits = units[left] @ units[right].T >= least
    if low == high:
        hits = np.triu(hits, 1)
    i, j = np.nonzero(hits)
    if not len(i):
        return None
    i, j = left[i], right[j]
    keys = group.column(9).combine_chunks().flatten().to_numpy().reshape(-1, tables)
    earlier = (keys[i, : table[0]] == keys[j, : table[0]]).any(axis=1)
    i, j = i[~earlier], j[~earlier]
    if not len(i):
        return None
    links = np.bincount(i, counts[j], minlength=len(reps)) + np.bincount(j, counts[i], minlength=len(reps))
    order = np.argsort(reps, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    linked = np.flatnonzero(links > 0)
    roots = reps[order[smallest_reached(len(reps), rank[i], rank[j])[rank[linked]]]]
    return reps[linked], links[linked].astype(np.int64), roots
