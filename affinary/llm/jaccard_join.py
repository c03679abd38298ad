"""Exact join of documents by the Jaccard similarity of their shingle sets, in metric space.

The Jaccard distance is a metric, so a pivot's distances bound all others.  Most documents of
a corpus are as far from any pivot as can be, so regions are made in two steps.

1. *Cells.*  The shingles are cut into classes by hash.  Sets that are linked differ in at most
   ``d`` shingles, so of ``d + 1 + spare`` classes they agree in more than ``spare``, at least one of them
   not empty.  Every part of a set that lies in one class is a pivot of that class's
   space, and its cell holds the sets at distance zero from it.  (Sets with more than ``spare`` empty
   classes also share cells for these.)  Sets that no other set shares a cell with are done.
   Sets that meet in a cell are near candidates only if a lower bound of their distance allows it: counts
   of shingles by further hash classes differ in sum by no more than the sets do.  Sets connected by
   such candidates form one region: no link leaves it.
2. *Voronoi regions.*  A region too large for one task picks pivots among its documents.  Each
   document goes to its nearest pivot's region, and as a copy to every other region whose pivot is not
   more than 2 eps further away (two linked documents with different pivots meet there, by the triangle
   inequality).  Documents within eps of a pivot are linked by that, and stay only if their distance
   comes within eps of that of a document outside this ball.  Regions are split again as long as
   they shrink; one that doesn't is dealt into blocks, and every pair of blocks is joined.
3. *Leaves.*  A small region is joined exactly in one task: farthest-first pivots, then for
   every document only those whose distances to all pivots are within eps of its own and which no link
   has connected to it yet.

Equal sets are one node, so copies cost nothing; the result needs each link's effect, the component,
and never a row per pair.

Null and empty texts, and texts without words, have empty sets and link with nothing; null ids
link with nothing and have a null component; an id is taken to name one document (rows that repeat it
share its component); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import ceil, exp

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinary.llm.components import connected_components, smallest_reached, sorted_groups
from affinary.llm.shingles import mix, shingle_sets
from affinary.llm.slices import small_batches
from affinary.sources.scratch import materialize

_RATIO = 1.4  # of the largest to the smallest set size of a level
_DEPTH = 4  # times a region is split by pivots before it is dealt into blocks
_PIVOTS = 16  # of a region that is split
_CELL_BLOCK = 1024  # sets of a cell that one task group compares with as many others
_BITS = 1 << 26  # of the map of documents in regions that spares others the shuffle


def most_differing(left: int, right: int, percent: int) -> int:
    """How many shingles two linked sets of these sizes can have outside each other."""
    return (left + right) * (100 - percent) // (100 + percent)


def level_sizes(largest: int) -> list[int]:
    """Upper set sizes of the levels."""
    sizes = [8]
    while sizes[-1] < largest:
        sizes.append(int(sizes[-1] * _RATIO) + 1)
    return sizes


_LEVELS = np.array(level_sizes(1 << 40), dtype=np.int64)


def _classes(level: int, percent: int) -> tuple[int, int]:
    """(classes, spare) of a level; classes 0 if only equal sets are linked there.

    ``spare`` is above the number of empty classes that all but few sets of the level have.
    """
    size = int(_LEVELS[level])
    differing = most_differing(size, size, percent)
    if differing == 0:
        return 0, 0
    smallest = percent * (int(_LEVELS[level - 1]) + 1) / 100 if level else 1.0
    spare = 0
    for _ in range(50):
        classes = differing + 1 + spare
        empty = classes * exp(-smallest / classes)
        spare = min(differing + 1, ceil(empty + 3 * empty**0.5))
    return differing + 1 + spare, spare


def class_table(percent: int) -> list[tuple[int, int]]:
    """(classes, spare) of every level."""
    return [_classes(level, percent) for level in range(len(_LEVELS))]


def cells_of(hashes: np.ndarray, percent: int, table: list[tuple[int, int]]) -> np.ndarray:
    """The cells of a set: one number per class of its level, and of the next level if its partners may be there."""
    n = len(hashes)
    level = int(np.searchsorted(_LEVELS, n))
    levels = [level, level + 1] if 100 * n >= percent * (int(_LEVELS[level]) + 1) else [level]
    found = []
    mixed = mix(hashes ^ np.uint64(0xD6E8FEB86659FD93))
    inside = mix(mixed + np.uint64(1))
    for each in levels:
        classes, spare = table[each]
        if not classes:
            continue
        which = ((mixed >> np.uint64(32)) % np.uint64(classes)).astype(np.int64)
        sums = np.zeros(classes, dtype=np.uint64)
        np.add.at(sums, which, inside)
        is_full = np.bincount(which, minlength=classes) > 0
        cells = mix(sums + np.arange(classes, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(each << 40))
        found.append(cells[is_full] if classes - is_full.sum() <= spare else cells)
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)


def counts_of(hashes: np.ndarray) -> np.ndarray:
    """Shingles by hash class, at most 255 each; the number of classes is a power of two near an eighth of the set's size."""
    width = 32
    while width * 8 < len(hashes):
        width *= 2
    which = (mix(hashes ^ np.uint64(0xA24BAED4963EE407)) % np.uint64(width)).astype(np.int64)
    return np.minimum(np.bincount(which, minlength=width), 255).astype(np.uint8)


def candidates(counts: list[np.ndarray], sizes: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``left`` and ``right`` places whose counts allow a link."""
    width = min(map(len, counts))
    # folding a wider row of counts keeps the bound; the caps keep it too
    table = np.array([np.minimum(c.reshape(-1, width).sum(axis=0, dtype=np.int32), 255) for c in counts], dtype=np.int16)
    found = []
    step = max(1, (1 << 22) // (max(1, len(right)) * width))
    for begin in range(0, len(left), step):
        rows = left[begin : begin + step]
        apart = np.abs(table[rows][:, None, :] - table[right][None, :, :]).sum(axis=2, dtype=np.int32)
        allowed = (sizes[rows][:, None] + sizes[right][None, :]) * (100 - percent) // (100 + percent)
        i, j = np.nonzero(apart <= allowed)
        found.append((rows[i], right[j]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _describe(docs: DataFrame, percent: int, words: int) -> DataFrame:
    """(doc_id, n, k1, k2, counts): set size, two hashes of the set, and its shingles by class."""

    def described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sizes, firsts, seconds, counts = [], [], [], []
            for hashes in shingle_sets(batch.column(1), words):
                sizes.append(len(hashes))
                firsts.append(mix(hashes).sum(dtype=np.uint64))
                seconds.append(np.bitwise_xor.reduce(mix(hashes + np.uint64(77)), initial=np.uint64(0)))
                counts.append(counts_of(hashes).tobytes())
            columns = [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(np.array(firsts, dtype=np.uint64).view(np.int64)),
                pa.array(np.array(seconds, dtype=np.uint64).view(np.int64)),
                pa.array(counts, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "k1", "k2", "counts"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(described, "doc_id bigint, n bigint, k1 bigint, k2 bigint, counts binary")


def _cells(docs: DataFrame, percent: int, words: int) -> DataFrame:
    """(doc_id, cell) of every document."""
    table = class_table(percent)

    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            cells = [cells_of(hashes, percent, table) if len(hashes) else hashes for hashes in shingle_sets(batch.column(1), words)]
            ends = np.cumsum([0, *map(len, cells)], dtype=np.int32)
            flat = pa.array(np.concatenate(cells).view(np.int64)) if cells else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), flat)], ["doc_id", "cells"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text")).filter("doc_id is not null")
    return rows.mapInArrow(listed, "doc_id bigint, cells array<bigint>").select("doc_id", F.explode("cells").alias("cell"))


def _regions(docs: DataFrame, nodes: DataFrame, percent: int, words: int) -> DataFrame:
    """(node, region) of all nodes that may be linked; ``nodes``: (node, n, counts), one document per set."""
    # one shuffle of narrow rows serves both uses; a cell's rows lie together
    cells = _cells(docs, percent, words).repartition("cell").sortWithinPartitions("cell")

    def shared_only(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of cells with more than one row; only neighbours are compared."""
        last: pa.RecordBatch | None = None  # the last row, when it is not known yet whether its cell goes on
        last_cell, last_shared = None, False
        for batch in batches:
            cell = batch.column(1).to_numpy()
            if not len(cell):
                continue
            if last is not None and (last_shared or cell[0] == last_cell):
                yield last
            same = cell[1:] == cell[:-1]
            is_shared = np.zeros(len(cell), dtype=bool)
            is_shared[1:] |= same
            is_shared[:-1] |= same
            is_shared[0] |= cell[0] == last_cell
            held = batch.slice(len(cell) - 1, 1)
            last_shared = bool(is_shared[-1])
            last, last_cell = held, cell[-1]
            is_shared[-1] = False
            yield batch.filter(pa.array(is_shared))
        if last is not None and last_shared:
            yield last

    shared = cells.mapInArrow(shared_only, "doc_id bigint, cell bigint").withColumnRenamed("doc_id", "node")
    # copies of a set are in the same cells: only one of them goes on
    shared = materialize(shared.join(nodes.select("node"), "node", "left_semi").distinct(), "jaccard-cells")
    # near sets share many cells with the same members; one of these says all
    same = ["members", "least", "most", "h1", "h2"]
    full = shared.groupBy("cell").agg(
        F.count(F.lit(1)).alias("members"),
        F.min("node").alias("least"),
        F.max("node").alias("most"),
        F.bit_xor(F.xxhash64("node")).alias("h1"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("h2"),
    )
    full = full.filter("members > 1").groupBy(*same).agg(F.min("cell").alias("cell")).select("cell", "members")
    blocks = F.ceil(F.col("members") / _CELL_BLOCK).cast("bigint")
    placed = shared.join(full, "cell").select("cell", "node", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).alias("mine"))
    dealt = placed.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("cell", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "node")
    tasks = dealt.join(nodes.select("node", "n", "counts"), "node").select("cell", "low", "high", "mine", "node", "n", "counts")
    tasks = tasks.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high")

    def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, 3):
            if len(group) < 2:
                continue
            low, high = group.column(1)[0].as_py(), group.column(2)[0].as_py()
            mine, node, sizes = (group.column(i).to_numpy() for i in (3, 4, 5))
            counts = [np.frombuffer(value.as_py(), dtype=np.uint8) for value in group.column(6)]
            i, j = candidates(counts, sizes, np.flatnonzero(mine == low), np.flatnonzero(mine == high), percent)
            i, j = i[i != j], j[i != j]
            if len(i):
                # connected sets need no more than a star
                order = np.argsort(node, kind="stable")
                rank = np.empty_like(order)
                rank[order] = np.arange(len(order))
                root = node[order[smallest_reached(len(node), rank[i], rank[j])[rank]]]
                is_edge = root != node
                yield pa.RecordBatch.from_arrays([pa.array(node[is_edge]), pa.array(root[is_edge])], ["a", "b"])

    edges = materialize(tasks.mapInArrow(near, "a bigint, b bigint").distinct(), "jaccard-candidates")
    parts = connected_components(edges)
    roots = parts.select(F.col("component").alias("node"), "component").distinct()
    return parts.unionByName(roots).select("node", F.col("component").alias("region"))


def _bit_of(node: str) -> Column:
    """The bit of an id's hash, from 0."""
    return F.pmod(F.xxhash64(node), F.lit(_BITS).cast("bigint"))


def _bit_map(ids: DataFrame) -> np.ndarray:
    """A map of ``_BITS`` bits with the bit of every id's hash set; its size does not depend on their number."""
    # values from 1 are in buckets from 1; 0 would be in a bucket of its own
    pages = ids.select((_bit_of("node") + 1).alias("bit")).groupBy(F.bitmap_bucket_number(F.col("bit")).alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit"))).alias("bits")
    )
    found = np.zeros(_BITS // 8 + 8192, dtype=np.uint8)
    for row in pages.collect():
        page = np.frombuffer(row["bits"], dtype=np.uint8)
        found[(row["page"] - 1) * len(page) : row["page"] * len(page)] |= page
    return found


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(region, node, n, hashes) for the documents in ``wanted`` (region, node, k1)."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sizes, packed, right = [], [], []
            keys = batch.column(2).to_numpy()
            for hashes, key in zip(shingle_sets(batch.column(3), words), keys):
                sizes.append(len(hashes))
                packed.append(hashes.tobytes())
                right.append(mix(hashes).sum(dtype=np.uint64).view(np.int64) == key)  # not another text with the id
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                ["region", "node", "n", "hashes"],
            )
            yield out.filter(pa.array(right, pa.bool_()))

    bits = docs.sparkSession.sparkContext.broadcast(_bit_map(wanted))

    def marked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(2).to_numpy()
            hit = bits.value[place >> 3] >> (place & 7) & 1
            yield batch.select([0, 1]).filter(pa.array(hit.astype(bool)))

    texts = docs.select(F.col("doc_id").cast("bigint").alias("node"), F.col("text").alias("text")).filter("node is not null")
    texts = texts.withColumn("place", _bit_of("node")).mapInArrow(marked, "node bigint, text string")
    rows = texts.join(wanted, "node").select("region", "node", "k1", "text")
    return rows.mapInArrow(read, "region bigint, node bigint, n bigint, hashes binary")


def _overlaps(one: np.ndarray, many: list[np.ndarray]) -> np.ndarray:
    """How many hashes ``one`` shares with each of ``many``; all are sorted and distinct."""
    if not many:
        return np.zeros(0, dtype=np.int64)
    flat = np.concatenate(many)
    place = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    hit = one[place] == flat
    owner = np.repeat(np.arange(len(many)), [len(m) for m in many])
    return np.bincount(owner[hit], minlength=len(many))


class _Index:
    """The sets of a region by shingle."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets)
        self._ends = np.cumsum(self.sizes)
        _, self._word = np.unique(flat, return_inverse=True)
        order = np.argsort(self._word, kind="stable")
        self._owner = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self._start = np.searchsorted(self._word[order], np.arange(self._word.max() + 2))

    def overlaps(self, i: int) -> np.ndarray:
        words = self._word[self._ends[i] - self.sizes[i] : self._ends[i]]
        starts = self._start[words]
        lengths = self._start[words + 1] - starts
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)
        return np.bincount(self._owner[places], minlength=len(self.sets))


def region_links(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all linked sets of a region: pairs of places."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    eps = 1 - percent / 100 + 1e-9
    labels = np.arange(n)
    left: list[int] = []
    right: list[int] = []

    def connect(i: int, others: np.ndarray) -> None:
        for j in others.tolist():
            if labels[i] != labels[j]:
                left.append(i)
                right.append(j)
                low, high = sorted((labels[i], labels[j]))
                labels[labels == high] = low

    if n <= 6:
        for i in range(n - 1):
            shared = _overlaps(sets[i], sets[i + 1 :])
            connect(i, i + 1 + np.flatnonzero(100 * shared >= percent * (sizes[i] + sizes[i + 1 :] - shared)))
        return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)

    index = _Index(sets)
    distances: list[np.ndarray] = []
    nearest = np.full(n, np.inf)
    pivot = 0
    for _ in range(min(n, 8 + ceil(n**0.5))):
        shared = index.overlaps(pivot)
        joined = sizes + sizes[pivot] - shared
        connect(pivot, np.flatnonzero(100 * shared >= percent * joined))
        distances.append(1 - shared / joined)
        nearest = np.minimum(nearest, distances[-1])
        pivot = int(nearest.argmax())
        if nearest[pivot] <= eps / 2:
            break
    table = np.array(distances)
    for i in range(n):
        maybe = labels != labels[i]
        maybe[: i + 1] = False
        maybe &= (100 * sizes >= percent * sizes[i]) & (percent * sizes <= 100 * sizes[i])
        others = np.flatnonzero(maybe)
        if len(others):
            others = others[(np.abs(table[:, others] - table[:, i : i + 1]) <= eps).all(axis=0)]
        if len(others):
            shared = index.overlaps(i)[others]
            connect(i, others[100 * shared >= percent * (sizes[i] + sizes[others] - shared)])
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


def _join_leaves(groups: DataFrame, percent: int) -> DataFrame:
    """(a, b) links of every group (region, low, high)."""
    rows = groups.select("region", "low", "high", "node", "hashes")
    rows = rows.repartition("region", "low", "high").sortWithinPartitions("region", "low", "high")

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, 3):
            if len(group) < 2:
                continue
            nodes = group.column(3).to_numpy()
            sets = [np.frombuffer(value.as_py(), dtype=np.uint64) for value in group.column(4)]
            i, j = region_links(sets, percent)
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[i]), pa.array(nodes[j])], ["a", "b"])

    return rows.mapInArrow(joined, "a bigint, b bigint")


def _split(sets: DataFrame, percent: int, most_sets: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """Regions of ``sets`` (region, node, n, hashes, members) cut by pivots: (links found, sets of the new regions)."""
    eps = 1 - percent / 100 + 1e-9
    chunks = F.ceil(F.col("members") / most_sets).cast("bigint")
    dealt = sets.withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(depth)), chunks))
    order = Window.partitionBy("region").orderBy(F.xxhash64("node", F.lit(depth + 100)), "node")
    pivots = sets.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= _PIVOTS)
    every_chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), chunks - 1)).alias("p_chunk")
    copies = pivots.select(*[F.col(name).alias(f"p_{name}") for name in ("region", "node", "hashes")], every_chunk)

    def assign(rows: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
        columns = ["node", "pivot", "distance", "parent"]
        if rows.empty or chosen.empty:
            return pd.DataFrame({name: [] for name in columns})
        chosen = chosen.sort_values("p_node")
        held = [np.frombuffer(value, dtype=np.uint64) for value in rows["hashes"]]
        sizes = np.array([len(h) for h in held])
        table = []
        for value in chosen["p_hashes"]:
            one = np.frombuffer(value, dtype=np.uint64)
            shared = _overlaps(one, held)
            table.append(1 - shared / (sizes + len(one) - shared))
        distances = np.array(table)
        near = distances <= distances.min(axis=0) + 2 * eps
        which, row = np.nonzero(near)
        return pd.DataFrame(
            {
                "node": rows["node"].to_numpy()[row],
                "pivot": chosen["p_node"].to_numpy()[which],
                "distance": distances[which, row],
                "parent": rows["region"].iloc[0],
            }
        )

    grouped = dealt.groupBy("region", "chunk").cogroup(copies.groupBy("p_region", "p_chunk"))
    assigned = materialize(grouped.applyInPandas(assign, "node bigint, pivot bigint, distance double, parent bigint"), "jaccard-voronoi")
    links = assigned.filter(100 * (1 - F.col("distance")) >= percent - 1e-7).select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    outside = assigned.filter(F.col("distance") > eps).groupBy("parent", "pivot").agg(F.min("distance").alias("nearest_outside"))
    # without a document outside the ball around a pivot, everything in its region is linked already
    kept = assigned.join(outside, ["parent", "pivot"]).filter(F.col("distance") >= F.col("nearest_outside") - eps)
    kept = kept.select(F.col("parent").alias("region"), "node", F.xxhash64("parent", "pivot").alias("child"))
    held = sets.select("region", "node", "n", "hashes", F.col("members").alias("before"))
    moved = held.join(kept, ["region", "node"]).select(F.col("child").alias("region"), "node", "n", "hashes", "before")
    return links, materialize(moved, "jaccard-regions")


def components_of(
    docs: DataFrame, percent: int = 90, words: int = 3, most_sets: int = 4096, most_shingles: int = 2_000_000
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    described = materialize(_describe(docs, percent, words), "jaccard-sets")
    sets = described.filter("n > 0 and doc_id is not null").groupBy("k1", "k2", "n").agg(
        F.min("doc_id").alias("node"), F.first("counts").alias("counts")
    )
    sets = materialize(sets, "jaccard-nodes")
    regions = materialize(_regions(docs, sets, percent, words), "jaccard-parts")
    wanted = sets.join(regions, "node").select("region", "node", "k1")
    rows = materialize(_sets_of(docs, wanted, words), "jaccard-hashes")

    links: list[DataFrame] = []
    leaves: list[DataFrame] = []
    whole = [F.lit(0).cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("high")]
    for depth in range(_DEPTH + 1):
        counts = rows.groupBy("region").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("weight"))
        is_large = (F.col("members") > most_sets) | (F.col("weight") > most_shingles)
        counts = materialize(counts, "jaccard-counts")
        large = counts.filter(is_large)
        leaves.append(rows.join(counts.filter(~is_large & (F.col("members") > 1)).select("region"), "region").select("region", *whole, "node", "hashes"))
        if large.isEmpty():
            break
        pending = rows.join(large, "region")
        if depth:
            # what has not shrunk by a fifth won't shrink by more pivots either
            is_stuck = (F.col("members") > 0.8 * F.col("before")) | F.lit(depth == _DEPTH)
        else:
            is_stuck = F.lit(False)
        blocks = F.greatest(F.ceil(2 * F.col("members") / most_sets), F.ceil(2 * F.col("weight") / most_shingles)).cast("bigint")
        stuck = pending.filter(is_stuck).select("region", "node", "hashes", blocks.alias("blocks"))
        stuck = stuck.withColumn("mine", F.pmod(F.xxhash64("node", F.lit(depth + 200)), F.col("blocks")))
        pairs = stuck.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other"))
        leaves.append(pairs.select("region", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "node", "hashes"))
        if depth == _DEPTH:
            break
        found, rows = _split(pending.filter(~is_stuck).select("region", "node", "n", "hashes", "members"), percent, most_sets, depth)
        links.append(found)
    for part in leaves:
        links.append(_join_leaves(part, percent))
    every = links[0]
    for part in links[1:]:
        every = every.unionByName(part)
    parts = connected_components(materialize(every, "jaccard-links"))

    named = sets.join(parts, "node", "left").select("k1", "k2", "n", F.coalesce("component", "node").alias("component"))
    result = described.select("doc_id", "n", "k1", "k2").join(named, ["k1", "k2", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return result.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
