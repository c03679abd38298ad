"""Hard negatives by an inverted multi-index, exact.

Vectors become integers ``floor(scale * x)`` and are cut into two halves.  One codebook per half space, fitted by
k-means on at most ``sample`` rows, deals every row to a cell (i, j).  With the largest distance of a row from
its centre as the radius of a codebook entry, an anchor a scores at most

    bound(i) + bound(j),  bound(i) = <a_half, centre_i> + |a_half| * radius_i

in cell (i, j).  A heap over the two lists of bounds, each sorted downwards, yields the cells in the order of that sum
(the multi-sequence order).  An anchor visits its cells in growing shares; it stops when every list it
looks for is full of rows that score above the bound of the next cell, or when that bound lies below its window.

First the positives are searched: the best rows of the anchor's label.  Then for each positive the best rows of other
labels whose score lies in [low/100, high/100] of the positive's.  Both are the same search with other windows.

A cell's rows are cut into parts of about ``chunk`` rows.  An anchor travels to the parts of the cells it visits, where
it comes behind the part's rows in sorted order: a task holds one part, streams the anchors that visit it and
returns at most ``count`` rows per list, so neither a cell nor a label with a third of all rows is one task.  The driver
reads the codebooks, radii and sizes of cells, whose number is fixed by ``entries``.

Rows with a null label, id or vector, or with null or non-finite components take no part.  Components are held
to -LARGEST..LARGEST, within which scores are exact.  Vectors of different lengths are not compared: each length
is searched on its own, and lengths are taken to be few.  Equal rows (id, label and vector) count once; rows that share
only their id are rows of their own, but never partners of each other, and an id that is an anchor several
times has one list of results per such row.  Ties go to the smaller id, then by a hash of the row.  Extra columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import islice
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinary.sources.scratch import materialize

LARGEST = 1 << 22  # products and their sums over 64 components then fit a double's 53 bits
_NONE = -(1 << 62)  # below every score
SHARES = (1 / 64, 1 / 8, 1.0)  # parts of all cells visited, wave by wave


def integer_rows(vectors: DataFrame, scale: int = 256, label: Column | None = None) -> DataFrame:
    """(vec_id, label, key, v): the rows that take part, equal ones once; ``key`` names a row."""
    value = F.col("embedding").cast("array<double>")
    is_finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    own = F.col("label") if label is None else label
    kept = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & value.isNotNull() & (F.size(value) > 0) & is_finite)
    largest = F.lit(float(LARGEST))
    held = F.transform(value, lambda x: F.greatest(-largest, F.least(largest, F.floor(x * scale).cast("double"))).cast("int"))
    rows = kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), own.cast("bigint").alias("label"), held.alias("v"))
    return rows.distinct().select("vec_id", "label", F.xxhash64("label", "v").alias("key"), "v")


def _nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row and the distance to it, rounded up."""
    square = (rows**2).sum(axis=1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(axis=1)
    place = square.argmin(axis=1)
    return place, np.sqrt(((rows - centres[place]) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-9


def codebook(rows: np.ndarray, entries: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Centres of different rows by k-means, fewer where there are not enough different rows."""
    rows = np.unique(rows, axis=0) if rows.shape[1] else rows[:1]
    random = np.random.default_rng(seed)
    centres = rows[random.permutation(len(rows))[:entries]]
    for _ in range(rounds):
        place, _ = _nearest(rows, centres)
        counts = np.bincount(place, minlength=len(centres))
        for i in np.flatnonzero(counts):
            centres[i] = rows[place == i].mean(axis=0)
    return centres


class CellOrder:
    """Codebooks, radii and the cells that hold rows; says in which order an anchor visits the cells."""

    def __init__(self, centres: tuple[np.ndarray, np.ndarray], radii: tuple[np.ndarray, np.ndarray], cells: frozenset[int]):
        self.centres, self.radii, self.cells = centres, radii, cells
        self.half = centres[0].shape[1]
        self.width = len(centres[1])

    def bounds(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        halves = anchor[: self.half], anchor[self.half :]
        return tuple(  # type: ignore[return-value]
            c @ part + np.linalg.norm(part) * (r * (1 + 1e-9) + 1e-9 * np.linalg.norm(c, axis=1)) + 1e-6  # with room for rounding
            for part, c, r in zip(halves, self.centres, self.radii)
        )

    def visits(self, anchor: np.ndarray) -> Iterator[tuple[float, int]]:
        """(bound, cell) of every cell with rows, bounds never growing."""
        first, second = self.bounds(anchor)
        down = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
        heap = [(-(first[down[0][0]] + second[down[1][0]]), 0, 0)]
        while heap:
            value, i, j = heappop(heap)
            cell = int(down[0][i]) * self.width + int(down[1][j])
            if cell in self.cells:
                yield -value, cell
            if j + 1 < len(down[1]):
                heappush(heap, (-(first[down[0][i]] + second[down[1][j + 1]]), i, j + 1))
            if j == 0 and i + 1 < len(down[0]):
                heappush(heap, (-(first[down[0][i + 1]] + second[down[1][0]]), i + 1, 0))


class MultiIndex:
    """All rows of one length, dealt to cells."""

    def __init__(self, rows: DataFrame, length: int, entries: int, sample: int, chunk: int, seed: int):
        self.length = length
        half = (length + 1) // 2
        drawn = rows.select("v", F.xxhash64(F.lit(seed), "vec_id", "key").alias("h")).orderBy("h").limit(sample)
        points = np.array([row["v"] for row in drawn.collect()], dtype=np.float64)
        centres = codebook(points[:, :half], entries, seed=seed), codebook(points[:, half:], entries, seed=seed + 1)
        width = len(centres[1])

        def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                values = _matrix(batch.column(3), length)
                (i, r1), (j, r2) = _nearest(values[:, :half], centres[0]), _nearest(values[:, half:], centres[1])
                more = [pa.array(i * width + j), pa.array(r1), pa.array(r2)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "cell", "r1", "r2"])

        schema = "vec_id bigint, label bigint, key bigint, v array<int>, cell bigint, r1 double, r2 double"
        dealt = materialize(rows.select("vec_id", "label", "key", "v").mapInArrow(placed, schema), "index-rows")
        found = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).collect()
        radii = np.zeros(len(centres[0])), np.zeros(width)
        for row in found:
            i, j = divmod(row["cell"], width)
            radii[0][i], radii[1][j] = max(radii[0][i], row["r1"]), max(radii[1][j], row["r2"])
        # parts per cell: a hash deals a cell's rows, so a part may hold some more than ``chunk``
        self.parts = {row["cell"]: ceil(row["n"] / chunk) for row in found}
        self.order = CellOrder(centres, radii, frozenset(self.parts))
        parts = dealt.sparkSession.createDataFrame(list(self.parts.items()), "cell bigint, parts bigint")
        part = F.pmod(F.xxhash64("vec_id", "key"), "parts").alias("part")
        self.rows = dealt.join(F.broadcast(parts), "cell").select("cell", part, "vec_id", "key", "label", "v")


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length).astype(np.float64)


def _best(found: DataFrame, count: int) -> DataFrame:
    """The first ``count`` rows per anchor and list, by score, then id."""
    order = Window.partitionBy("anchor", "anchor_key", "list").orderBy(F.desc("score"), "partner", "partner_key")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


_WINDOWS = "array<struct<list:int,least:bigint,most:bigint>>"
_ANCHORS = f"vec_id bigint, key bigint, label bigint, v array<int>, windows {_WINDOWS}"
_MEETING = f"cell bigint, part bigint, side int, {_ANCHORS}"
_FOUND = "anchor bigint, anchor_key bigint, list int, partner bigint, partner_key bigint, score bigint"


def search(index: MultiIndex, lists: DataFrame, same: bool, count: int, shares: tuple[float, ...] = SHARES) -> DataFrame:
    """The best ``count`` partners of every list (vec_id, key, label, v, list, least, most): rows of the same or of other
    labels that score from least to most.  Returns (anchor, anchor_key, list, partner, partner_key, score, rank)."""
    order, parts, length = index.order, index.parts, index.length
    limits = sorted({max(1, ceil(share * len(parts))) for share in (*shares, 1.0)})
    looking = lists.groupBy("vec_id", "key").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.sort_array(F.collect_list(F.struct("list", "least", "most"))).alias("windows")
    )
    looking = materialize(looking, "search-anchors")
    best: DataFrame | None = None
    begin = 0
    for end in limits:
        visits = looking.mapInArrow(_planned(order, parts, begin, end, length), _MEETING)
        held = index.rows.select("cell", "part", F.lit(0).alias("side"), "vec_id", "key", "label", "v", F.lit(None).cast(_WINDOWS).alias("windows"))
        meeting = visits.unionByName(held).repartition("cell", "part").sortWithinPartitions("cell", "part", "side")
        found = _best(meeting.mapInArrow(_scored(length, same, count), _FOUND), count)
        if best is not None:
            found = _best(best.drop("rank").unionByName(found.drop("rank")), count)
        best = materialize(found, "search-best")
        if end == limits[-1]:
            break
        # a list that is full only takes rows that score as much as its last one
        full = best.filter(F.col("rank") == count).groupBy(F.col("anchor").alias("vec_id"), F.col("anchor_key").alias("key"))
        full = full.agg(F.map_from_entries(F.collect_list(F.struct("list", "score"))).alias("last"))
        waiting = looking.join(full, ["vec_id", "key"], "left")
        raised = F.transform(
            "windows",
            lambda w: F.struct(w["list"].alias("list"), F.greatest(w["least"], F.try_element_at("last", w["list"])).alias("least"), w["most"].alias("most")),
        )
        waiting = waiting.select("vec_id", "key", "label", "v", raised.alias("windows"))
        looking = materialize(waiting.mapInArrow(_uncertified(order, end, length), _ANCHORS), "search-anchors")
        if looking.isEmpty():
            break
        begin = end
    return best  # type: ignore[return-value]


def _floors(windows: pa.Array) -> np.ndarray:
    """The least score that could still enter one of the lists, for each anchor."""
    return np.minimum.reduceat(windows.flatten().field("least").to_numpy(), np.cumsum([0, *windows.value_lengths().to_numpy()[:-1]]))


def _uncertified(order: CellOrder, end: int, length: int):
    """Anchors for which cells behind the first ``end`` may hold more."""

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            stays = []
            for anchor, floor in zip(_matrix(batch.column(3), length), _floors(batch.column(4))):
                following = next(islice(order.visits(anchor), end, None), None)
                stays.append(following is not None and following[0] >= floor)
            yield batch.filter(pa.array(stays, pa.bool_()))

    return kept


def _planned(order: CellOrder, parts: dict[int, int], begin: int, end: int, length: int):
    """A row for every part of the cells that an anchor visits as number ``begin`` to ``end`` of its order, while their bounds
    reach its windows."""

    def planned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, len(batch), 32):
                some = batch.slice(row, 32)
                at, cells, numbers = [], [], []
                for place, (anchor, floor) in enumerate(zip(_matrix(some.column(3), length), _floors(some.column(4)))):
                    for bound, cell in islice(order.visits(anchor), begin, end):
                        if bound < floor:
                            break
                        cells.extend([cell] * parts[cell])
                        numbers.extend(range(parts[cell]))
                        at.extend([place] * parts[cell])
                told = some.take(pa.array(at, pa.int64()))
                columns = [pa.array(cells, pa.int64()), pa.array(numbers, pa.int64()), pa.array(np.ones(len(at), dtype=np.int32)), *told.columns]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "part", "side", *told.schema.names])

    return planned


def _scored(length: int, same: bool, count: int):
    """Anchors behind the rows of the part they visit: the best rows of the part for every list.  Only the part is held."""

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple[int, int] | None = None
        held: list[pa.RecordBatch] = []
        rows: tuple[np.ndarray, ...] = ()
        for batch in batches:
            if not len(batch):
                continue
            cell, part, side = (batch.column(i).to_numpy() for i in range(3))
            changes = np.flatnonzero((cell[1:] != cell[:-1]) | (part[1:] != part[:-1]) | (side[1:] != side[:-1])) + 1
            for begin, end in zip([0, *changes], [*changes, len(batch)]):
                piece = batch.slice(begin, end - begin)
                if key != (cell[begin], part[begin]):
                    key, held, rows = (cell[begin], part[begin]), [], ()
                if side[begin] == 0:
                    held.append(piece)
                    continue
                if not rows:  # every cell that is visited holds rows, and they come first
                    rows = tuple(np.concatenate([one.column(i).to_numpy() for one in held]) for i in (3, 4, 5))
                    rows += (np.concatenate([_matrix(one.column(6), length) for one in held]).T,)
                for some in range(0, len(piece), 256):
                    yield from _best_of_part(piece.slice(some, 256), rows, length, same, count)

    return scored


def _best_of_part(anchors: pa.RecordBatch, rows: tuple[np.ndarray, ...], length: int, same: bool, count: int) -> Iterator[pa.RecordBatch]:
    ids, keys, labels, vectors = rows
    own, own_keys, own_labels = (anchors.column(i).to_numpy() for i in (3, 4, 5))
    scores = (_matrix(anchors.column(6), length) @ vectors).astype(np.int64)
    allowed = (own_labels[:, None] == labels[None]) == same
    allowed &= own[:, None] != ids[None]
    scores[~allowed] = _NONE
    windows = anchors.column(7)
    place = np.repeat(np.arange(len(anchors)), windows.value_lengths().to_numpy())
    lists, least, most = (windows.flatten().field(name).to_numpy() for name in ("list", "least", "most"))
    out = []
    for i in np.flatnonzero(scores.max(axis=1)[place] >= least):
        row = scores[place[i]]
        hits = np.flatnonzero((row >= least[i]) & (row <= most[i]))
        if len(hits) > count:
            edge = np.partition(row[hits], len(hits) - count)[len(hits) - count]
            hits = hits[row[hits] >= edge]
            hits = hits[np.lexsort((keys[hits], ids[hits], -row[hits]))[:count]]
        if len(hits):
            out.append((np.full(len(hits), place[i]), np.full(len(hits), lists[i]), hits, row[hits]))
    if out:
        place, lists, hits, found = (np.concatenate([part[i] for part in out]) for i in range(4))
        columns = [own[place], own_keys[place], lists.astype(np.int32), ids[hits], keys[hits], found]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "anchor_key", "list", "partner", "partner_key", "score"])


def _hundredth(value: Column) -> Column:
    """A hundredth of a whole number, rounded down."""
    return F.call_function("div", value - F.pmod(value, F.lit(100)), F.lit(100).cast("bigint"))


def hard_negatives(
    vectors: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
    label: Column | None = None,
    entries: int = 16,
    sample: int = 4096,
    chunk: int = 512,
    seed: int = 5,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors, the rows whose id is
    divisible by ``every``.  A negative scores from ``low`` to ``high`` hundredths of the positive's score."""
    rows = materialize(integer_rows(vectors, scale, label), "integer-rows")
    results = []
    for length in sorted(row["n"] for row in rows.select(F.size("v").alias("n")).distinct().collect()):
        index = MultiIndex(rows.filter(F.size("v") == length), length, entries, sample, chunk, seed)
        anchors = index.rows.filter(F.col("vec_id") % every == 0).select("vec_id", "key", "label", "v")
        widest = F.lit(1 << 60)
        wanted = anchors.select("*", F.lit(0).alias("list"), (-widest).alias("least"), widest.alias("most"))
        found = search(index, wanted, same=True, count=positives)
        found = found.select("anchor", "anchor_key", F.col("rank").alias("list"), F.col("partner").alias("positive_id"), F.col("score").alias("positive_score"))
        # low * positive <= 100 * negative <= high * positive, in whole numbers
        window = found.select(
            F.col("anchor").alias("vec_id"), F.col("anchor_key").alias("key"), "list",
            (-_hundredth(-F.col("positive_score") * low)).alias("least"), _hundredth(F.col("positive_score") * high).alias("most"),
        ).filter("least <= most")
        wanted = anchors.join(window, ["vec_id", "key"])
        second = search(index, wanted, same=False, count=negatives)
        told = second.join(found, ["anchor", "anchor_key", "list"])
        results.append(
            told.select(
                F.col("anchor").alias("anchor_id"),
                "positive_id",
                "rank",
                F.col("partner").alias("negative_id"),
                "positive_score",
                F.col("score").alias("negative_score"),
            )
        )
    if not results:
        nothing = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return vectors.sparkSession.createDataFrame([], nothing)
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    return whole
