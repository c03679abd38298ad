"""Top-k items per user when the score depends on both sides (vectors of users and items).

Exact retrieval need not compare every user with every item.  Items are cut into blocks of
falling length (norm), and no item of a block scores above |user| times the greatest norm of
the block.  Blocks are met in waves, few at first; between waves every user keeps the k best so far, and a
user whose k-th score lies above the bound of the next block is done.  Cosine scores divide the norms away, so there
the blocks differ in nothing and every user meets all of them.

In a wave, each (block, user slot) cell is a bounded task: it holds the block, streams the users of
its slot past it and returns, per user, k items more than the user has seen in the block.  Seen
pairs are then removed by an anti join; they never reach a task as a list.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinary.functions.columns import hash_slot
from affinary.operators.pairs import anti_join
from affinary.roles import Roles
from affinary.sources.scratch import Stage, materialize

USERS_PER_CELL = 1_024
ITEMS_PER_CELL = 4_096
GROWTH = 4  # each wave meets this many times the blocks of the one before
_AT_ONCE = 256  # users multiplied with a block at a time


@dataclass(frozen=True)
class ItemBlocks:
    """``rows`` holds (_block, _id, _v); ``norms`` the greatest norm of every block, never growing.

    The driver holds one number per block, that is per ``items_per_cell`` items.
    """

    rows: DataFrame
    norms: tuple[float, ...]


def _usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(_id, _v, _norm) of the rows with an id and a vector of finite numbers."""
    value = F.col(vector).cast("array<double>")
    picked = rows.select(F.col(key).alias("_id"), value.alias("_v")).filter("_id is not null and size(_v) > 0")
    squares = F.aggregate("_v", F.lit(0.0), lambda total, x: total + x * x)
    # a null or NaN component makes the norm null or NaN; so would a component too large to square
    largest = F.array_max(F.transform("_v", F.abs))
    scaled = F.aggregate("_v", F.lit(0.0), lambda total, x: total + (x / largest) * (x / largest))
    norm = F.when(largest == 0, 0.0).when(largest < 1e150, F.sqrt(squares)).otherwise(largest * F.sqrt(scaled))
    is_finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return picked.filter(is_finite).select("_id", "_v", norm.alias("_norm"))


def norm_blocks(items: DataFrame, key: str, vector: str, items_per_cell: int, unit: bool, stage: Stage = materialize) -> ItemBlocks:
    """Items in blocks of falling norm, equal norms in the order of a hash."""
    rows = stage(_usable(items, key, vector), "items")
    if unit:
        rows = rows.withColumn("_norm", F.lit(1.0))
    blocks = max(1, ceil(rows.count() / items_per_cell))
    dealt = rows.repartitionByRange(blocks, F.desc("_norm"), F.xxhash64("_id"))
    stored = stage(dealt.select(F.spark_partition_id().alias("_part"), "_id", "_v", "_norm"), "item-blocks")
    found = stored.groupBy("_part").agg(F.max("_norm").alias("n")).orderBy("_part").collect()
    numbers = {row["_part"]: number for number, row in enumerate(found)}
    number = F.element_at(F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair]), F.col("_part")) if numbers else F.lit(0)
    return ItemBlocks(stored.select(number.alias("_block"), "_id", "_v"), tuple(row["n"] for row in found))


def users_in_reach(users: DataFrame, norms: tuple[float, ...], begin: int, end: int, slack: float = 0.0) -> DataFrame:
    """The users (_id, _v, _norm, _floor) once per block from ``begin`` to ``end`` whose bound reaches their floor."""
    limits = np.array(norms)

    def reached(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norm, floor = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            # least norm a block needs; bounds are compared with room for rounding
            with np.errstate(divide="ignore", invalid="ignore"):
                needed = np.where(norm > 0, (floor - slack - 1e-9 * np.abs(floor)) / norm, np.where(floor <= slack, -np.inf, np.inf))
            count = np.searchsorted(-limits, -needed * (1 - 1e-9 * np.sign(needed)), side="right")
            yield batch.append_column("_reach", pa.array(count.astype(np.int32)))

    schema = T.StructType([*users.select("_id", "_v", "_norm", "_floor", "_seen").schema.fields, T.StructField("_reach", T.IntegerType())])
    near = users.select("_id", "_v", "_norm", "_floor", "_seen").mapInArrow(reached, schema).filter(F.col("_reach") > begin)
    return near.withColumn("_block", F.explode(F.sequence(F.lit(begin), F.least("_reach", F.lit(end)) - 1)))


def cosine_top_k(users: DataFrame, items: DataFrame, k: int, seen: DataFrame | None = None, **options) -> DataFrame:
    """The ``k`` items with the greatest cosine score (moved to [0, 1]) for every user."""
    return vector_top_k(users, items, k, seen, cosine=True, **options)


def vector_top_k(
    users: DataFrame,
    items: DataFrame,
    k: int,
    seen: DataFrame | None = None,
    roles: Roles = Roles(),
    *,
    cosine: bool = False,
    vector: str = "vector",
    digits: int = 12,
    users_per_cell: int = USERS_PER_CELL,
    items_per_cell: int = ITEMS_PER_CELL,
    stage: Stage = materialize,
) -> DataFrame:
    """The ``k`` items with the greatest dot product, or cosine score, for every user.

    ``users`` and ``items`` hold one row per id; rows without id, or whose vector is null or holds null, NaN or
    infinite components, are left out, as are scores that overflow.  Pairs in ``seen`` are left out.
    Equal scores are ordered by item; ``digits`` only has to take off what the order of
    a sum leaves in the last bits, so that equal vectors have equal scores.
    """
    user, item = roles.pair
    item_type, user_type = items.schema[item].dataType, users.schema[user].dataType
    blocks = norm_blocks(items, item, vector, items_per_cell, cosine, stage)
    people = stage(_usable(users, user, vector), "users")
    if cosine:
        people = people.withColumn("_norm", F.lit(1.0))
    slots = max(1, ceil(people.count() / users_per_cell))
    schema = T.StructType([T.StructField(user, user_type), T.StructField(item, item_type), T.StructField("score", T.DoubleType())])
    order = Window.partitionBy(user).orderBy(F.desc("score"), item)
    pairs = None
    if seen is not None:
        known = seen.select(F.col(user).alias("_id"), F.col(item).alias("_item")).dropna().distinct()
        pairs = stage(known.join(people.select("_id"), "_id", "left_semi"), "seen")

    def best_of(found: DataFrame) -> DataFrame:
        ranked = found.select(user, item, "score").withColumn("prediction_rank", F.row_number().over(order))
        return ranked.filter(F.col("prediction_rank") <= k)

    lowest = F.lit(float("-inf"))
    asking = people.withColumn("_floor", lowest)
    best: DataFrame | None = None
    begin, width = 0, 1
    while begin < len(blocks.norms) or best is None:
        end = min(len(blocks.norms), begin + width)
        here = blocks.rows.filter(F.col("_block").between(begin, end - 1))
        asking = _with_seen(asking, pairs, here)
        visits = users_in_reach(asking, blocks.norms, begin, end, slack=10.0**-digits) if end else asking.limit(0).withColumn("_block", F.lit(0))
        cells = _cells(visits, here, k, slots, end - begin)
        found = cells.mapInArrow(_best_in_cells(schema, digits, cosine), schema)
        if pairs is not None:
            found = anti_join(found, pairs.select(F.col("_id").alias(user), F.col("_item").alias(item)), [user, item])
        merged = found if best is None else best.select(user, item, "score").unionByName(found)
        best = stage(best_of(merged), "best")
        begin, width = end, width * GROWTH
        if begin >= len(blocks.norms):
            break
        floors = best.filter(F.col("prediction_rank") == k).select(F.col(user).alias("_id"), _raw(F.col("score"), cosine).alias("_floor"))
        asking = people.join(floors, "_id", "left").withColumn("_floor", F.coalesce("_floor", lowest))
        # users whose next block can't reach them any more are done
        asking = stage(users_in_reach(_with_seen(asking, None, here), blocks.norms, begin, begin + 1, 10.0**-digits).select("_id", "_v", "_norm", "_floor"), "asking")
        if asking.isEmpty():
            break
    return best.withColumn("prediction_rank", F.col("prediction_rank").cast("bigint"))


def _raw(score: Column, cosine: bool) -> Column:
    return score * 2 - 1 if cosine else score


def _with_seen(asking: DataFrame, pairs: DataFrame | None, here: DataFrame) -> DataFrame:
    """The users with ``_seen``: how many items of each of these blocks they have seen, as a map."""
    if pairs is None:
        return asking.withColumn("_seen", F.lit(None).cast("map<int,bigint>"))
    met = pairs.join(here.select(F.col("_id").alias("_item"), "_block"), "_item")
    counts = met.groupBy("_id", "_block").agg(F.count(F.lit(1)).alias("n"))
    maps = counts.groupBy("_id").agg(F.map_from_entries(F.collect_list(F.struct("_block", "n"))).alias("_seen"))
    return asking.join(maps, "_id", "left")


def _cells(visits: DataFrame, here: DataFrame, k: int, slots: int, blocks: int) -> DataFrame:
    """Block rows and the users that meet them, cell by cell, each block before its users."""
    spark = visits.sparkSession
    slot = hash_slot(slots, "user-slot", "_id").cast("int")
    extra = F.coalesce(F.try_element_at("_seen", F.col("_block")), F.lit(0))
    asking = visits.select(
        "_block", slot.alias("_slot"), F.lit(1).alias("_side"), F.col("_id").alias("_user"), F.lit(None).cast(here.schema["_id"].dataType).alias("_item"),
        "_v", "_floor", (extra + k).cast("bigint").alias("_take"),
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("_slot")
    held = here.select(
        "_block", every, F.lit(0).alias("_side"), F.lit(None).cast(visits.schema["_id"].dataType).alias("_user"), F.col("_id").alias("_item"),
        "_v", F.lit(None).cast("double").alias("_floor"), F.lit(None).cast("bigint").alias("_take"),
    )
    # a number of partitions of its own, so that small cells are not merged into one task
    partitions = max(1, min(2 * slots * max(1, blocks), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return held.unionByName(asking).repartition(partitions, "_block", "_slot").sortWithinPartitions("_block", "_slot", "_side")


def _best_in_cells(schema: T.StructType, digits: int, cosine: bool):
    """A function from sorted cell rows to each user's best items of the block."""

    def matrix_of(column: pa.Array) -> np.ndarray:
        matrix = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
        if not cosine:
            return matrix
        largest = np.abs(matrix).max(axis=1, keepdims=True)
        matrix = np.where(largest > 1e150, matrix / np.maximum(largest, 1.0), matrix)  # squares would overflow
        return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)

    def best_columns(scores: np.ndarray, take: int, floor: float) -> np.ndarray:
        """Columns of the greatest usable scores, equal scores in column order."""
        usable = np.flatnonzero(np.isfinite(scores) & (scores >= floor))
        if len(usable) > take:
            bar = np.partition(scores[usable], len(usable) - take)[len(usable) - take]
            usable = usable[scores[usable] >= bar]
        return usable[np.argsort(-scores[usable], kind="stable")][:take]

    def best_in_cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell: tuple[int, int] | None = None
        held: list[pa.RecordBatch] = []
        ids, matrix = None, None
        for batch in batches:
            if not len(batch):
                continue
            block, slot, side = (batch.column(i).to_numpy() for i in range(3))
            changes = np.flatnonzero((block[1:] != block[:-1]) | (slot[1:] != slot[:-1]) | (side[1:] != side[:-1])) + 1
            for start, end in zip([0, *changes], [*changes, len(batch)]):
                if cell != (block[start], slot[start]):
                    cell, held, ids = (block[start], slot[start]), [], None
                piece = batch.slice(start, end - start)
                if side[start] == 0:
                    held.append(piece)
                    continue
                if ids is None:
                    ids = pa.concat_arrays([one.column(4) for one in held])
                    by_id = pc.sort_indices(ids)
                    ids = ids.take(by_id)
                    matrix = np.concatenate([matrix_of(one.column(5)) for one in held])[by_id.to_numpy()].T
                for first in range(0, len(piece), _AT_ONCE):
                    yield best_of_users(piece.slice(first, _AT_ONCE), ids, matrix)

    def best_of_users(asking: pa.RecordBatch, ids: pa.Array, matrix: np.ndarray) -> pa.RecordBatch:
        with np.errstate(over="ignore", invalid="ignore"):
            products = matrix_of(asking.column(5)) @ matrix
            scores = np.round((products + 1) / 2 if cosine else products, digits)
        floors, takes = asking.column(6).to_numpy(), asking.column(7).to_numpy()
        floors = np.round((floors + 1) / 2 if cosine else floors, digits)
        picked = [best_columns(line, int(take), floor) for line, take, floor in zip(scores, takes, floors)]
        rows = np.repeat(np.arange(len(picked)), [len(best) for best in picked])
        columns = np.concatenate(picked)
        arrays = [asking.column(3).take(pa.array(rows)), ids.take(pa.array(columns)), pa.array(scores[rows, columns])]
        return pa.RecordBatch.from_arrays(arrays, schema.names)

    return best_in_cells
