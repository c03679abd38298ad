"""Exact positions and running sums that never put one whole group into one task.

A plain ``row_number`` over a group sorts that group in a single task, and one
date, user or score may hold a third of all rows.  Positions come from a sort of the
whole table by range partitions, whose sizes give each partition's offset.  Running sums
cut each group into slots along its sort order: slot totals are counted first (map-side
combined, a bounded number of rows per group), their running sums give each slot's
offset, and only rows of one slot are ever sorted together.

There is one form for tables of every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinary.functions.columns import shuffle_hash
from affinary.sources.scratch import Stage, materialize

SLOT_DIGITS = 4  # leading hash digits per slot: 65,536 slots in a group
PLACE_BITS = 33  # of a sorted row's number that are its place in its partition


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi join in which null keys match each other; keeps the left key columns."""
    renamed = right.withColumnsRenamed({name: f"_r_{name}" for name in on})
    matches = [left[name].eqNullSafe(renamed[f"_r_{name}"]) for name in on]
    return left.join(renamed, matches, how).drop(*[f"_r_{name}" for name in on])


def _earlier(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def slotted_running_sum(
    df: DataFrame,
    group: Sequence[str],
    slots: Sequence[str],
    order: Sequence[str | Column],
    weight: Column,
    out: str,
) -> DataFrame:
    """Sum of ``weight`` over the earlier rows of the group.

    ``slots`` are columns that rise with ``order``: sorting by them and then by
    ``order`` must be the same as sorting by ``order`` alone.
    """
    # One struct key: its null fields are equal to each other, and since window and
    # join use the same key, the rows are shuffled once for both.
    keyed = df.withColumns({"__w": weight.cast("bigint"), "__key": F.struct(*group, *slots)})
    totals = keyed.groupBy("__key").agg(F.sum("__w").alias("__slot_total"))
    of_group = [F.col(f"__key.{name}") for name in group] or [F.lit(0)]
    by_slot = _earlier(Window.partitionBy(*of_group).orderBy(*[F.col(f"__key.{name}") for name in slots]))
    offsets = totals.select("__key", F.coalesce(F.sum("__slot_total").over(by_slot), F.lit(0)).alias("__offset"))
    inside = _earlier(Window.partitionBy("__key").orderBy(*order))
    placed = keyed.withColumn("__inside", F.coalesce(F.sum("__w").over(inside), F.lit(0)))
    joined = placed.join(offsets, "__key")
    return joined.withColumn(out, F.col("__offset") + F.col("__inside")).drop("__w", "__key", "__offset", "__inside")


def hash_running_sum(
    df: DataFrame,
    group: Sequence[str],
    key: Sequence[str],
    seed: str,
    weight: Column | None = None,
    out: str = "position",
    tie: Sequence[str] = (),
) -> DataFrame:
    """Running sum over earlier rows in shuffled order; with no weight, the 0-based position.

    ``key`` identifies a row.  Rows that share a key share a hash and so a slot:
    number true copies with ``number_copies`` first, or name columns that tell
    them apart in ``tie``.
    """
    unit = F.lit(1) if weight is None else weight
    hashed = df.withColumn("__h", shuffle_hash(seed, *key))
    keyed = hashed.withColumn("__slot", F.substring("__h", 1, SLOT_DIGITS))
    placed = slotted_running_sum(keyed, group, ["__slot"], ["__h", *key, *tie], unit, out)
    return placed.drop("__h", "__slot")


def place_in_order(
    df: DataFrame, order: Sequence[str | Column], stage: Stage, out: str = "__at", drop: Sequence[str] = ()
) -> DataFrame:
    """The rows sorted by range partition and staged, with their partition in the high bits of ``out`` and their place in it below.

    A number of the sorted table that rises with the order: one exchange, no cut points and no group in one task.
    Rows that are equal in ``order`` lie in one partition, so ``order`` ends with what tells rows apart.
    Columns of ``order`` that nothing reads later are left out of the staged table by ``drop``.
    """
    return stage(df.orderBy(*order).withColumn(out, F.monotonically_increasing_id()).drop(*drop), "sorted")


def sorted_positions(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    out: str = "position",
    stage: Stage = materialize,
    drop: Sequence[str] = (),
) -> DataFrame:
    """0-based position of every row in its group, from one range exchange.

    The rows of a group fill stretches of consecutive partitions; the first place and the size of each
    stretch, a row per group and partition, give the offsets.  They are staged, so their true size is known when
    they are joined to the sorted rows.
    """
    placed = place_in_order(df, [*group, *order], stage, drop=drop)
    keyed = placed.withColumn("__key", F.struct(*group, F.shiftright("__at", PLACE_BITS).alias("__part")))
    stretches = keyed.groupBy("__key").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    of_group = [F.col(f"__key.{name}") for name in group] or [F.lit(0)]
    before = _earlier(Window.partitionBy(*of_group).orderBy("__key.__part"))
    shift = F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")
    offsets = stage(stretches.select("__key", shift.alias("__shift")), "offsets")
    return keyed.join(offsets, "__key").withColumn(out, F.col("__at") + F.col("__shift")).drop("__at", "__key", "__shift")


def shuffled_positions(
    df: DataFrame,
    group: Sequence[str],
    key: Sequence[str],
    seed: str,
    out: str = "position",
    stage: Stage = materialize,
    drop: Sequence[str] = (),
) -> DataFrame:
    """0-based position of every row of a group in shuffled order; ``key`` identifies a row.

    The hash is sorted by as 16 bytes, in the order of its hex digits, and not staged; nor are the columns ``drop`` names.
    """
    hashed = df.withColumn("__h", F.unhex(shuffle_hash(seed, *key)))
    return sorted_positions(hashed, group, ["__h", *key], out, stage, ["__h", *drop])


def value_positions(
    df: DataFrame, value: str, key: Sequence[str], seed: str = "tie", out: str = "position", stage: Stage = materialize
) -> DataFrame:
    """1-based position of every row, largest ``value`` first, ties in hash order of ``key``.

    Rows with a null or NaN value have no position and drop out.
    """
    ranked = df.filter(F.col(value).isNotNull() & ~F.isnan(value))
    ranked = ranked.withColumns({"_neg": -F.col(value).cast("double"), "_h": F.unhex(shuffle_hash(seed, *key))})
    placed = sorted_positions(ranked, [], ["_neg", "_h", *key], out, stage, ["_neg", "_h"])
    return placed.withColumn(out, F.col(out) + 1)


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, out: str = "rank", salts: int = 32
) -> DataFrame:
    """The first ``k`` rows of every group with their 1-based rank.

    Two rounds: each group is cut into salted parts that keep k rows each, then
    the parts meet.  The last round sees at most ``salts * k`` rows of a group,
    however many the group had.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    part = Window.partitionBy(*group, "_salt").orderBy(*order)
    kept = salted.withColumn("_r", F.row_number().over(part)).filter(F.col("_r") <= k).drop("_r", "_salt")
    whole = Window.partitionBy(*group).orderBy(*order)
    ranked = kept.withColumn(out, F.row_number().over(whole)).filter(F.col(out) <= k)
    return ranked.withColumn(out, F.col(out).cast("bigint"))


def explode_range(df: DataFrame, length: str, out: str, chunk: int = 4096) -> DataFrame:
    """One row per integer in ``[0, length)``; rows with length 0 or less drop out.

    Long ranges are cut into chunks and the chunks spread over the cluster, so no
    row ever holds a long array.
    """
    last = F.col(length) - 1
    chunked = df.filter(F.col(length) > 0).withColumn(
        "_start", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(chunk).cast("bigint")))
    )
    steps = F.sequence(F.col("_start"), F.least(F.col("_start") + chunk - 1, last))
    return chunked.withColumn(out, F.explode(steps)).drop("_start")


def number_copies(df: DataFrame, out: str = "copy_no") -> DataFrame:
    """Tell equal rows apart by a copy number, for logs without a row id.

    Copies are counted with map-side combining and written out again from the
    count, so a row with very many copies does not weigh on one task.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    blocks = counted.withColumn("_blocks", F.ceil(F.col("_copies") / 1_000_000).cast("bigint"))
    spread = explode_range(blocks, "_blocks", "_block")
    spread = spread.withColumn("_size", F.least(F.lit(1_000_000), F.col("_copies") - F.col("_block") * 1_000_000))
    # only heavy rows have more than one block; hashing row and block spreads them
    spread = spread.repartition("_block", *df.columns)
    numbered = explode_range(spread, "_size", "_at")
    return numbered.select(*df.columns, (F.col("_block") * 1_000_000 + F.col("_at")).alias(out))
