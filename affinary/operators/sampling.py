"""Balancing negatives by item popularity: exact sample sizes, repeatable rows, no pair tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinary.functions.columns import hash_slot, shuffle_hash
from affinary.operators.ordering import SLOT_DIGITS, explode_range, hash_running_sum
from affinary.operators.pairs import union_all
from affinary.operators.ranking import open_positions
from affinary.roles import NEGATIVE, POSITIVE, Resampling, Roles
from affinary.sources.scratch import Stage, materialize


def fraction_of(band: Column, fractions: Mapping[int, float]) -> Column:
    """The fraction set for a band, as a column; null outside the listed bands."""
    choice = F.lit(None).cast("double")
    for value, fraction in fractions.items():
        choice = F.when(band == F.lit(value), F.lit(float(fraction))).otherwise(choice)
    return choice


def quota(fraction: Column, rows: Column) -> Column:
    """Sample size: halves go to the even number."""
    return F.bround(fraction * rows).cast("bigint")


def take_by_hash(
    df: DataFrame, group: Sequence[str], fraction: Column, key: Sequence[str], seed: str, stage: Stage = materialize
) -> DataFrame:
    """Exactly ``round(fraction * n)`` rows of every group, those with the smallest hashes.

    Rows whose group columns are null form groups of their own, as any other value.
    Finds one cut-off hash per group and then filters: slots are counted, the slot
    holding the cut-off is known from the counts, and only that slot's keys are sorted.
    The slots and the cut-offs, a row per group, are staged, so the planner knows their true size and
    sends them to the rows, which are not shuffled then.
    """
    keyed = df.withColumn("_h", shuffle_hash(seed, *key))
    groups, keys = [f"_g{i}" for i in range(len(group))], [f"_k{i}" for i in range(len(key))]
    narrow = keyed.select(
        F.struct(*[F.col(name).alias(renamed) for name, renamed in zip(group, groups)]).alias("_group"),
        *[F.col(name).alias(renamed) for name, renamed in zip(key, keys)],
        "_h",
        F.substring("_h", 1, SLOT_DIGITS).alias("_slot"),
        fraction.alias("_fraction"),
    )

    slots = narrow.groupBy("_group", "_slot").agg(F.count(F.lit(1)).alias("_n"), F.first("_fraction").alias("_fraction"))
    whole = Window.partitionBy("_group")
    earlier = whole.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select(
        "_group",
        "_slot",
        "_n",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        quota(F.col("_fraction"), F.sum("_n").over(whole)).alias("_quota"),
    )
    last = slots.filter((F.col("_before") < F.col("_quota")) & (F.col("_quota") <= F.col("_before") + F.col("_n")))
    last = stage(last.select("_group", "_slot", (F.col("_quota") - F.col("_before")).alias("_need")), "cut_slots")

    inside = Window.partitionBy("_group", "_slot").orderBy("_h", *keys)
    ranked = narrow.join(last, ["_group", "_slot"]).withColumn("_rank", F.row_number().over(inside))
    cut = ranked.filter(F.col("_rank") == F.col("_need")).select("_group.*", F.struct("_h", *keys).alias("_cut"))
    cut = stage(cut, "cuts")

    matches = [keyed[name].eqNullSafe(cut[renamed]) for name, renamed in zip(group, groups)]
    mine = F.struct(F.col("_h"), *[F.col(name).alias(f"_k{i}") for i, name in enumerate(key)])
    return keyed.join(cut, matches).filter(mine <= F.col("_cut")).select(*df.columns)


def thin_negatives(
    df: DataFrame, plan: Resampling, key: Sequence[str], roles: Roles = Roles(), stage: Stage = materialize
) -> DataFrame:
    """Keep positives, keep negatives of popular bands, keep a fraction of tail-band negatives per day.

    Negatives outside every listed band are dropped, as configured bands are the
    only ones a model should learn from.
    """
    label, band = F.col(roles.label), F.col(roles.band)
    negative = label == NEGATIVE
    whole = df.filter((label != NEGATIVE) | (negative & band.isin(list(plan.popular))))
    tail = df.filter(negative & band.isin(list(plan.tail)))
    if plan.thins_tail:
        fraction = fraction_of(band, plan.tail)
        tail = take_by_hash(tail, [roles.band, roles.event_date], fraction, key, plan.seed, stage)
    return union_all(whole, tail)


def popular_pool(df: DataFrame, plan: Resampling, roles: Roles = Roles()) -> DataFrame:
    """Distinct popular items per day, among the positives, with their features and band."""
    columns = [roles.item_id, *roles.item_features, *roles.context_features, roles.event_date, roles.band]
    positives = df.filter((F.col(roles.label) == POSITIVE) & F.col(roles.band).isin(list(plan.popular)))
    return positives.select(*columns).distinct()


def active_users(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Distinct users per day with a positive, with their features."""
    positives = df.filter(F.col(roles.label) == POSITIVE)
    return positives.select(roles.user_id, *roles.user_features, roles.event_date).distinct()


def _indexed_users(users: DataFrame, roles: Roles, seed: str) -> DataFrame:
    """Active users with a shuffled 0-based index inside their day."""
    key = [name for name in users.columns if name != roles.event_date]
    return hash_running_sum(users, [roles.event_date], key, seed, out="_x")


def _cells(pool: DataFrame, indexed: DataFrame, df: DataFrame, plan: Resampling, roles: Roles, stage: Stage):
    """One row per pool entry with the number of users it may be paired with.

    A cell stands for all pairs of one popular item with the active users of its
    day.  The pairs are counted, never listed: users of the day minus the users
    who already have a label with the item.  ``_cell`` orders the cells; ``_id`` names
    them, from an encoding that keeps nulls and any characters of values apart.
    """
    date, item, user = roles.event_date, roles.item_id, roles.user_id
    per_day = indexed.groupBy(date).agg(F.count(F.lit(1)).alias("_users"))
    columns = pool.columns
    cells = pool.join(per_day, date).withColumns(
        {
            "_cell": shuffle_hash(plan.seed, *columns),
            "_id": F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})),
            "_shift": hash_slot(F.col("_users"), f"{plan.seed}-start", *columns),
        }
    )
    cells = stage(cells, "cells")

    labelled = df.filter(F.col(roles.label) != NEGATIVE).select(user, item).distinct()
    labelled = labelled.join(pool.select(item).distinct(), item, "left_semi")
    taken = labelled.join(indexed.select(user, date, "_x"), user)
    taken = taken.join(cells.select(item, date, "_id", "_shift", "_users"), [item, date])
    taken = stage(taken.select("_id", F.pmod(F.col("_x") - F.col("_shift"), F.col("_users")).alias("_at")), "taken")

    counts = taken.groupBy("_id").agg(F.count(F.lit(1)).alias("_taken"))
    free = (F.col("_users") - F.coalesce(F.col("_taken"), F.lit(0))).alias("_free")
    return cells.join(counts, "_id", "left").select(*cells.columns, free), taken


def synthetic_negative_counts(
    df: DataFrame,
    pool: DataFrame,
    plan: Resampling,
    roles: Roles = Roles(),
    stage: Stage = materialize,
) -> DataFrame:
    """How many synthetic negatives each day and band could supply."""
    indexed = stage(_indexed_users(active_users(df, roles), roles, plan.seed), "active")
    cells, _ = _cells(stage(pool, "pool"), indexed, df, plan, roles, stage)
    return cells.groupBy(roles.event_date, roles.band).agg(F.sum("_free").alias("n_pairs"))


def synthetic_negatives(
    df: DataFrame,
    pool: DataFrame,
    plan: Resampling,
    roles: Roles = Roles(),
    stage: Stage = materialize,
) -> DataFrame:
    """A sample of unlabelled (active user, popular item) pairs, exactly the set fraction per band.

    Systematic sampling: a band's quota is spread over its cells in proportion to
    their free pairs, and a cell takes consecutive free users of its day's
    shuffled list from a random start.  Every free pair of a band is equally
    likely, and the work grows with the sample, not with users times items.

    The small tables every step needs again (users with their index, cells, taken
    places, draws) are staged once.
    """
    date, band = roles.event_date, roles.band
    indexed = stage(_indexed_users(active_users(df, roles), roles, plan.seed), "active")
    cells, taken = _cells(stage(pool, "pool"), indexed, df, plan, roles, stage)
    cells = stage(cells, "free")

    free = F.col("_free")
    totals = cells.groupBy(band).agg(F.sum("_free").alias("_total"))
    totals = totals.withColumn("_quota", quota(fraction_of(F.col(band), plan.popular), F.col("_total")))
    placed = hash_running_sum(cells, [band], ["_cell"], f"{plan.seed}-cell", free, "_before", tie=["_id"])
    placed = placed.join(totals, band)
    # share of the quota due after and before this cell; decimals hold the products
    share = "(cast({} as decimal(19)) * cast(_quota as decimal(19))) div cast(_total as decimal(19))"
    draw = F.expr(share.format("_before + _free")) - F.expr(share.format("_before"))
    drawn = placed.select(*pool.columns, "_id", "_shift", "_users", draw.alias("_draw")).filter(F.col("_draw") > 0)
    drawn = stage(drawn, "draws")

    bounds = drawn.select("_id", F.col("_users").alias("_end"), F.col("_draw").alias("_limit"))
    runs = open_positions(bounds, taken.join(drawn.select("_id"), "_id", "left_semi"), "_id", "_at")
    picked = explode_range(runs, "_length", "_step").select("_id", (F.col("_start_at") + F.col("_step")).alias("_at"))
    located = picked.join(drawn, "_id").withColumn("_x", F.pmod(F.col("_at") + F.col("_shift"), F.col("_users")))
    pairs = located.join(indexed, [date, "_x"])
    return pairs.select(*pool.columns, *[name for name in indexed.columns if name not in (date, "_x")])


def add_synthetic_negatives(
    df: DataFrame,
    pool: DataFrame | None,
    plan: Resampling,
    columns: Sequence[str],
    roles: Roles = Roles(),
    stage: Stage = materialize,
) -> DataFrame:
    """Append synthetic negatives (label 1, weight 1) when any band asks for them."""
    if not plan.adds_negatives or pool is None:
        return df.select(*columns)
    types = dict(df.dtypes)
    extra = synthetic_negatives(df, pool, plan, roles, stage).withColumns(
        {
            roles.label: F.lit(NEGATIVE).cast(types[roles.label]),
            roles.weight: F.lit(1.0).cast(types[roles.weight]),
        }
    )
    missing = {name: F.lit(None).cast(types[name]) for name in columns if name not in extra.columns}
    unknown = set(missing) - {roles.row_id, roles.duration}
    if unknown:
        raise ValueError(f"synthetic negatives have no value for {sorted(unknown)}")
    return union_all(df.select(*columns), extra.withColumns(missing).select(*columns))


def resample_check(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Rows, distinct items and rows per item for every band and label."""
    counted = df.groupBy(roles.band, roles.label).agg(
        F.count(roles.label).alias("n_sample"), F.countDistinct(roles.item_id).alias("n_item")
    )
    rated = counted.withColumn("rate", F.col("n_sample") / F.col("n_item"))
    return rated.orderBy(F.desc(roles.label), F.desc("n_sample"), roles.band)


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: str = "sample", *, tail: bool = False) -> DataFrame:
    """``n`` random rows, from the low or the high end of the hash order."""
    hashed = df.withColumn("_h", shuffle_hash(seed, *key))
    order = [F.desc("_h"), *[F.desc(name) for name in key]] if tail else ["_h", *key]
    return hashed.orderBy(*order).limit(n).drop("_h")
