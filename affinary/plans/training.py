"""From the interaction log to a training set."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame

from affinary.functions.calendar import DEFAULT_DATE
from affinary.functions.columns import fill_date
from affinary.functions.predicates import Predicate, apply_filters
from affinary.operators.assembly import add_weekend
from affinary.operators.batching import add_batches, training_batch_key
from affinary.operators.ordering import number_copies
from affinary.operators.pairs import drop_seen_pairs, resolve_labels
from affinary.operators.sampling import add_synthetic_negatives, popular_pool, thin_negatives
from affinary.roles import JobSpec
from affinary.sources.scratch import Stage, materialize
from affinary.sources.sinks import training_columns


def window_rows(log: DataFrame, filters: Iterable[Predicate], spec: JobSpec) -> DataFrame:
    """The rows of one split with their context features."""
    rows = apply_filters(fill_date(log, spec.roles.event_date, DEFAULT_DATE), filters)
    return add_weekend(rows, spec.roles)


def training_set(
    log: DataFrame,
    filters: Iterable[Predicate],
    features: Sequence[str],
    spec: JobSpec,
    *,
    seen: DataFrame | None = None,
    mini_batches: int = 1,
    stage: Stage = materialize,
) -> DataFrame:
    """Filter, settle labels, resample negatives, shuffle into batches, drop incomplete rows.

    With ``seen`` (the pairs trained on) this is the validation side: those pairs
    are dropped and no synthetic negatives are added.  Settled rows are written to the
    shared folder once, since resampling takes several passes, and once more in the order of
    their batches, the only exchange that carries resampled rows.
    """
    roles, plan = spec.roles, spec.resampling
    rows = window_rows(log, filters, spec)
    is_training = seen is None
    pool = popular_pool(rows, plan, roles) if is_training and plan.active and plan.adds_negatives else None
    if not is_training:
        rows = drop_seen_pairs(rows, seen, roles)
    columns = list(
        dict.fromkeys([*training_batch_key(roles), roles.band, *features, roles.label, roles.weight, roles.event_date])
    )
    settled = resolve_labels(rows.select(*columns), roles)
    if roles.row_id is None:
        # equal rows would all hash alike; a copy number keeps them apart
        roles = replace(roles, row_id="copy_no")
        columns.append("copy_no")
        settled = number_copies(settled, "copy_no")
    key = training_batch_key(roles)
    if plan.active:
        settled = stage(settled, "settled")
        thinned = thin_negatives(settled, plan, key, roles, stage)
        settled = add_synthetic_negatives(thinned, pool, plan, columns, roles, stage)
    batched = add_batches(settled, spec.batch_size, key, roles, mini_batches=mini_batches, stage=stage)
    return batched.select(*training_columns(roles, features)).dropna("any")
