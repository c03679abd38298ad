"""Business dates kept as ``yyyyMMdd`` integers, and the windows cut out of them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from affinary.functions.predicates import parse

DATE_COLUMN = "filename_date"
DEFAULT_DATE = 20230101  # fixed value: the date given to rows of a log without a date column


def days_before(day: int, days: int) -> int:
    """The date ``days`` before ``day``, both as integers."""
    moved = datetime.strptime(str(day), "%Y%m%d") - timedelta(days=days)
    return int(moved.strftime("%Y%m%d"))


def window_filters(
    day: int, days: int | None, *, inclusive: bool = False, column: str = DATE_COLUMN, as_triples: bool = False
) -> list:
    """Filters for the ``days`` days before ``day``; None leaves the start open.

    The bounds are literals on purpose: a literal on the partition column prunes
    directories, an expression over the column would not.
    """
    triples = [(column, "<=" if inclusive else "<", day)]
    if days is not None:
        triples.append((column, ">=", days_before(day, days)))
    return triples if as_triples else [f"{name} {op} {value}" for name, op, value in triples]


@dataclass(frozen=True)
class Split:
    """Date filters of a training run."""

    train: tuple[str, ...]
    validation: tuple[str, ...]


def full_training_split(infer_day: int, days: int, column: str = DATE_COLUMN) -> Split:
    """Train on the ``days`` days before yesterday, validate on yesterday."""
    held_out = days_before(infer_day, 1)
    start = days_before(infer_day, 1 + days)
    return Split((f"{column} >= {start}", f"{column} < {held_out}"), (f"{column} == {held_out}",))


def refit_split(infer_day: int, column: str = DATE_COLUMN) -> Split:
    """Train on yesterday and today; there is no held-out day, validation repeats it."""
    window = (f"{column} >= {days_before(infer_day, 1)}", f"{column} <= {infer_day}")
    return Split(window, window)


def redate(filters: Iterable[str], new: Iterable[str], column: str = DATE_COLUMN) -> list[str]:
    """Replace the date filters of a filter list."""
    return [*new, *(entry for entry in filters if parse(entry)[0] != column)]


def split_for_inference(
    train_filters: Iterable[str],
    validation_filters: Iterable[str],
    infer_day: int,
    days: int = 90,
    *,
    refit: bool = False,
    column: str = DATE_COLUMN,
) -> Split:
    """Move existing filters to the windows of ``infer_day``."""
    full = full_training_split(infer_day, days, column)
    train = full.validation if refit else full.train
    return Split(
        tuple(redate(train_filters, train, column)), tuple(redate(validation_filters, full.validation, column))
    )


def to_day(column: str | Column) -> Column:
    """An integer date as a DATE."""
    return F.to_date((F.col(column) if isinstance(column, str) else column).cast("string"), "yyyyMMdd")


def to_int(day: Column) -> Column:
    """A DATE or TIMESTAMP as an integer date."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def shift_days(column: str, days: int) -> Column:
    """An integer date column moved back by ``days``."""
    return to_int(F.date_sub(to_day(column), days))


def encoded_weekday(column: str | Column) -> Column:
    """0 on Sunday to 6 on Saturday."""
    return F.dayofweek(to_day(column)) - 1


def is_weekend(column: str | Column = DATE_COLUMN) -> Column:
    return F.when(encoded_weekday(column).isin(0, 6), 1).otherwise(0)


def weekend_of(day: int) -> int:
    """The same flag for one date known on the driver."""
    return int(datetime.strptime(str(day), "%Y%m%d").weekday() >= 5)


def iso_year(column: str) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), to_day(column)).cast("int")


def iso_week(column: str) -> Column:
    return F.weekofyear(to_day(column))


def iso_week_key(column: str) -> Column:
    """``year-week`` without padding; sort by ``iso_year`` and ``iso_week`` instead."""
    return F.concat_ws("-", iso_year(column), iso_week(column))
