"""Writing tables, training sets and reports."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinary.functions.columns import conform
from affinary.roles import Roles

_MODES = ("overwrite", "append", "replace_partitions")


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    schema: T.StructType | None = None,
) -> None:
    """Write parquet.

    ``replace_partitions`` replaces the partitions the data touches and leaves
    the others; ``overwrite`` replaces the whole table.
    """
    if mode not in _MODES:
        raise ValueError(f"mode must be one of {_MODES}, not {mode!r}")
    if mode == "replace_partitions" and not partition_by:
        raise ValueError("replacing partitions needs partition columns")
    if schema is not None:
        df = conform(df.select(*schema.names), schema)
    scope = "dynamic" if mode == "replace_partitions" else "static"
    writer = df.write.mode("append" if mode == "append" else "overwrite").option("partitionOverwriteMode", scope)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def training_columns(roles: Roles, features: Sequence[str]) -> list[str]:
    """Layout of a training table: date, batch, features in model order, weight, label."""
    return [roles.event_date, roles.batch, *features, roles.weight, roles.label]


def write_training_set(
    df: DataFrame,
    path: str,
    roles: Roles,
    features: Sequence[str],
    mode: str = "replace_partitions",
    *,
    gather: bool = True,
    batch_directories: bool = True,
) -> None:
    """Write complete rows only, one directory per date, batch and label.

    Writing the same set again replaces its directories; use "overwrite" when a whole
    set is built anew, since it may have fewer batches than before.

    Rows are brought together by date and batch first, so a directory gets one
    file, not one per task; a batch has a fixed number of rows, so no directory
    and no task of this shuffle is large.  Rows that ``add_batches`` numbered lie in the order
    of their batches already: without ``gather`` they are written by the tasks that read them, with a second
    file only where two tasks share a batch.

    A directory per batch is a file per batch and label, whose number grows with the rows.  Without
    ``batch_directories`` there is a directory per date and label, and the batch is a column by which its files are
    sorted: the files grow with the tasks and days only, and row-group bounds find a batch.
    """
    columns = training_columns(roles, features)
    directories = [roles.event_date, roles.batch, roles.label]
    complete = df.select(*columns).dropna("any")
    if batch_directories:
        if gather:
            complete = complete.repartition(roles.event_date, roles.batch)
    else:
        directories.remove(roles.batch)
        if gather:
            complete = complete.repartitionByRange(roles.event_date, roles.batch)
        complete = complete.sortWithinPartitions(*directories, roles.batch)
    write_table(complete, path, directories, mode)


def stamp(df: DataFrame, evaluate_time: str, model_name: str, data_type: str) -> DataFrame:
    """Add what a stored report says about its origin."""
    return df.withColumns(
        {
            "evaluate_time": F.lit(evaluate_time),
            "model_name": F.lit(model_name),
            "data_type": F.lit(data_type),
        }
    )


def write_report(
    report: DataFrame, path: str, slice_column: str = "feature", order_by: Sequence[str | Column] = ()
) -> None:
    """Write a report as CSV with a header, one directory per slicing feature, rows in report order."""
    report = report.repartition(slice_column).sortWithinPartitions(slice_column, *order_by)
    report.write.mode("overwrite").option("header", True).partitionBy(slice_column).csv(path)


def write_predictions(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Store scored rows as parquet or CSV and return them read back."""
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unknown format {fmt!r}")
    writer = df.write.mode("overwrite")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)
    reader = df.sparkSession.read.schema(df.schema)
    return (reader.option("header", True) if fmt == "csv" else reader).format(fmt).load(path)


def to_driver(df: DataFrame, max_rows: int = 100_000) -> pd.DataFrame:
    """A small result as pandas; refuses to pull a large one."""
    local = df.limit(max_rows + 1).toPandas()
    if len(local) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; write it instead")
    return local
