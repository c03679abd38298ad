"""Reading parquet tables, dated snapshots and feature sources."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinary.functions.columns import conform, narrow_types, path_value, round_floats
from affinary.functions.predicates import Predicate, apply_filters


def scan(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    filters: Iterable[Predicate] | None = None,
    schema: T.StructType | None = None,
    *,
    merge_schema: bool = False,
) -> DataFrame:
    """A parquet table, filtered, then projected.

    Filters on hive partition columns prune directories, the others are pushed
    to the row groups; filter columns need not be among the projected ones.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    if not listed:
        raise ValueError("no paths to read")
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if schema is not None:
        reader = reader.schema(schema)
    df = apply_filters(reader.parquet(*listed), filters)
    return df if columns is None else df.select(*columns)


def scan_optimized(
    spark: SparkSession, paths: str | Sequence[str], types: Mapping[str, str], digits: int = 6, **options
) -> DataFrame:
    """``scan`` with narrow column types and rounded floating columns."""
    return round_floats(narrow_types(scan(spark, paths, **options), types), digits)


def scan_as(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | Mapping[str, str], **options
) -> DataFrame:
    """``scan`` with the columns cast to a schema."""
    return conform(scan(spark, paths, **options), schema)


def partition_values(df: DataFrame, keys: Mapping[str, bool]) -> DataFrame:
    """Add the partition values found in each row's file path; True marks a numeric key."""
    path = F.col("_metadata.file_path")
    return df.withColumns({name: path_value(path, name, numeric=numeric) for name, numeric in keys.items()})


@dataclass(frozen=True)
class FeatureSource:
    """Answers "these columns, under these filters" from one parquet table."""

    spark: SparkSession
    path: str | Sequence[str]

    def extract(self, columns: Sequence[str] | None = None, filters: Iterable[Predicate] | None = None) -> DataFrame:
        return scan(self.spark, self.path, columns, filters)


def read_snapshot(spark: SparkSession, folder: str, day: int, key: str, stored_key: str = "key0") -> DataFrame:
    """The feature snapshot of one day, its key under the name the jobs use."""
    return scan(spark, f"{folder}/{day}").withColumnRenamed(stored_key, key)
