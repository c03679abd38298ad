"""Cutting tables into reproducible training batches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinary.functions.calendar import iso_week, iso_year
from affinary.functions.columns import shuffle_hash
from affinary.operators.ordering import shuffled_positions
from affinary.roles import Roles
from affinary.sources.scan import scan
from affinary.sources.scratch import Stage, materialize
from affinary.sources.sinks import write_table


def shuffled(df: DataFrame, key: Sequence[str], seed: str = "shuffle") -> DataFrame:
    """The rows in a random but repeatable order (a range-partitioned sort)."""
    return df.withColumn("_h", shuffle_hash(seed, *key)).orderBy("_h", *key).drop("_h")


def add_batches(
    df: DataFrame,
    batch_size: int,
    key: Sequence[str],
    roles: Roles = Roles(),
    seed: str = "shuffle",
    mini_batches: int = 1,
    stage: Stage = materialize,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Number the batches of each date: shuffled position divided by the batch size.

    All batches of a date are full but its last.  ``mini_batches`` divides the
    size, for tables that are read in that many parts.  The rows are read back from a table sorted by
    date and batch, so a task that reads it holds whole runs of batches.  With ``keep`` it has these columns, the
    date and the batch only.
    """
    size = max(batch_size // mini_batches, 1)
    unread = [] if keep is None else [name for name in df.columns if name not in (*keep, roles.event_date)]
    placed = shuffled_positions(df, [roles.event_date], key, seed, "_position", stage, unread)
    return placed.withColumn(roles.batch, F.expr(f"_position div {size}")).drop("_position")


def fixed_batches(df: DataFrame, batch_size: int, key: Sequence[str], seed: str = "shuffle") -> DataFrame:
    """Number the batches of a whole table, all full but the last."""
    placed = shuffled_positions(df, [], key, seed, "_position")
    return placed.withColumn("batch", F.expr(f"_position div {batch_size}")).drop("_position")


def batch_catalog(df: DataFrame, roles: Roles = Roles(), *, with_files: bool = False) -> DataFrame:
    """Rows per (date, batch); with the files holding them when read from disk."""
    batch = [roles.event_date, roles.batch]
    if not with_files:
        return df.groupBy(*batch).agg(F.count(F.lit(1)).alias("n_rows"))
    # counted per file first: names are collected from a row per batch and file, not from every row
    per_file = df.groupBy(*batch, F.col("_metadata.file_path").alias("_file")).agg(F.count(F.lit(1)).alias("_n"))
    files = F.sort_array(F.collect_list("_file")).alias("files")
    return per_file.groupBy(*batch).agg(F.sum("_n").alias("n_rows"), files)


def batch_order(catalog: DataFrame, roles: Roles = Roles(), seed: str = "order", *, by_week: bool = False) -> DataFrame:
    """Global reading order: batches shuffled inside each day (or ISO week), periods in time order."""
    date = roles.event_date
    period = [iso_year(date).alias("_p1"), iso_week(date).alias("_p2")] if by_week else [F.col(date).alias("_p1"), F.lit(0).alias("_p2")]
    keyed = catalog.select("*", *period)
    inside = shuffled_positions(keyed, ["_p1", "_p2"], [date, roles.batch], seed, "_inside")
    # one row per period
    sizes = keyed.groupBy("_p1", "_p2").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_p1", "_p2").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    placed = inside.join(starts, ["_p1", "_p2"])
    return placed.withColumn("read_index", F.col("_start") + F.col("_inside")).select(*catalog.columns, "read_index")


def count_mini_batches(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    return df.agg(F.countDistinct(roles.batch).alias("n_mini_batches"))


def read_batch(
    spark: SparkSession, path: str, day: int, batch: int, features: Sequence[str], roles: Roles = Roles()
) -> DataFrame:
    """One batch of a stored training set as (values, label, weight); only its directories are read."""
    rows = scan(
        spark, path, [*features, roles.weight, roles.label], [(roles.event_date, "==", day), (roles.batch, "==", batch)]
    )
    return batch_values(rows, features, roles).select("values", "label", "weight")


@dataclass(frozen=True)
class StoredBatches:
    """A stored training set and its manifest: (date, batch, n_rows, files, read_index), a row per batch.

    The manifest is a table of its own, so a batch is read without listing the directories of the set.
    """

    path: str
    manifest: str
    roles: Roles = Roles()

    def write_manifest(self, spark: SparkSession, seed: str = "order", *, by_week: bool = False) -> DataFrame:
        """List the batches and the files that hold them, in reading order; rows are counted, not read."""
        catalog = batch_catalog(spark.read.parquet(self.path), self.roles, with_files=True)
        write_table(batch_order(catalog, self.roles, seed, by_week=by_week), self.manifest)
        return self.entries(spark)

    def entries(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.manifest)

    def read(self, spark: SparkSession, features: Sequence[str], indexes: Sequence[int]) -> DataFrame:
        """(read_index, values, label, weight) of the batches with these places in the reading order.

        Reads their files and no others, and of files that hold many batches the row groups the asked
        ones may lie in; the driver holds the entries of the asked batches.
        """
        date, batch = self.roles.event_date, self.roles.batch
        picked = self.entries(spark).filter(F.col("read_index").isin(*indexes)).select(date, batch, "read_index", "files").collect()
        files = [name for row in picked for name in row["files"]]
        rows = spark.read.option("basePath", self.path).parquet(*files) if files else spark.read.parquet(self.path).limit(0)
        # in a set without a directory per batch this is pushed to the row groups
        rows = rows.filter(F.col(batch).isin(*{row[batch] for row in picked}))
        places = spark.createDataFrame([tuple(row)[:3] for row in picked], "_date bigint, _batch bigint, read_index bigint")
        # a row per asked batch
        told = rows.join(F.broadcast(places), (F.col(date) == F.col("_date")) & (F.col(batch) == F.col("_batch")))
        return batch_values(told, features, self.roles).select("read_index", "values", "label", "weight")


def batch_values(df: DataFrame, features: Sequence[str], roles: Roles = Roles()) -> DataFrame:
    """Add the feature vector, label and weight a learner reads."""
    assembled = VectorAssembler(inputCols=list(features), outputCol="values").transform(df)
    return assembled.withColumns({"label": F.col(roles.label), "weight": F.col(roles.weight)})


def training_batch_key(roles: Roles) -> list[str]:
    """Columns that tell the rows of a training set apart."""
    key = [*roles.pair, roles.event_date, roles.label]
    return [*key, roles.row_id] if roles.row_id else key
