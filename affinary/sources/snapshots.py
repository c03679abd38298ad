"""Dated tables: one directory per day in a folder, read as of a day."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinary.sources.scan import read_snapshot
from affinary.sources.sinks import write_table


@dataclass(frozen=True)
class Snapshots:
    """Snapshots of one table under ``folder``; ``stored_key`` is the key's name there, ``key`` the one the jobs use."""

    folder: str
    key: str
    stored_key: str = "key0"

    def write(self, df: DataFrame, day: int) -> None:
        """Store the table as of a day; a snapshot written again replaces the earlier one."""
        write_table(df.withColumnRenamed(self.key, self.stored_key), f"{self.folder}/{day}")

    def days(self, spark: SparkSession) -> list[int]:
        """The days that have a snapshot, oldest first; read from the names of files alone.

        A write that was broken off leaves its files in a hidden folder and does not count.
        """
        try:
            files = spark.read.format("binaryFile").load(f"{self.folder}/*/part-*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        day = F.regexp_extract("path", r"/(\d{8})/part-[^/]*$", 1)
        return sorted(int(row["day"]) for row in files.select(day.alias("day")).filter("day != ''").distinct().collect())

    def read(self, spark: SparkSession, day: int) -> DataFrame:
        """The snapshot of exactly this day."""
        return read_snapshot(spark, self.folder, day, self.key, self.stored_key)

    def as_of(self, spark: SparkSession, day: int) -> DataFrame:
        """The newest snapshot that was there on this day."""
        earlier = [one for one in self.days(spark) if one <= day]
        if not earlier:
            raise LookupError(f"no snapshot up to {day} in {self.folder}")
        return self.read(spark, earlier[-1])
