"""Daily refits from stored sums.

The closed-form model (``operators.additive``) learns from weighted sums per category.  Those of each
day are stored once, in a folder per day, so a refit adds the newest days' rows and reads the other days as
sums: its cost is one day of the log plus a number of categories per day, however long the window is.
Older days may count less: a day's sums are multiplied by ``decay`` to the power of its age.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinary.functions.calendar import days_before, to_day
from affinary.operators.additive import ALL_ROWS, AdditiveModel, Cross, click_counts, model_from_counts
from affinary.roles import Roles
from affinary.sources.scratch import Stage, materialize
from affinary.sources.sinks import write_table

STATE_COLUMNS = "feature string, value string, other string, pos double, neg double"


@dataclass(frozen=True)
class CountStore:
    """Sums per day and category under ``path``, for the model of these features and interactions.

    A store belongs to one set of features; another set needs another path.
    """

    path: str
    features: tuple[str, ...]
    crosses: tuple[Cross, ...] = ()
    roles: Roles = Roles()

    def read(self, spark: SparkSession) -> DataFrame:
        """(feature, value, other, pos, neg, day); empty when nothing was stored yet."""
        schema = f"{STATE_COLUMNS}, day int"
        try:
            return spark.read.schema(schema).option("basePath", self.path).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def days(self, spark: SparkSession) -> set[int]:
        """The days that are stored, one number each."""
        whole = self.read(spark).filter(F.col("feature") == ALL_ROWS)
        return {row["day"] for row in whole.select("day").distinct().collect()}

    def add(self, rows: DataFrame, wanted: Sequence[int]) -> None:
        """Store the sums of these days; a day stored before is replaced, so a repeated run changes nothing.

        A day without rows is stored with sums of 0, so that it counts as done.
        """
        if not wanted:
            return
        day = self.roles.event_date
        # literals on the date column prune the log's directories
        picked = rows.filter(F.col(day).isin(*wanted))
        counts = click_counts(picked, self.features, self.roles, self.crosses, by=[day])
        zeros = rows.sparkSession.createDataFrame([(number, ALL_ROWS, "", None, 0.0, 0.0) for number in wanted], f"day int, {STATE_COLUMNS}")
        counts = counts.withColumnRenamed(day, "day").withColumn("day", F.col("day").cast("int"))
        sums = counts.unionByName(zeros).groupBy("day", "feature", "value", "other")
        state = sums.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        write_table(state.repartition("day"), self.path, ["day"], "replace_partitions")

    def merged(self, spark: SparkSession, wanted: Sequence[int], today: int, decay: float = 1.0) -> DataFrame:
        """The sums of some days as one state, a day of age n weighed by ``decay`` to the power n."""
        state = self.read(spark).filter(F.col("day").isin(*wanted))
        age = F.datediff(to_day(F.lit(today)), to_day("day"))
        weight = F.pow(F.lit(float(decay)), age.cast("double"))
        sums = state.groupBy("feature", "value", "other")
        return sums.agg(F.sum(F.col("pos") * weight).alias("pos"), F.sum(F.col("neg") * weight).alias("neg"))


def window_days(today: int, days: int) -> list[int]:
    """``today`` and the days before it, oldest first."""
    return [days_before(today, back) for back in range(days - 1, -1, -1)]


def refit(
    log: DataFrame,
    store: CountStore,
    today: int,
    days: int,
    decay: float = 1.0,
    newest: int = 1,
    smoothing: float = 1.0,
    cross_smoothing: float = 10.0,
    stage: Stage = materialize,
) -> AdditiveModel:
    """The model of the ``days`` days up to ``today``.

    Reads from the log only the ``newest`` days, whose rows may still have changed, and days of the window that the store
    lacks: all of them at the first run, which is the full training.
    """
    spark = log.sparkSession
    wanted = window_days(today, days)
    stored = store.days(spark)
    store.add(log, [day for number, day in enumerate(reversed(wanted)) if number < newest or day not in stored])
    counts = stage(store.merged(spark, wanted, today, decay), "merged-counts")
    return model_from_counts(counts, store.features, store.crosses, smoothing, cross_smoothing, stage)
