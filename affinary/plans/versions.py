"""Models kept by date, and their evaluation on features as they were on the day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinary.operators.additive import ALL_ROWS, AdditiveModel, cross_name
from affinary.operators.pairs import union_all
from affinary.operators.slices import slice_report
from affinary.plans.evaluation import EvaluationData, ranked_rows
from affinary.roles import Roles
from affinary.sources.scratch import Stage, materialize
from affinary.sources.snapshots import Snapshots

_ROWS = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("other", T.StringType()),
        T.StructField("part", T.DoubleType()),
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("crosses", T.ArrayType(T.ArrayType(T.StringType()))),
    ]
)


@dataclass(frozen=True)
class ModelStore:
    """Closed-form models, one table per date: a row per category, and a row that says what the model is made of."""

    folder: str

    @property
    def _tables(self) -> Snapshots:
        return Snapshots(self.folder, "feature", "feature")

    def save(self, model: AdditiveModel, day: int) -> None:
        spark = model.parts.sparkSession
        about = [(ALL_ROWS, None, None, model.base, list(model.features), [list(cross) for cross in model.crosses])]
        tables = [spark.createDataFrame(about, _ROWS), model.parts]
        if model.cross_parts is not None:
            tables.append(model.cross_parts)
        rows = tables[0]
        for table in tables[1:]:
            rows = rows.unionByName(table, allowMissingColumns=True)
        self._tables.write(rows.select(*_ROWS.names), day)

    def days(self, spark: SparkSession) -> list[int]:
        return self._tables.days(spark)

    def load(self, spark: SparkSession, day: int) -> AdditiveModel:
        """The model of exactly this day; a LookupError if there is none."""
        if day not in self.days(spark):
            raise LookupError(f"no model of {day} in {self.folder}")
        rows = self._tables.read(spark, day)
        about = rows.filter(F.col("feature") == ALL_ROWS).first()
        crosses = tuple((a, b) for a, b in about["crosses"])
        names = [cross_name(cross) for cross in crosses]
        parts = rows.filter(F.col("feature").isin(*about["features"])).select("feature", "value", "part")
        cross_parts = rows.filter(F.col("feature").isin(*names)).select("feature", "value", "other", "part") if crosses else None
        return AdditiveModel(tuple(about["features"]), about["part"], parts, crosses, cross_parts)


def scored_candidates(
    model: AdditiveModel, users: DataFrame, items: DataFrame, roles: Roles = Roles(), digits: int = 9
) -> tuple[DataFrame, DataFrame]:
    """Items with the part of the logit that orders them, and the users that can be scored.

    Users and items that lack a feature of their side, or hold null in it, are dropped: so are all candidates they
    would be in.  Features of neither side belong to the day and order nothing.
    """
    mine = [name for name in model.features if name in users.columns and name != roles.user_id]
    theirs = [name for name in model.features if name in items.columns and name != roles.item_id]
    mixed = [cross for cross in model.crosses if (cross[0] in theirs) != (cross[1] in theirs)]
    if mixed:
        raise ValueError(f"items are not ordered alike for every user with interactions of both sides: {mixed}")
    scored = model.part(items.dropna("any", subset=theirs), theirs, "_score")
    complete = users.dropna("any", subset=mine) if mine else users
    return scored.select(roles.item_id, F.round("_score", digits).alias("score")), complete


def evaluate_versions(
    data: EvaluationData,
    models: ModelStore,
    versions: Mapping[str, int],
    users: Snapshots,
    items: Snapshots,
    day: int,
    slices: Sequence[str],
    metrics: Sequence[str],
    roles: Roles = Roles(),
    top_k: int = 1000,
    stage: Stage = materialize,
) -> DataFrame:
    """The sliced report of model versions given by date, over the same rows and the features as of ``day``.

    ``slices`` name columns of the user or the item snapshot.
    """
    spark = data.rows.sparkSession
    people, goods = users.as_of(spark, day), items.as_of(spark, day)
    catalog = goods.join(data.history.select(roles.item_id).distinct(), roles.item_id, "left_semi")
    of_items = [name for name in slices if name in goods.columns]
    of_users = [name for name in slices if name not in of_items]
    reports = []
    for name, version in versions.items():
        scored, complete = scored_candidates(models.load(spark, version), people, catalog, roles)
        ranked = ranked_rows(data, stage(scored, "scores"), "score", roles, top_k, complete, stage)
        if of_users:
            ranked = ranked.join(people.select(roles.user_id, *of_users), roles.user_id)
        if of_items:
            ranked = ranked.join(goods.select(roles.item_id, *of_items), roles.item_id)
        found = slice_report(ranked, slices, metrics, roles)
        reports.append(found.select(F.lit(name).alias("model"), F.lit(version).alias("version"), "*"))
    return union_all(*reports)
