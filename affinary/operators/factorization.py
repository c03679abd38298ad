"""A click model with pairwise feature interactions, in a form that can rank without scoring every pair.

A factorization machine adds, to a weight per feature, the dot product of the
factor vectors of every two features.  Split by side, the score of a pair is

    (user part)  +  (item part)  +  (sum of user factors) . (sum of item factors)

The user part does not change the order of a user's items, so a user becomes the
vector (sum of factors, 1), an item becomes (sum of factors, item part), and the
best items are those with the greatest dot product (see ``operators.retrieval``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml.classification import FMClassificationModel, FMClassifier
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinary.operators.learning import clicked
from affinary.roles import Roles


def _hash(df: DataFrame, columns: Sequence[str], size: int, out: str) -> DataFrame:
    hasher = FeatureHasher(inputCols=list(columns), categoricalCols=list(columns), numFeatures=size, outputCol=out)
    return hasher.transform(df)


@dataclass(frozen=True)
class FactorModel:
    """``user_features`` hold the user's and the day's columns, ``item_features`` the item's.

    Each side is hashed into ``size`` slots of its own, so a user feature and an
    item feature never share a slot and the split above is exact.
    """

    user_features: tuple[str, ...]
    item_features: tuple[str, ...]
    size: int
    model: FMClassificationModel

    def _inputs(self, df: DataFrame) -> DataFrame:
        return _inputs(df, self.user_features, self.item_features, self.size)

    def score(self, df: DataFrame, out: str = "prediction", logit: str = "logit") -> DataFrame:
        """Add probability and logit to given pairs; rows with a missing feature are dropped first."""
        complete = df.dropna("any", subset=[*self.user_features, *self.item_features])
        scored = self.model.transform(self._inputs(complete))
        return scored.select(
            *df.columns,
            vector_to_array("rawPrediction")[1].alias(logit),
            vector_to_array("probability")[1].alias(out),
        )

    def _weights(self, df: DataFrame, first: int) -> DataFrame:
        """Weight and factors of one side's slots as a table of ``size`` rows."""
        factors, linear = self.model.factors, self.model.linear
        dense = factors.toArray()[first : first + self.size]
        rows = [
            (slot, float(linear[first + slot]), [float(value) for value in dense[slot]])
            for slot in range(self.size)
            if dense[slot].any() or linear[first + slot]
        ]
        return df.sparkSession.createDataFrame(rows, "_slot int, _w double, _v array<double>")

    def _vectors(self, df: DataFrame, key: str, columns: Sequence[str], first: int, *, is_item: bool) -> DataFrame:
        complete = df.select(*dict.fromkeys([key, *columns])).dropna("any", subset=list(columns))
        hashed = _hash(complete, columns, self.size, "_x").select(key, F.unwrap_udt("_x").alias("_x"))
        slots = hashed.select(key, F.explode(F.arrays_zip("_x.indices", "_x.values")).alias("_f"))
        slots = slots.select(key, F.col("_f.indices").alias("_slot"), F.col("_f.values").alias("_value"))
        joined = slots.join(self._weights(df, first), "_slot")
        rank = self.model.getFactorSize()
        sums = [F.sum(F.col("_v")[d] * F.col("_value")) for d in range(rank)]
        squares = [F.sum(F.pow(F.col("_v")[d] * F.col("_value"), 2)) for d in range(rank)]
        summed = joined.groupBy(key).agg(
            F.sum(F.col("_w") * F.col("_value")).alias("_linear"),
            F.array(*sums).alias("_sum"),
            F.array(*squares).alias("_square"),
        )
        own = F.aggregate(
            F.zip_with("_sum", "_square", lambda s, q: (s * s - q) / 2), F.lit(0.0), lambda total, x: total + x
        )
        last = F.col("_linear") + own if is_item else F.lit(1.0)
        vectors = summed.select(key, F.concat("_sum", F.array(last)).alias("vector"))
        # an id whose slots were never trained has a zero vector
        zero = F.array(*[F.lit(0.0)] * rank, F.lit(0.0 if is_item else 1.0))
        everyone = complete.select(key).join(vectors, key, "left")
        return everyone.select(key, F.coalesce("vector", zero).alias("vector"))

    def user_vectors(self, users: DataFrame, roles: Roles = Roles()) -> DataFrame:
        return self._vectors(users, roles.user_id, self.user_features, 0, is_item=False)

    def item_vectors(self, items: DataFrame, roles: Roles = Roles()) -> DataFrame:
        return self._vectors(items, roles.item_id, self.item_features, self.size, is_item=True)


def _inputs(df: DataFrame, user_features: Sequence[str], item_features: Sequence[str], size: int) -> DataFrame:
    hashed = _hash(_hash(df, user_features, size, "_xu"), item_features, size, "_xi")
    return VectorAssembler(inputCols=["_xu", "_xi"], outputCol="_x").transform(hashed)


def fit_factor_model(
    df: DataFrame,
    user_features: Sequence[str],
    item_features: Sequence[str],
    roles: Roles = Roles(),
    size: int = 1 << 13,
    factors: int = 8,
    max_iter: int = 50,
    seed: int = 42,
    **params: Any,
) -> FactorModel:
    """Fit on rows with label and features.  The learner knows no row weights.

    ``size`` slots per side should be far above the number of categories, which share weights where they share a slot.
    """
    complete = df.select(*user_features, *item_features, roles.label).dropna("any")
    prepared = _inputs(complete, user_features, item_features, size)
    prepared = prepared.select("_x", F.when(clicked(roles), 1.0).otherwise(0.0).alias("_y"))
    learner = FMClassifier(
        featuresCol="_x", labelCol="_y", factorSize=factors, maxIter=max_iter, seed=seed, **params
    )
    return FactorModel(tuple(user_features), tuple(item_features), size, learner.fit(prepared))
