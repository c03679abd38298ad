"""Joining features onto pairs, and lookups that encode categories."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinary.functions.calendar import is_weekend, weekend_of
from affinary.functions.columns import string_part
from affinary.operators.ordering import null_safe_join
from affinary.roles import Roles

# Joins carry no hints: Spark broadcasts a side whose measured size is under
# spark.sql.autoBroadcastJoinThreshold and sorts and merges, splitting hot keys,
# above it.


def add_features(
    pairs: DataFrame, user_features: DataFrame | None, item_features: DataFrame, roles: Roles = Roles()
) -> DataFrame:
    """Inner join pairs with user features, when there are any, and item features."""
    if user_features is not None and not user_features.isEmpty():
        pairs = pairs.join(user_features, roles.user_id)
    return pairs.join(item_features, roles.item_id)


def add_weekend(df: DataFrame, roles: Roles = Roles(), day: int | None = None) -> DataFrame:
    """Weekend flag of each row's date, or of one given date."""
    flag = is_weekend(roles.event_date) if day is None else F.lit(weekend_of(day))
    return df.withColumn("is_weekend", flag)


def assemble(
    pairs: DataFrame,
    user_features: DataFrame | None,
    item_features: DataFrame,
    roles: Roles = Roles(),
    day: int | None = None,
) -> DataFrame:
    return add_weekend(add_features(pairs, user_features, item_features, roles), roles, day)


def add_user_context(df: DataFrame, snapshot: DataFrame, day: int, roles: Roles = Roles()) -> DataFrame:
    """Inner join the user context recorded for ``day``."""
    columns = [roles.user_id, *roles.user_context_features]
    today = snapshot.filter(F.col(roles.event_date) == day).select(*columns)
    return df.join(today, roles.user_id)


def add_account_features(profiles: DataFrame, accounts: DataFrame, id_column: str) -> DataFrame:
    """Left join account features onto profiles by the part of the id after ``#``.

    An account listed twice would multiply its profiles, which is an error; rows
    left with a null are dropped.
    """
    keyed_profiles = profiles.withColumn("account", string_part(id_column, "#", 1))
    keyed_accounts = accounts.withColumn("account", string_part(id_column, "#", 1)).drop(id_column)
    repeated = keyed_accounts.groupBy("account").count().filter("count > 1").select("account")
    if not null_safe_join(repeated, keyed_profiles.select("account"), ["account"], "left_semi").isEmpty():
        raise ValueError("an account occurs more than once, joining it would multiply its profiles")
    joined = null_safe_join(keyed_profiles, keyed_accounts, ["account"], "left")
    return joined.drop("account").dropna("any")


def mapping_table(spark: SparkSession, config: Mapping[str, Any], column: str) -> DataFrame:
    """The ``<column>_mapping`` entry of a settings file as a lookup table."""
    mapping = config.get(f"{column}_mapping") or {}
    if not mapping:
        raise ValueError(f"no mapping for column {column!r}")
    return spark.createDataFrame([(k, int(v)) for k, v in mapping.items()], ["original", "encoded"])


def encode(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Replace a category by its code; categories without a code become null."""
    codes = mapping.select(F.col("original").alias(column), F.col("encoded").cast("int").alias("_code"))
    order = [F.col("_code").alias(column) if name == column else F.col(name) for name in df.columns]
    return df.join(codes, column, "left").select(*order)
