"""The named queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with equivalent SQL if there is any."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, since sums in another order differ in the last bits."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.select(*[F.round(F.col(f"`{n}`"), digits).alias(n) if n in doubles else F.col(f"`{n}`") for n in df.columns])
