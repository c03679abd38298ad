"""Column-level work: types, rounding, string parts, stable hashes."""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the type names of the settings files and their Spark names
SPARK_TYPES = {
    "int8": "tinyint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "Int32": "int",
    "Int64": "bigint",
    "float32": "float",
    "float64": "double",
    "string": "string",
    "bool": "boolean",
}


WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")


def spark_type(name: str) -> str:
    return SPARK_TYPES.get(name, name)


def narrow_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast each listed column to its narrow type where all values fit.

    One aggregate finds the columns holding a value that does not fit, or that has a
    fraction a whole type would cut off; those are reported and keep their type, all others
    are cast.  A narrower floating type keeps fewer digits, as it must.
    """
    wanted = {name: spark_type(kind) for name, kind in types.items() if name in df.columns}
    if not wanted:
        return df
    types_now = dict(df.dtypes)

    def does_not_fit(name: str, kind: str) -> Column:
        value, cast = F.col(name), F.col(name).try_cast(kind)
        misfit = cast.isNull()
        if kind in WHOLE_TYPES and types_now[name].split("(")[0] in ("float", "double", "decimal"):
            misfit = misfit | (cast.cast(types_now[name]) != value)
        return F.max(value.isNotNull() & misfit).alias(name)

    lost = df.agg(*[does_not_fit(name, kind) for name, kind in wanted.items()]).first()
    failing = [name for name in wanted if lost[name]]
    for name in failing:
        warnings.warn(f"column {name!r} holds values that do not fit {wanted[name]}, left as it is", stacklevel=2)
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in wanted.items() if name not in failing})


def conform(df: DataFrame, schema: T.StructType | Mapping[str, str]) -> DataFrame:
    """Cast the columns named by a schema; columns it does not name stay."""
    if isinstance(schema, T.StructType):
        casts = {field.name: F.col(field.name).cast(field.dataType) for field in schema}
    else:
        casts = {name: F.col(name).cast(spark_type(kind)) for name, kind in schema.items()}
    return df.withColumns(casts)


def round_floats(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every float and double column, halves to even."""
    floating = [f for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({f.name: F.bround(f.name, digits).cast(f.dataType) for f in floating})


def fill_date(df: DataFrame, column: str, day: int) -> DataFrame:
    """Give every row one date when the log has no date column."""
    return df if column in df.columns else df.withColumn(column, F.lit(day))


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of the columns (all columns by default)."""
    return df.dropna(how="any", subset=columns)


def string_part(column: str, delimiter: str, position: int, *, numeric: bool = False) -> Column:
    """Part ``position`` of a delimited string; null when there is no such part."""
    part = F.get(F.split(F.col(column), re.escape(delimiter)), position)
    return part.try_cast("double") if numeric else part


def path_value(path: Column, key: str, *, numeric: bool = False) -> Column:
    """The value of ``key=`` in a partitioned file path."""
    text = F.nullif(F.regexp_extract(path, f"/{re.escape(key)}=([^/]*)", 1), F.lit(""))
    return text.try_cast("int") if numeric else text


def group_key(*columns: str) -> Column:
    """Several columns as one ``a@b`` string."""
    return F.concat_ws("@", *columns)


def double_array(values: Iterable[float]) -> Column:
    """A constant array of finite numbers, built from one expression."""
    return F.expr(f"array({', '.join(f'{float(value)!r}D' for value in values)})")


def shuffle_hash(seed: str, *columns: str) -> Column:
    """A stable pseudo-random sort key for a row.

    Same key in every run, for any number of partitions, which a random function
    cannot promise once a task is retried.
    """
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.col(name).cast("string") for name in columns]))


def hash_integer(seed: str, *columns: str) -> Column:
    """A stable non-negative 60-bit integer for a row."""
    return F.conv(F.substring(shuffle_hash(seed, *columns), 1, 15), 16, 10).cast("bigint")


def hash_slot(size: int | Column, seed: str, *columns: str) -> Column:
    """One of ``size`` slots."""
    return hash_integer(seed, *columns) % size


def double_hash_index(column: str, size: int, seeds: tuple[str, str] = ("a", "b")) -> Column:
    """Sum of two independent slots, the row index of a double-hashed embedding."""
    first, second = seeds
    return hash_slot(size, first, column) + hash_slot(size, second, column)
