"""Row filters written as ``"column op literal"`` strings or (column, op, value) triples."""

from __future__ import annotations

import ast
import re
from collections.abc import Iterable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Predicate = str | tuple[str, str, Any]

_SHAPE = re.compile(r"^\s*([A-Za-z_]\w*)\s*(==|!=|<=|>=|<|>|is\s+not\b|is\b|not\s+in\b|in\b)\s*(.+?)\s*$")


def parse(text: str) -> tuple[str, str, Any]:
    """Split one comparison into (column, operator, literal)."""
    match = _SHAPE.match(text)
    if match is None:
        raise ValueError(f"expected 'column operator literal', got {text!r}")
    column, operator, literal = match.groups()
    try:
        value = ast.literal_eval(literal)
    except (ValueError, SyntaxError) as error:
        raise ValueError(f"only one comparison with a literal is supported: {text!r}") from error
    return column, " ".join(operator.split()), value


def _member(column: Column, values: Iterable[Any]) -> Column:
    listed = list(values)
    known = [value for value in listed if value is not None]
    hit = column.isin(known) if known else F.lit(False)
    return hit | column.isNull() if len(known) < len(listed) else hit


def condition(column_name: str, operator: str, value: Any) -> Column:
    """The boolean column for one comparison with a plain value.

    A null never satisfies a comparison, with one exception kept from the usual
    dataframe filters: ``not in`` keeps nulls unless the list itself holds one.
    """
    column = F.col(column_name)
    match operator:
        case "=" | "==":
            return column == F.lit(value)
        case "!=":
            return column != F.lit(value)
        case "<":
            return column < F.lit(value)
        case "<=":
            return column <= F.lit(value)
        case ">":
            return column > F.lit(value)
        case ">=":
            return column >= F.lit(value)
        case "is":
            return column.isNull() if value is None else column == F.lit(value)
        case "is not":
            return column.isNotNull() if value is None else column != F.lit(value)
        case "in":
            return _member(column, value)
        case "not in":
            listed = list(value)
            known = [entry for entry in listed if entry is not None]
            outside = ~column.isin(known) if known else F.lit(True)
            return column.isNotNull() & outside if len(known) < len(listed) else column.isNull() | outside
        case _:
            raise ValueError(f"{operator!r} is not a valid operator in {(column_name, operator, value)!r}")


def all_of(filters: Iterable[Predicate] | None) -> Column:
    """One boolean column for filters that compare with plain values."""
    triples = [parse(entry) if isinstance(entry, str) else entry for entry in filters or ()]
    return reduce(lambda left, right: left & right, [condition(*triple) for triple in triples], F.lit(True))


def apply_filters(df: DataFrame, filters: Iterable[Predicate] | None) -> DataFrame:
    """Keep the rows that satisfy every filter.

    Plain comparisons become one conjunction, so they reach the scan together.
    ``in`` / ``not in`` with a DataFrame become semi and anti joins on its
    column of the same name; its rows never multiply ours.
    """
    plain: list[Column] = []
    tables: list[tuple[str, str, DataFrame]] = []
    for entry in filters or ():
        column, operator, value = parse(entry) if isinstance(entry, str) else entry
        if isinstance(value, DataFrame):
            if operator not in ("in", "not in"):
                raise ValueError(f"{operator!r} cannot compare a column with a table")
            tables.append((column, operator, value))
        else:
            plain.append(condition(column, operator, value))
    if plain:
        df = df.filter(reduce(lambda left, right: left & right, plain))
    for column, operator, table in tables:
        keys = table.select(column).distinct()
        df = df.join(keys, column, "left_semi" if operator == "in" else "left_anti")
    return df
