"""Compare a query with its SQL: same columns, same types, same rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
# how Spark and DuckDB name the same type
KINDS = {
    "TINYINT": "tinyint",
    "SMALLINT": "smallint",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "HUGEINT": "bigint",
    "FLOAT": "float",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp",
    "TIMESTAMP_NS": "timestamp",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    if isinstance(value, list):
        return tuple(_plain(entry) for entry in value)
    return value


def differences(df, connection, sql: str) -> list[str]:
    """What differs; an empty list means the two agree."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    kinds = {name: KINDS.get(str(column[1]), str(column[1])) for name, column in zip(names, result.description)}
    theirs = result.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    mine = dict(df.dtypes)
    loose = {"tinyint", "smallint", "int", "bigint"}
    for name in names:
        if mine[name] != kinds[name]:
            note = "" if {mine[name], kinds[name]} <= loose else "!"
            problems.append(f"{note}type of {name}: {mine[name]} against {kinds[name]}")
    ours = [tuple(_plain(value) for value in row) for row in df.select(*[f"`{n}`" for n in names]).collect()]
    expected = [tuple(_plain(value) for value in row) for row in theirs]
    if len(ours) != len(expected):
        problems.append(f"!rows {len(ours)} against {len(expected)}")
    left, right = Counter(ours), Counter(expected)
    if left != right:
        problems.append(f"!only here {list((left - right).items())[:3]}, only in SQL {list((right - left).items())[:3]}")
    if not expected:
        problems.append("!no rows at all")
    return problems


def main(sf_dir: str, wanted: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry_points
    from affinary.session import build_session

    queries, oracle = entry_points.queries(), entry_points.oracle_sql()
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in wanted or queries:
        start = time.time()
        try:
            if name in oracle:
                problems = differences(queries[name](spark, sf_dir), connection, oracle[name])
            else:
                rows = queries[name](spark, sf_dir).collect()
                problems = [f"rows only: {len(rows)}"] + [str(row)[:150] for row in rows[:3]]
        except Exception as error:  # noqa: BLE001
            problems = [f"!{type(error).__name__}: {str(error)[:600]}"]
        failed = any(p.startswith("!") for p in problems)
        bad += failed
        print(f"{'FAIL' if failed else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n     " if problems else "", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1], sys.argv[2:]))
