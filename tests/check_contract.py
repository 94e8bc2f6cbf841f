"""Compare registered queries with their SQL: python tests/check_contract.py FOLDER [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return value


def differences(spark_df, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in columns, types of values or rows; empty if nothing does."""
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(columns)}"]
    order = sorted(columns)
    expected = Counter(
        tuple(_cell(row[columns.index(c)]) for c in order) for row in result.fetchall()
    )
    actual = Counter(tuple(_cell(row[c]) for c in order) for row in spark_df.collect())
    if actual == expected:
        return [] if actual else ["both empty"]
    extra, missing = actual - expected, expected - actual
    return [
        f"{sum(actual.values())} rows against {sum(expected.values())}",
        f"only Spark: {list(extra.items())[:3]}",
        f"only SQL: {list(missing.items())[:3]}",
    ]


def main() -> None:
    from tallywork.plans.contract import ORACLES, QUERIES
    from tallywork.session import build_session

    folder = sys.argv[1]
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled=False,
                          spark__ui__showConsoleProgress=False, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = open_tables(folder)
    for name in names:
        began = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLES:
                wrong = differences(df, connection, ORACLES[name])
                verdict = "ok" if not wrong else "WRONG " + " | ".join(wrong)[:700]
            else:
                verdict = f"rows {df.count()}"
        except Exception as error:  # noqa: BLE001
            verdict = f"FAILED {type(error).__name__} {str(error)[:600]}"
        print(f"{name:32s} {time.time() - began:6.2f}s {verdict}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
