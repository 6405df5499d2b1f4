"""Compare registered queries with their SQL run in DuckDB: ``python -m tests.oracle sf0.01 [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pyarrow as pa
from pyspark.sql import SparkSession

from assayer.plans import load_queries
from assayer.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
DATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def plain_type(kind: pa.DataType) -> str:
    if pa.types.is_large_string(kind) or pa.types.is_string(kind):
        return "string"
    if pa.types.is_timestamp(kind):
        return "timestamp" + ("_tz" if kind.tz else "")
    return str(kind)


def rows_of(table: pa.Table) -> tuple[list[str], dict[str, str], list[tuple]]:
    names = sorted(table.column_names)
    kinds = {n: plain_type(table.schema.field(n).type) for n in names}
    columns = [table.column(n).to_pylist() for n in names]
    rows = sorted(zip(*columns, strict=True), key=repr) if columns else []
    return names, kinds, rows


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> list[str]:
    """What differs between a query and its SQL; empty when nothing does."""
    queries, oracles = load_queries()
    actual = rows_of(queries[name](spark, sf_dir).toArrow())
    if name not in oracles:
        return []
    expected = rows_of(con.execute(oracles[name]).to_arrow_table())
    found = []
    if actual[0] != expected[0]:
        found.append(f"columns {actual[0]} != {expected[0]}")
    elif actual[1] != expected[1]:
        found.append("types " + ", ".join(f"{n}: {actual[1][n]} != {expected[1][n]}" for n in actual[0] if actual[1][n] != expected[1][n]))
    if len(actual[2]) != len(expected[2]):
        found.append(f"{len(actual[2])} rows != {len(expected[2])}")
    if repr(actual[2]) != repr(expected[2]):
        wrong = [(a, e) for a, e in zip(actual[2], expected[2], strict=False) if repr(a) != repr(e)][:2]
        found.append(f"values, e.g. {str(wrong)[:600]}")
    return found


def main() -> int:
    sf_dir = f"{DATA}/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.001'}"
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                   "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = load_queries()
    names = sys.argv[2:] or list(queries)
    bad = 0
    for name in names:
        started = time.time()
        try:
            found = differences(spark, con, sf_dir, name)
        except Exception as failure:
            found = [f"{type(failure).__name__}: {str(failure)[:900]}"]
        bad += bool(found)
        state = "; ".join(found) if found else ("same" if name in oracles else "ran")
        print(f"{name:28s} {time.time() - started:6.2f}s  {state}", flush=True)
    print(f"{len(names)} queries, {bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
