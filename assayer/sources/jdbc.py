"""JDBC scans as reader settings. They need a database and its driver, so tests check the settings only."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Drivers by database kind, and rows per fetch.
DRIVERS = {
    "postgresql": "org.postgresql.Driver",
    "mysql": "com.mysql.cj.jdbc.Driver",
    "oracle": "oracle.jdbc.OracleDriver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
}
FETCH_SIZE = 10000
PARTITION_KEYS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def jdbc_url(connection: Mapping[str, Any]) -> str:
    """URL of a connection given by kind, host, port and database."""
    kind = connection["type"]
    host = f"{connection['host']}:{connection['port']}" if connection.get("port") else connection["host"]
    if kind == "sqlserver":
        return f"jdbc:sqlserver://{host};databaseName={connection['database']}"
    if kind == "oracle":
        return f"jdbc:oracle:thin:@//{host}/{connection['database']}"
    return f"jdbc:{kind}://{host}/{connection['database']}"


def jdbc_options(source: Mapping[str, Any]) -> dict[str, str]:
    """Reader options of a database source.

    A query wins over a table. With partition bounds it is passed as a sub-query, because Spark
    does not split a plain ``query``; either way filters and columns are pushed down.
    """
    connection = source.get("connection", {})
    options = {k: str(v) for k, v in (source.get("options") or {}).items()}
    options.setdefault("fetchsize", str(FETCH_SIZE))
    options["url"] = source.get("url") or jdbc_url(connection)
    driver = source.get("driver") or DRIVERS.get(connection.get("type", ""))
    if driver:
        options["driver"] = driver
    for key in ("user", "password"):
        if connection.get(key) or source.get(key):
            options[key] = str(connection.get(key) or source.get(key))
    given = [k for k in PARTITION_KEYS if k in options]
    if given and len(given) != len(PARTITION_KEYS):
        raise ValueError(f"a partitioned read needs all of {PARTITION_KEYS}, got {given}")
    if source.get("query"):
        if given:
            options["dbtable"] = f"({source['query']}) source_query"
        else:
            options["query"] = source["query"]
    elif source.get("table"):
        options["dbtable"] = source["table"]
    else:
        raise ValueError("a database source needs a table or a query")
    return options


def read_jdbc(spark: SparkSession, source: Mapping[str, Any]) -> DataFrame:
    """Scan a table, a query, or either of them in parallel ranges."""
    return spark.read.format("jdbc").options(**jdbc_options(source)).load()

