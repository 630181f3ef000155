"""Queries and their SQL, by operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, and its DuckDB SQL where there is one."""

    def add(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is there already")
        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return run

    return add


#: lineitem with `pos`, which numbers the lines of an order without ties.
NUMBERED = """
    numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_tax, l_discount) AS INT) AS pos FROM lineitem)
"""


#: Lines that a task numbers and makes logs of; it sorts them several times over and holds all of them.
LINES_A_TASK = 250_000


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with pos. Orders are dealt to as many tasks as the table's size asks for, whatever the session's number of
    partitions, so that a task's memory does not grow with the table; what goes on by order stays in these tasks."""
    rows = table(spark, sf_dir, "lineitem")
    tasks = rows.count() // LINES_A_TASK + 1  # from the footers
    if tasks > 4:
        rows = rows.repartition(tasks, "l_orderkey")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_tax", "l_discount")
    return rows.withColumn("pos", F.row_number().over(order))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
