"""The given tables, read with column pruning and pushdown left to Spark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Narrow rows dealt evenly over all tasks, before each becomes long work.

    Millions of them fit one split of a small file, which would be one task.
    """
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))


class Catalog:
    """Named queries with the SQL that must give the same rows."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
        def register(function: Query) -> Query:
            key = name or function.__name__
            if key in self.queries:
                raise ValueError(f"query {key} is registered twice")
            self.queries[key] = function
            if sql is not None:
                self.sql[key] = sql
            return function

        return register
