"""Registry of the queries and of the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a query with the SQL that states its result."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        QUERIES[name] = function
        ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_double(column: str) -> Column:
    """Decimals are shown as doubles, which all readers of a result print alike."""
    return F.col(column).cast("double")


def derived(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns derived by expressions that both Spark and the SQL of the query use."""
    return df.selectExpr(*[f"{expression} AS {name}" for name, expression in columns.items()])


def derived_sql(columns: dict[str, str], source: str) -> str:
    listed = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    return f"SELECT {listed} FROM {source}"
