"""Compare two tables row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import spark_name

SIDE = "side"
COPIES = "copies"


def diff_tables(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one table has more often than the other, with the side and the number of extra copies.

    Columns are matched by name, so their order does not matter. Rows count as often as they occur and
    null equals null. An empty result means equal content. One aggregation over both tables: copies are
    added up before the shuffle, however many there are of one row.
    """
    if set(left.columns) != set(right.columns):
        raise ValueError(f"columns differ: {sorted(left.columns)} and {sorted(right.columns)}")
    weight = "_weight"
    both = left.withColumn(weight, F.lit(1)).unionByName(right.withColumn(weight, F.lit(-1)))
    balance = both.groupBy(*map(spark_name, left.columns)).agg(F.sum(weight).alias(weight))
    return balance.filter(F.col(weight) != 0).select(
        *map(spark_name, left.columns),
        F.when(F.col(weight) > 0, F.lit("left")).otherwise(F.lit("right")).alias(SIDE),
        F.abs(weight).alias(COPIES),
    )


def tables_equal(left: DataFrame, right: DataFrame) -> bool:
    return diff_tables(left, right).isEmpty()
