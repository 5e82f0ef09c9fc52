"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import new_folder, remove_folder
from .tables import passing


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node reachable) of every node that has a link to another.

    Alternates two kinds of rounds until nothing changes: every node links its larger neighbours to its smallest one,
    then its smaller ones. The number of rounds grows with the logarithm of a component's size. Every round is a table
    in the shared folder, of no more rows than there are links. A hub's links are combined before the shuffle.

    Links may repeat, point either way, and join a node to itself. Links with a null end are ignored. No links give
    no rows.
    """
    spark = links.sparkSession
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    edges = ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, folder, state = _round(spark, edges)
    while True:
        large, old, _ = _round(spark, _star(edges, larger=True))
        remove_folder(spark, folder)
        edges, folder, new = _round(spark, _star(large, larger=False))
        remove_folder(spark, old)
        if new == state:
            break
        state = new
    passing(spark, folder)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Links of each node's larger (or smaller, itself included) neighbours to the smallest of them and itself."""
    from_u = edges.select("u", F.col("v").alias("w"))
    around = from_u.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("w"))) if larger else from_u
    least = around.groupBy("u").agg(F.least(F.col("u"), F.min("w")).alias("m"))
    moved = around.join(least, "u")
    if larger:
        moved = moved.where("w > u")
    else:
        moved = moved.where("w <> m").unionByName(least.select("u", F.col("u").alias("w"), "m"))
    return moved.where("w <> m").select(F.col("w").alias("u"), F.col("m").alias("v")).distinct()


def _round(spark, edges: DataFrame) -> tuple[DataFrame, str, tuple]:
    folder = new_folder(spark, "links")
    edges.write.parquet(folder)
    edges = spark.read.schema(edges.schema).parquet(folder)
    return edges, folder, tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
