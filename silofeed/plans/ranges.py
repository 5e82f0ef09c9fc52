"""Synchronisation by a ledger of ranges instead of a single cursor.

The cursor's values are cut into ranges of one width; rows without a cursor are a range of their own. For each range the
ledger knows how many rows the copy has, and a digest of them that does not depend on their order. A run computes both
for the source, in one pass that is combined before it is shuffled, and reads again the ranges that differ: rows that came
late, were changed without a new cursor, or were removed are found wherever they lie. The copy keeps a folder for each
range, and a run ends by publishing a manifest with one rename: it is there as a whole, or not at all.
"""

from __future__ import annotations

import datetime
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, StructType, TimestampNTZType, TimestampType

from ..functions.names import spark_name
from ..functions.records import row_text
from ..operators.buckets import StaleVersion
from ..workspace import list_names, publish_text, read_text

RANGE, NO_CURSOR = "_range", "none"
EPOCH = datetime.date(1970, 1, 1)
#: Runs of ranges that are asked for one by one; more are asked for by their first and last, and told apart by number.
INTERVALS = 100


@dataclass(frozen=True)
class Ranges:
    """How a cursor is cut: a whole number into ranges of ``width``, a date or time into ``width`` days."""

    cursor: str
    width: int = 1

    def kind(self, schema: StructType):
        kind = schema[self.cursor].dataType
        if self.width < 1 or not isinstance(kind, (IntegralType, DateType, TimestampType, TimestampNTZType)):
            raise ValueError(f"{self.cursor} must be a whole number, a date or a time, and the width 1 or more")
        return kind

    def number(self, df: DataFrame) -> Column:
        """The range of a row, as text."""
        column = F.col(spark_name(self.cursor))
        if not isinstance(self.kind(df.schema), IntegralType):
            column = F.datediff(column.cast("date"), F.lit(EPOCH))
        whole = column.cast("decimal(20,0)")
        number = F.floor((whole - F.pmod(whole, F.lit(self.width).cast("decimal(20,0)"))) / self.width)
        return F.coalesce(number.cast("long").cast("string"), F.lit(NO_CURSOR))

    def start(self, schema: StructType, number: int) -> Column:
        """Where a range begins, in the cursor's own type."""
        kind = self.kind(schema)
        value = number * self.width
        if not isinstance(kind, IntegralType):
            value = EPOCH + datetime.timedelta(days=value)
        return F.lit(value).cast(kind)

    def among(self, df: DataFrame, numbers: list[str]) -> Column:
        """Whether a row is in one of the ranges, by bounds of the cursor that reach the scan."""
        column, whole = F.col(spark_name(self.cursor)), sorted(int(n) for n in numbers if n != NO_CURSOR)
        runs: list[list[int]] = []
        for number in whole:
            if runs and runs[-1][1] == number:
                runs[-1][1] = number + 1
            else:
                runs.append([number, number + 1])
        exact = len(runs) <= INTERVALS
        found = column.isNull() if NO_CURSOR in numbers else F.lit(False)
        for first, end in runs if exact else [[runs[0][0], runs[-1][1]]]:
            found = found | ((column >= self.start(df.schema, first)) & (column < self.start(df.schema, end)))
        return found if exact else found & self.number(df).isin(numbers)


def digests(df: DataFrame, number: Column) -> dict[str, list]:
    """Rows and digest of each range; as many as there are ranges are collected."""
    hashed = df.select(number.alias("number"), F.xxhash64(row_text(df)).cast("decimal(38,0)").alias("hash"))
    rows = hashed.groupBy("number").agg(F.count("*").alias("n"), F.sum("hash").cast("string").alias("digest")).collect()
    return {r["number"]: [r["n"], r["digest"]] for r in rows}


def _manifests(spark: SparkSession, path: str) -> list[str]:
    return sorted(list_names(spark, f"{path}/manifests/*.json"))


def ledger(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """The manifest of a version, by default the last: ``version``, ``schema``, and folder, rows and digest of each range."""
    names = _manifests(spark, path)
    if not names:
        return {"version": -1, "schema": None, "ranges": {}}
    return json.loads(read_text(spark, f"{path}/manifests/{names[-1] if version is None else f'{version:012d}.json'}"))


def sync_ranges(df: DataFrame, path: str, ranges: Ranges) -> list[str]:
    """Make the copy at ``path`` equal to ``df``, reading again the ranges that differ; their names, in order.

    The ledger takes rows and digests from what was written. So rows that change between the two reads are found by the
    next run. The first run, and one after the columns have changed, copies all ranges. An empty table empties the copy.
    """
    spark, before = df.sparkSession, ledger(df.sparkSession, path)
    known, schema = before["ranges"], json.loads(df.schema.json())
    if before["schema"] not in (None, schema):
        known = {}
    now = digests(df, ranges.number(df))
    moved = sorted(n for n, found in now.items() if n not in known or known[n][1:] != found)
    kept = {n: entry for n, entry in known.items() if n in now and n not in moved}
    if not moved and kept == before["ranges"] and before["schema"] == schema:
        return []
    if moved:
        run = f"rows-{uuid.uuid4().hex}"
        again = df.filter(ranges.among(df, moved)).withColumn(RANGE, ranges.number(df))
        again.hint("rebalance", RANGE).write.partitionBy(RANGE).parquet(f"{path}/{run}")
        folders = [f"{run}/{name}" for name in list_names(spark, f"{path}/{run}/{RANGE}=*")]
        if folders:
            written = _read(spark, path, folders, df.schema)
            kept |= {n: [f"{run}/{RANGE}={n}", *found] for n, found in digests(written, ranges.number(written)).items()}
    new = {"version": before["version"] + 1, "schema": schema, "ranges": kept}
    if not publish_text(spark, f"{path}/manifests/{new['version']:012d}.json", json.dumps(new)):
        raise StaleVersion(f"another run has published version {new['version']} of {path}: repeat this one")
    return moved


def _read(spark: SparkSession, path: str, folders: list[str], schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*[f"{path}/{folder}" for folder in folders])


def read_ranges(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the copy at a version, by default the last."""
    found = ledger(spark, path, version)
    if found["schema"] is None:
        raise ValueError(f"no copy in {path}")
    schema = StructType.fromJson(found["schema"])
    folders = [entry[0] for entry in found["ranges"].values()]
    return _read(spark, path, folders, schema) if folders else spark.createDataFrame([], schema)
