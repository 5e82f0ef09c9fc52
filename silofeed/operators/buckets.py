"""Keyed tables in buckets: base and delta files behind a versioned manifest.

A row lies in the bucket that a hash of its key gives. A bucket has one base folder and, on top of it, deltas: the last
change of each key that a run brought. Reading a bucket merges them by key. Which folders make up a bucket is written in
a manifest, a small file per version; a version is there once its manifest has its final name, which is one rename. So
readers see a run as a whole or not at all, older versions stay readable, and a run writes the buckets that it touches and
no others. Compaction turns a bucket's deltas into a new base.

Removed keys stay in the files as marks, with the order of the change that removed them, until no late change can come.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..functions.names import spark_name
from ..workspace import folder_exists, list_names, publish_text, read_text
from .align import align_to_schema
from .changes import latest_changes

REMOVED, BUCKET = "_removed", "_bucket"


class StaleVersion(RuntimeError):
    """Another run has published the version that this one was to be."""


@dataclass(frozen=True)
class Manifest:
    """A version of a table: its columns, how rows are dealt out, and the folders of each bucket, oldest first."""

    version: int
    schema: StructType
    keys: tuple[str, ...]
    order_by: tuple[str, ...]
    buckets: int
    folders: dict[int, list[str]] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({
            "version": self.version, "schema": self.schema.jsonValue(), "keys": self.keys, "order_by": self.order_by,
            "buckets": self.buckets, "folders": {str(b): names for b, names in sorted(self.folders.items())}})

    @staticmethod
    def from_json(text: str) -> Manifest:
        found = json.loads(text)
        return Manifest(
            found["version"], StructType.fromJson(found["schema"]), tuple(found["keys"]), tuple(found["order_by"]),
            found["buckets"], {int(b): names for b, names in found["folders"].items()})


def _manifest_name(path: str, version: int) -> str:
    return f"{path}/manifests/{version:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of a table, in order; none where there is no table."""
    return sorted(int(n.removesuffix(".json")) for n in list_names(spark, f"{path}/manifests/*.json"))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    """A version of a table, by default the last."""
    if version is None:
        found = versions(spark, path)
        if not found:
            raise ValueError(f"no bucketed table in {path}")
        version = found[-1]
    return Manifest.from_json(read_text(spark, _manifest_name(path, version)))


def _publish(spark: SparkSession, path: str, new: Manifest) -> Manifest:
    if not publish_text(spark, _manifest_name(path, new.version), new.to_json()):
        raise StaleVersion(f"version {new.version} of {path} is there already: read the table again and repeat the run")
    return new


def create_bucketed(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order_by: Sequence[str], buckets: int
) -> Manifest:
    """An empty table. ``schema`` has the keys and the columns that order the changes of a key."""
    missing = [c for c in (*keys, *order_by) if c not in schema.names]
    if missing or not keys or not order_by:
        raise ValueError(f"keys and order must be columns of the table: {missing}")
    taken = [c for c in schema.names if c in (REMOVED, BUCKET)]
    if taken or buckets < 1:
        raise ValueError(f"illegal columns {taken} or number of buckets {buckets}")
    return _publish(spark, path, Manifest(0, schema, tuple(keys), tuple(order_by), buckets))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(spark_name(k)) for k in keys]), F.lit(buckets)).cast("int")


def _stored(found: Manifest) -> StructType:
    return StructType([*found.schema.fields, StructField(REMOVED, BooleanType())])


def _rows(spark: SparkSession, path: str, found: Manifest, buckets: Sequence[int] | None = None) -> DataFrame:
    """All stored rows of some buckets, by default all, marks included."""
    names = [f"{path}/{name}" for b, some in found.folders.items() if buckets is None or b in buckets for name in some]
    return spark.read.schema(_stored(found)).parquet(*names) if names else spark.createDataFrame([], _stored(found))


def _merged(rows: DataFrame, found: Manifest) -> DataFrame:
    """The last state of each key, marks included. Equal orders are the same change, brought twice."""
    return latest_changes(rows, list(found.keys), list(found.order_by))


def read_bucketed(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of a table at a version, by default the last."""
    found = manifest(spark, path, version)
    merged = _merged(_rows(spark, path, found), found)
    return merged.filter(~F.col(REMOVED)).select(*map(spark_name, found.schema.names))


def _write(rows: DataFrame, path: str, found: Manifest, purpose: str) -> dict[int, str]:
    """Write rows to new folders, one for each bucket that has some; the names by bucket."""
    run = f"{purpose}-{uuid.uuid4().hex}"
    dealt = rows.withColumn(BUCKET, bucket_of(found.keys, found.buckets))
    dealt.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{run}")
    names = list_names(dealt.sparkSession, f"{path}/{run}/{BUCKET}=*")
    return {int(name.split("=")[1]): f"{run}/{name}" for name in names}


def apply_to_buckets(
    changes: DataFrame, path: str, deleted: Column | str | None = None, compact_after: int = 8
) -> Manifest:
    """Apply a change log to a table and publish the next version.

    Only the last change of each key is written, as a delta of its bucket; nothing of the table is read. A change that
    comes late, or again, loses against a later one when rows are merged, so runs may be repeated and logs may come in any
    order. ``deleted`` marks removals. Buckets with more than ``compact_after`` deltas get a new base in the same version.
    A log without rows publishes nothing. :class:`StaleVersion` says that another run was faster; nothing has changed then.
    """
    spark = changes.sparkSession
    found = manifest(spark, path)
    condition = F.expr(deleted) if isinstance(deleted, str) else deleted
    removed = F.lit(False) if condition is None else F.coalesce(condition, F.lit(False))
    known = [c for c in changes.columns if c in found.schema.names]
    slim = changes.select(*map(spark_name, known), removed.alias(REMOVED))
    deltas = _write(align_to_schema(_merged(slim, found), _stored(found)), path, found, "delta")
    if not deltas:
        return found
    folders = {b: [*found.folders.get(b, []), *([deltas[b]] if b in deltas else [])] for b in {*found.folders, *deltas}}
    new = Manifest(found.version + 1, found.schema, found.keys, found.order_by, found.buckets, folders)
    due = [b for b in deltas if len(folders[b]) > compact_after + 1]
    return _publish(spark, path, _compacted(spark, path, new, due))


def _compacted(spark: SparkSession, path: str, found: Manifest, buckets: Sequence[int], keep_marks_from: Column | None = None) -> Manifest:
    if not buckets:
        return found
    rows = _merged(_rows(spark, path, found, buckets), found)
    if keep_marks_from is not None:
        rows = rows.filter(~F.col(REMOVED) | keep_marks_from)
    bases = _write(rows, path, found, "base")
    folders = {b: names for b, names in found.folders.items() if b not in buckets} | {b: [name] for b, name in bases.items()}
    return Manifest(found.version, found.schema, found.keys, found.order_by, found.buckets, folders)


def compact(spark: SparkSession, path: str, more_than: int = 1, keep_marks_from: Column | None = None) -> Manifest:
    """Give each bucket of more than ``more_than`` folders a single new base, as the next version.

    Other buckets keep their files. ``keep_marks_from``, a condition over a row, says which marks of removed keys a late
    change may still need; by default all are kept.
    """
    found = manifest(spark, path)
    due = [b for b, names in found.folders.items() if len(names) > more_than]
    if not due:
        return found
    new = Manifest(found.version + 1, found.schema, found.keys, found.order_by, found.buckets, found.folders)
    return _publish(spark, path, _compacted(spark, path, new, due, keep_marks_from))


def table_exists(spark: SparkSession, path: str) -> bool:
    return folder_exists(spark, f"{path}/manifests") and bool(versions(spark, path))
