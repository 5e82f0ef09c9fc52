"""Incremental snapshot of a table while its change log goes on.

The table is read in chunks of its key. Around each read the end of the log is noted: the low mark before it, the high
mark after. What the log has changed between the two may or may not be in the rows that were read, so those keys are
taken from the log. Chunks need no locks, and a snapshot that stops goes on behind the last chunk it has finished.

Rows and changes go into one keyed table of buckets, ordered by the position of the log: a row that was read counts as of
its chunk's low mark, a change as of its own position. So it does not matter when changes arrive, or how often.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.names import spark_name
from ..operators.buckets import Manifest, apply_to_buckets, create_bucketed, read_bucketed, table_exists
from ..workspace import list_names, publish_text, read_text

POSITION, GONE = "_position", "_gone"


@dataclass(frozen=True)
class Chunk:
    """Rows whose key is above ``after`` and at most ``until``; null is an open end. Read between two ends of the log."""

    number: int
    after: Any | None
    until: Any | None
    low: int | None = None
    high: int | None = None


def chunk_ends(table: DataFrame, key: str, chunks: int) -> list[Any]:
    """Keys that cut a table into about equal chunks; no more than ``chunks - 1`` of them, which are all that is collected.

    The first chunk has no lower end and the last no upper one, so rows that are inserted later have a place.
    """
    if chunks < 1:
        raise ValueError("at least one chunk")
    shares = [i / chunks for i in range(1, chunks)]
    if not shares:
        return []
    column = F.col(spark_name(key))
    found = table.agg(F.percentile_approx(column, shares, max(10_000, 100 * chunks))).first()[0]
    return sorted(set(found or []))


def inside(key: str, chunk: Chunk) -> Column:
    column = F.col(spark_name(key))
    below = F.lit(True) if chunk.until is None else column <= F.lit(chunk.until)
    # Rows without a key come with the first chunk, which refuses them.
    return below | column.isNull() if chunk.after is None else below & (column > F.lit(chunk.after))


def corrected(
    rows: DataFrame, log: DataFrame, keys: Sequence[str], position: str, chunk: Chunk, deleted: Column | str | None = None
) -> DataFrame:
    """Changes that bring a chunk: its rows, as of the low mark, and what the log has changed between the marks.

    Rows with a key that was changed between the marks give way to the log. Changes before the low mark are in the rows;
    those after the high mark are not, and come with the log later. :data:`GONE` marks removals.
    """
    column = F.col(spark_name(position))
    between = marked(log.filter((column > F.lit(chunk.low)) & (column <= F.lit(chunk.high))), position, deleted)
    kept = rows.join(between.select(*map(spark_name, keys)), list(keys), "left_anti").select(*map(spark_name, rows.columns))
    read = kept.withColumns({POSITION: F.lit(chunk.low).cast("long"), GONE: F.lit(False)})
    changes = between.select(*[spark_name(c) for c in between.columns if c in read.columns])
    return read.unionByName(changes, allowMissingColumns=True)


def marked(log: DataFrame, position: str, deleted: Column | str | None) -> DataFrame:
    condition = F.expr(deleted) if isinstance(deleted, str) else deleted
    removed = F.lit(False) if condition is None else F.coalesce(condition, F.lit(False))
    return log.withColumns({POSITION: F.col(spark_name(position)).cast("long"), GONE: removed})


def _state(path: str) -> str:
    return f"{path}/chunks"


def finished(spark: SparkSession, path: str) -> list[Chunk]:
    """Chunks of a snapshot that are in the table, in order."""
    names = sorted(list_names(spark, f"{_state(path)}/chunk-*.json"))
    return [Chunk(**json.loads(read_text(spark, f"{_state(path)}/{name}"))) for name in names]


def _ends(spark: SparkSession, path: str, table: DataFrame, key: str, chunks: int) -> list[Any]:
    """The cuts of the first run, also when the table has changed since."""
    name = f"{_state(path)}/ends.json"
    if not list_names(spark, name):
        publish_text(spark, name, json.dumps(chunk_ends(table, key, chunks)))
    return json.loads(read_text(spark, name))


def snapshot_with_log(
    read: Callable[[], DataFrame],
    read_log: Callable[[], DataFrame],
    path: str,
    keys: Sequence[str],
    position: str,
    chunks: int,
    buckets: int,
    deleted: Column | str | None = None,
    at_most: int | None = None,
) -> list[Chunk]:
    """Bring a table into a bucketed table at ``path``, chunk by chunk, while it changes; the chunks that are done.

    ``read`` gives the table as it is now and ``read_log`` its log up to now; they are called anew for each chunk, so that
    both may go on. ``position`` is a column of the log, a whole number that grows with every change. Each chunk publishes
    one version of the table. The first of ``keys``, a whole number or a double, cuts the chunks. ``at_most`` chunks are done in
    this call, all by default; a later call goes on. Afterwards, and in between, :func:`follow_log` brings the changes.
    Chunks that are repeated after a failure read again, with marks of their own. Null keys fail the run.
    """
    table = read()
    spark, key = table.sparkSession, keys[0]
    if not table_exists(spark, path):
        schema = StructType([*table.schema.fields, StructField(POSITION, LongType())])
        create_bucketed(spark, path, schema, keys, [POSITION], buckets)
    ends = _ends(spark, path, table, key, chunks)
    done = finished(spark, path)
    todo = [Chunk(i, a, b) for i, (a, b) in enumerate(zip([None, *ends], [*ends, None], strict=True))][len(done):]
    for chunk in todo[: len(todo) if at_most is None else at_most]:
        low = _log_end(read_log(), position)
        # Written before the high mark is taken, so that the read lies between the two.
        rows = _held(read().filter(inside(key, chunk)), path, chunk)
        chunk = Chunk(chunk.number, chunk.after, chunk.until, low, _log_end(read_log(), position))
        apply_to_buckets(corrected(rows, read_log(), keys, position, chunk, deleted), path, GONE)
        publish_text(spark, f"{_state(path)}/chunk-{chunk.number:06d}.json", json.dumps(vars(chunk)))
        done.append(chunk)
    return done


def _log_end(log: DataFrame, position: str) -> int:
    end = log.agg(F.max(spark_name(position))).first()[0]
    return -1 if end is None else end


def _held(rows: DataFrame, path: str, chunk: Chunk) -> DataFrame:
    folder = f"{path}/read/{chunk.number:06d}"
    rows.write.mode("overwrite").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def follow_log(
    log: DataFrame, path: str, position: str, deleted: Column | str | None = None, after: int | None = None
) -> Manifest:
    """Bring the changes of a log behind the position ``after``, or all, into the table of a snapshot.

    Changes that are there already, or behind those that are, do nothing.
    """
    column = F.col(spark_name(position))
    new = log if after is None else log.filter(column > F.lit(after))
    return apply_to_buckets(marked(new, position, deleted), path, GONE)


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return read_bucketed(spark, path, version).drop(POSITION)
