"""Full, incremental and change-log synchronisation of tenant tables."""

from __future__ import annotations

import datetime
import decimal
from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ..functions.names import spark_name
from ..functions.records import row_text
from ..operators.align import align_to_schema
from ..operators.changes import apply_changes, latest_changes
from ..operators.sinks import gather, publish_snapshot, read_tenant_table, tenant_table, write_tenant_table
from ..sources.config import JDBC, SourceConfig, TableRef
from ..sources.jdbc import CONNECTIONS, between, largest_value, quote, read_jdbc
from ..sources.tables import describe_table, read_table

CURSOR_PROPERTY = "cursor."


def sync_full(df: DataFrame, tenant: str, table: str) -> None:
    """Replace the rows of a tenant's table by the whole source, aligned to the table's columns if it exists."""
    publish_snapshot(df, tenant, table)


def _cursor_value(df: DataFrame, cursor: str, value: Any) -> Column:
    """Literal of the cursor column's own type, so that comparisons with it reach the scan."""
    kind = df.schema[cursor].dataType
    if isinstance(kind, TimestampNTZType):
        # As text: a datetime literal would be moved by the time zones of driver and session.
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(kind)


def sync_incremental(df: DataFrame, cursor: str, after: Any | None) -> tuple[DataFrame, Any | None]:
    """Rows whose cursor lies behind ``after``, and the cursor to go on from next time.

    The upper end is fixed first and bounds the rows, so rows that arrive while they are read wait for
    the next run and are not skipped. Both ends are pushed into the scan. Rows without a cursor come in every
    run, since nothing tells whether they have come before.
    """
    column = F.col(spark_name(cursor))
    later = df if after is None else df.filter(column.isNull() | (column > _cursor_value(df, cursor, after)))
    until = later.agg(F.max(column)).first()[0]
    if until is None:
        return df.filter(column.isNull()), after
    return later.filter(column.isNull() | (column <= _cursor_value(df, cursor, until))), until


def read_increment(
    spark: SparkSession,
    source: SourceConfig,
    ref: TableRef,
    cursor: str,
    after: Any | None,
    partitions: int | None = None,
) -> tuple[DataFrame, Any | None]:
    """Like :func:`sync_incremental`, from a table of a source.

    A database finds both ends by its index on the cursor, and the new rows alone are split into parts of
    equal size, along the cursor and then the primary key. Its rows without a cursor are split along the key alone.
    """
    if source.type != JDBC:
        return sync_incremental(read_table(spark, source, ref), cursor, after)
    columns = describe_table(spark, source, ref)
    until = largest_value(spark, source, ref, cursor)
    keys = [c.column for c in columns if c.primary_key and c.column != cursor]
    partitions = partitions or min(spark.sparkContext.defaultParallelism, CONNECTIONS)
    without = None
    if any(c.column == cursor and c.nullable for c in columns):
        without = read_jdbc(spark, source, ref, keys, partitions, where=f"{quote(source, cursor)} IS NULL")
    if until is None or (after is not None and until <= after):
        return without if without is not None else read_jdbc(spark, source, ref, where="1 = 0"), after
    new = read_jdbc(spark, source, ref, [cursor, *keys], partitions, where=between(source, cursor, after, until))
    return new if without is None else new.unionByName(without), until


def _reached(known: DataFrame, name: str, cursor: str) -> Any | None:
    """Largest cursor of a tenant's table.

    The cursor that the last run has left as a property of the table only narrows the search, so that the
    scan skips older files. Whatever it says, the answer comes from the rows.
    """
    key = CURSOR_PROPERTY + cursor
    noted = known.sparkSession.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == key).first()
    if noted is not None:
        lower = F.lit(noted["value"]).try_cast(known.schema[cursor].dataType)
        recent = known.filter(F.col(spark_name(cursor)) >= lower)
        found = recent.agg(F.max(spark_name(cursor))).first()[0]
        if found is not None:
            return found
    return known.agg(F.max(spark_name(cursor))).first()[0]


def _note_reached(spark: SparkSession, name: str, cursor: str, until: Any | None) -> None:
    if isinstance(until, (int, decimal.Decimal, datetime.date)):
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{CURSOR_PROPERTY}{cursor}' = '{until}')")


def _content(df: DataFrame, cursor: Column) -> Column:
    """Digest of a row without a cursor; null where the cursor tells versions apart."""
    return F.when(cursor.isNull(), F.sha2(row_text(df), 256))


def sync_tenant_incremental(
    df: DataFrame,
    tenant: str,
    table: str,
    cursor: str,
    keys: Sequence[str] = (),
    overlap: Any | None = None,
) -> Any | None:
    """Append what is new to a tenant's table and return the cursor it has reached.

    The last cursor is read from the table itself. Rows that arrive late with an old cursor are found again with an
    ``overlap`` to look back over; ``keys`` then tell, together with the cursor, which rows are there already: a row
    whose cursor has moved is a new version and is appended, as it is without an overlap. Rows without a cursor are
    known by their keys and their content, so a changed one is a new version too; one that changes back is not told from
    the version before. Without keys they can only be loaded once, with the table.
    """
    spark, name = df.sparkSession, tenant_table(tenant, table)
    if overlap is not None and not keys:
        raise ValueError("an overlap needs keys to tell which rows are there already")
    known = read_tenant_table(spark, tenant, table) if spark.catalog.tableExists(name) else None
    after = None if known is None else _reached(known, name, cursor)
    if known is None:
        new, until = sync_incremental(df, cursor, None)
        write_tenant_table(new, tenant, table)
    else:
        start = after if after is None or overlap is None else after - overlap
        new, until = sync_incremental(df, cursor, start)
        column = F.col(spark_name(cursor))
        if keys:
            recent = known if start is None else known.filter(
                column.isNull() | (column > _cursor_value(known, cursor, start)))
            new = align_to_schema(new, known.schema)
            there = recent.select(
                [F.col(spark_name(c)).alias(f"_there_{i}") for i, c in enumerate((*keys, cursor))]
                + [_content(known, column).alias("_there")])
            same = [F.col(spark_name(c)).eqNullSafe(F.col(f"_there_{i}")) for i, c in enumerate((*keys, cursor))]
            same.append(_content(known, column).eqNullSafe(F.col("_there")))
            new = new.join(there, reduce(Column.__and__, same), "left_anti")
        elif not new.filter(column.isNull()).isEmpty():
            raise ValueError(f"rows without {cursor} need keys to tell which are there already")
        write_tenant_table(gather(new), tenant, table)
    _note_reached(spark, name, cursor, until)
    return until


def sync_changes(
    changes: DataFrame,
    tenant: str,
    table: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    deleted: Column | str | None = None,
) -> None:
    """Apply a change log to a tenant's table.

    Beside the table, ``<table>_applied`` keeps for each key that has ever changed the order of its last change, also
    of one that has removed it. A change that comes late, or again, is behind that and does nothing. The table is
    published first: a run that fails between the two is repeated without harm.
    """
    spark, marks = changes.sparkSession, f"{table}_applied"
    condition = F.expr(deleted) if isinstance(deleted, str) else deleted
    removed = F.lit(False) if condition is None else F.coalesce(condition, F.lit(False))
    snapshot = read_tenant_table(spark, tenant, table)
    taken = [c for c in changes.columns if c in (*keys, *order_by, *snapshot.columns)]
    latest = latest_changes(changes.select(*map(spark_name, taken), removed.alias("_removed")), keys, order_by)
    order = F.struct(*[F.col(spark_name(c)) for c in order_by])
    new_marks = latest.select(*map(spark_name, keys), *[spark_name(c) for c in order_by if c not in keys])
    if spark.catalog.tableExists(tenant_table(tenant, marks)):
        applied = read_tenant_table(spark, tenant, marks)
        there = applied.select([F.col(spark_name(k)).alias(f"_key_{i}") for i, k in enumerate(keys)] + [order.alias("_done")])
        same = reduce(Column.__and__, [F.col(spark_name(k)) == F.col(f"_key_{i}") for i, k in enumerate(keys)])
        latest = latest.join(there, same & (F.col("_done") >= order), "left_anti")
        new_marks = latest_changes(applied.unionByName(new_marks), keys, order_by)
    publish_snapshot(apply_changes(snapshot, latest, keys, order_by, "_removed"), tenant, table)
    publish_snapshot(new_marks, tenant, marks)
