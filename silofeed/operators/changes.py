"""Apply a log of changes to a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from ..functions.names import spark_name
from .align import align_to_schema


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_orderable(field.dataType) for field in kind)
    return not isinstance(kind, (MapType, VariantType))


def _newest(changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    others = [c for c in changes.columns if c not in (*keys, *order_by)]
    row = F.struct(*map(spark_name, [c for c in order_by if c not in keys] + others))
    if all(_orderable(changes.schema[c].dataType) for c in others):
        # The order columns come first in the row, so its maximum is the last change.
        newest = F.max(row)
    else:
        newest = F.max_by(row, F.struct(*map(spark_name, order_by)))
    latest = changes.groupBy(*map(spark_name, keys)).agg(newest.alias("_row"))
    return latest.select(*map(spark_name, keys), "_row.*").select(*map(spark_name, changes.columns))


def _require_keys(latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    message = F.raise_error(F.lit(f"key columns must not be null: {', '.join(keys)}"))
    columns = {key: F.col(spark_name(key)) for key in keys}
    return latest.withColumns({k: F.when(c.isNotNull(), c).otherwise(message) for k, c in columns.items()})


def latest_changes(changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Last change of every key.

    ``order_by`` must decide between any two changes of a key, so end it with a sequence number. Every
    task keeps one row per key before the shuffle; a key with very many changes therefore stays cheap.
    A null key fails the query, as it would in a primary key.
    """
    return _require_keys(_newest(changes, keys, order_by), keys)


def apply_changes(
    snapshot: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    deleted: Column | str | None = None,
) -> DataFrame:
    """Snapshot after the changes: the last change of a key replaces its row, or removes it.

    ``deleted`` is a condition over the changes, as a column or in SQL, that marks removals. The snapshot is
    only read through an anti join on the changed keys: it is not shuffled while those are small enough to
    broadcast.
    """
    condition = F.expr(deleted) if isinstance(deleted, str) else deleted
    removed = F.lit(False) if condition is None else F.coalesce(condition, F.lit(False))
    # Only what the snapshot takes over goes through the shuffle.
    taken = [c for c in changes.columns if c in (*keys, *order_by, *snapshot.columns)]
    slim = changes.select(*map(spark_name, taken), removed.alias("_removed"))
    latest = _newest(slim, keys, order_by)
    changed = latest.select(*map(spark_name, keys))
    kept = snapshot.join(changed, list(keys), "left_anti").select(*map(spark_name, snapshot.columns))
    upserts = _require_keys(latest.filter("NOT _removed"), keys)
    return kept.unionByName(align_to_schema(upserts, snapshot.schema))
