"""Bring rows to the columns and types of a target table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, FractionalType, IntegralType, MapType, StructType


def _by_position(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The same rows under generated names, and the way from each real name to the generated one.

    Names are matched exactly, while Spark resolves them without regard to case; generated names keep
    ``tenant`` and ``TENANT`` apart.
    """
    generated = [f"_in{i}" for i in range(len(df.columns))]
    return df.toDF(*generated), dict(zip(df.columns, generated))


def _cast(df: DataFrame, value: Column, kind: DataType) -> Column:
    """Cast that fails for a value that does not fit, also in sessions where a plain cast gives null."""
    if df.sparkSession.conf.get("spark.sql.ansi.enabled") == "true":
        return value.cast(kind)
    fitting = value.try_cast(kind)
    failed = F.raise_error(F.concat(F.lit(f"not a {kind.simpleString()}: "), value.cast("string")))
    return F.when(value.isNull() | fitting.isNotNull(), fitting).otherwise(failed)


def align_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types.

    Each is taken from the column of exactly the same name; one that ``df`` lacks becomes null, one that
    ``schema`` lacks is dropped. A value that does not fit its type fails the query.
    """
    rows, source = _by_position(df)
    columns = []
    for field in schema:
        if field.name in source:
            value = _cast(df, F.col(source[field.name]), field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name, metadata=field.metadata))
    return rows.select(*columns)


def misfit(value: Column, have: DataType, want: DataType) -> Column:
    """Whether a value, or one inside it, does not fit a type: it cannot be cast, or a whole number would lose its fraction."""
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return F.coalesce(F.exists(value, lambda x: misfit(x, have.elementType, want.elementType)), F.lit(False))
    if isinstance(have, MapType) and isinstance(want, MapType):
        keys = misfit(F.map_keys(value), ArrayType(have.keyType), ArrayType(want.keyType))
        return keys | misfit(F.map_values(value), ArrayType(have.valueType), ArrayType(want.valueType))
    if isinstance(have, StructType) and isinstance(want, StructType) and len(have) == len(want):
        inside = [misfit(value.getField(a.name), a.dataType, b.dataType) for a, b in zip(have, want)]
        return value.isNotNull() & reduce(Column.__or__, inside, F.lit(False))
    cast = value.try_cast(want)
    bad = cast.isNull()
    if isinstance(have, FractionalType) and isinstance(want, IntegralType):
        bad = bad | (cast.cast(have) != value)
    return value.isNotNull() & F.coalesce(bad, F.lit(True))


def align_with_rejects(df: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Like :func:`align_to_schema`, but rows with a :func:`misfit` are set apart, unchanged.

    Both results read ``df``; they are disjoint and together hold all of its rows.
    """
    rows, source = _by_position(df)
    misfits = [
        misfit(F.col(source[field.name]), rows.schema[source[field.name]].dataType, field.dataType)
        for field in schema if field.name in source
    ]
    bad = reduce(Column.__or__, misfits, F.lit(False))
    fitting = rows.filter(~bad).toDF(*df.columns)
    rejected = rows.filter(bad).toDF(*df.columns)
    return align_to_schema(fitting, schema), rejected
