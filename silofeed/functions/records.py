"""Rows whose columns are not known in advance, held as an ordered map of column name to text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from .names import spark_name
from .tenancy import as_column


def row_to_record(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Map of the given columns, in order, with values as text; nulls stay as null values."""
    names = columns or df.columns
    return F.map_from_arrays(
        F.array(*[F.lit(name) for name in names]),
        F.array(*[df[spark_name(name)].cast("string") for name in names]),
    )


def row_text(df: DataFrame) -> Column:
    """All values of a row as one text, with nulls and to the microsecond; rows are alike when their texts are."""
    whole = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    options = {"ignoreNullFields": "false", "timestampFormat": whole, "timestampNTZFormat": whole}
    return F.to_json(F.struct(*map(spark_name, df.columns)), options)


def row_to_typed_record(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Record of the given columns that keeps their types: a variant object. Numbers, times, arrays, structs and binaries
    come back as they were with :func:`typed_record_to_row`; columns are in the order of their names."""
    return F.to_variant_object(F.struct(*[df[spark_name(name)].alias(name) for name in columns or df.columns]))


def typed_record_get(record: Column | str, column: str, kind: DataType | str) -> Column:
    """Value of a column in a type; null where the record lacks it, an error where it does not fit."""
    if "'" in column or "\\" in column:
        raise ValueError(f"no quotes or backslashes in names of a typed record: {column}")
    name = kind if isinstance(kind, str) else kind.simpleString()
    return F.variant_get(as_column(record), f"$['{column}']", name)


def typed_record_to_row(record: Column | str, schema: StructType) -> list[Column]:
    """Typed columns of a record, absent columns as null."""
    return [typed_record_get(record, field.name, field.dataType).alias(field.name) for field in schema]


def record_to_row(record: Column | str, schema: StructType) -> list[Column]:
    """Typed columns of a record, absent columns as null."""
    return [record_get(record, field.name).cast(field.dataType).alias(field.name) for field in schema]


def record_get(record: Column | str, column: str) -> Column:
    return F.try_element_at(as_column(record), F.lit(column))


def record_has(record: Column | str, column: str) -> Column:
    """True when the column is present, also when its value is null."""
    return F.map_contains_key(as_column(record), column)


def record_columns(record: Column | str) -> Column:
    return F.map_keys(as_column(record))


def record_size(record: Column | str) -> Column:
    return F.size(as_column(record))


def record_set(record: Column | str, column: str, value: Column) -> Column:
    """Record with a column set. A column that is there keeps its place; a new one goes to the end."""
    if column is None:
        raise ValueError("column name must not be null")
    record, value = as_column(record), value.cast("string")
    keys, values = F.map_keys(record), F.map_values(record)
    keys = F.array_union(keys, F.array(F.lit(column)))
    place = F.array_position(keys, F.lit(column)).cast("int")
    before, after = F.slice(values, 1, place - 1), F.slice(values, place + 1, F.size(values))
    return F.map_from_arrays(keys, F.concat(before, F.array(value), after))


def records_equal(left: Column | str, right: Column | str) -> Column:
    """Equality of content; the order of the columns does not matter."""
    left, right = as_column(left), as_column(right)
    return F.sort_array(F.map_entries(left)).eqNullSafe(F.sort_array(F.map_entries(right)))
