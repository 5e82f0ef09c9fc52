"""Column expressions; all of them run inside Spark's generated code."""

from .inventory import redact_sources, redact_url, source_supported, validate_sources
from .names import dialect_for_url, dialect_name, not_blank, qualified_name, quote_identifier, quote_name, spark_name
from .records import (
    record_columns,
    record_get,
    record_has,
    record_set,
    record_size,
    record_to_row,
    records_equal,
    row_text,
    row_to_record,
    row_to_typed_record,
    typed_record_get,
    typed_record_to_row,
)
from .tenancy import (
    catalog_for,
    database_for,
    is_valid_tenant,
    spark_database,
    tenant_catalog,
    tenant_catalog_or_null,
)

__all__ = [
    "catalog_for",
    "database_for",
    "dialect_for_url",
    "dialect_name",
    "is_valid_tenant",
    "not_blank",
    "qualified_name",
    "quote_identifier",
    "quote_name",
    "record_columns",
    "record_get",
    "record_has",
    "record_set",
    "record_size",
    "record_to_row",
    "records_equal",
    "redact_sources",
    "redact_url",
    "row_text",
    "row_to_record",
    "row_to_typed_record",
    "source_supported",
    "spark_database",
    "spark_name",
    "tenant_catalog",
    "tenant_catalog_or_null",
    "typed_record_get",
    "typed_record_to_row",
    "validate_sources",
]
