"""Sources: databases, parquet folders and tables of the Spark catalog."""

from .config import JDBC, PARQUET, TABLE, SourceConfig, TableRef
from .lake import declare_key
from .metadata import describe_tables, list_schemas, list_tables, primary_key_columns, require_tables
from .tables import append_table, count_table, count_table_by_tenant, describe_table, read_table

__all__ = [
    "JDBC",
    "PARQUET",
    "TABLE",
    "SourceConfig",
    "TableRef",
    "append_table",
    "count_table",
    "count_table_by_tenant",
    "declare_key",
    "describe_table",
    "describe_tables",
    "list_schemas",
    "list_tables",
    "primary_key_columns",
    "read_table",
    "require_tables",
]
