"""Names of tables, columns and SQL dialects as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .tenancy import as_column

# URL prefix of each dialect, checked in this order.
DIALECT_PREFIXES = (
    ("jdbc:postgresql:", "postgresql"),
    ("jdbc:mysql:", "mysql"),
    ("jdbc:dm:", "dm"),
    ("jdbc:kingbase8:", "kingbase"),
    ("jdbc:oceanbase:", "oceanbase"),
)
FALLBACK_DIALECT = "ansi"
SPARK_DIALECT = "spark"
BACKTICK_DIALECTS = ("mysql", SPARK_DIALECT)

# One character that is not white space. Non-breaking spaces count as text.
NON_BLANK = "[^\\t-\\r\\x1c-\\x1f\\p{Z}]|[\\u00a0\\u2007\\u202f]"


def not_blank(value: Column | str) -> Column:
    return F.coalesce(as_column(value).rlike(NON_BLANK), F.lit(False))


def dialect_for_url(url: Column | str) -> Column:
    url = as_column(url)
    matches = [F.when(url.startswith(prefix), F.lit(name)) for prefix, name in DIALECT_PREFIXES]
    return F.coalesce(*matches, F.lit(FALLBACK_DIALECT))


def quote_identifier(name: Column | str, dialect: Column | str = FALLBACK_DIALECT) -> Column:
    """Quoted identifier; ``dialect`` is a dialect name, or a column holding one per row."""
    name = as_column(name)
    dialect = F.lit(dialect) if isinstance(dialect, str) else dialect
    mark = F.when(dialect.isin(*BACKTICK_DIALECTS), F.lit("`")).otherwise(F.lit('"'))
    return F.concat(mark, F.replace(name, mark, F.concat(mark, mark)), mark)


def qualified_name(catalog: Column | str, schema: Column | str, name: Column | str) -> Column:
    """``catalog.schema.name`` without its blank parts; a blank table name fails the query."""
    name = as_column(name)
    shown = F.when(not_blank(name), name).otherwise(F.raise_error(F.lit("table name must not be blank")))
    parts = [F.when(not_blank(part), as_column(part)) for part in (catalog, schema)]
    return F.concat_ws(".", *parts, shown)


def dialect_name(url: str | None) -> str:
    """Dialect of one URL, for building options on the driver."""
    matches = (name for prefix, name in DIALECT_PREFIXES if (url or "").startswith(prefix))
    return next(matches, FALLBACK_DIALECT)


def spark_name(name: str) -> str:
    """Quoted name for Spark itself, which also keeps a dot in it from being read as a separator."""
    return quote_name(name, SPARK_DIALECT)


def quote_name(name: str, dialect: str = FALLBACK_DIALECT) -> str:
    mark = "`" if dialect in BACKTICK_DIALECTS else '"'
    return mark + name.replace(mark, mark * 2) + mark
