"""Tag rows with the tenant table they belong to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tenancy import TENANT_PREFIX, as_column, illegal_tenant_message, is_valid_tenant

TENANT_CATALOG = "tenant_catalog"
TARGET_TABLE = "target_table"
REJECT_REASON = "reject_reason"


def route_line(row: Column | str, catalog: Column | str, table: Column | str) -> Column:
    """Text row with its target in front: ``<catalog>.<table> <= <row>``.

    ``catalog`` and ``table`` are column names or columns. A null row gives a null line.
    """
    return F.concat(as_column(catalog), F.lit("."), as_column(table), F.lit(" <= "), as_column(row))


def route_records(df: DataFrame, tenant: Column | str, table: Column | str) -> tuple[DataFrame, DataFrame]:
    """Rows tagged with their tenant catalog and target table, and the rows that have no legal tenant.

    The tenant is taken from a column, so one job routes any number of tenants without a shuffle.
    """
    taken = [c for c in df.columns if c.lower() in (TENANT_CATALOG, TARGET_TABLE)]
    if taken:
        raise ValueError(f"the column {taken[0]} is added by routing: rename it")
    tenant = as_column(tenant)
    target = F.lit(table) if isinstance(table, str) else table
    catalog = F.concat(F.lit(TENANT_PREFIX), tenant)
    routed = df.filter(is_valid_tenant(tenant)).select(
        "*", catalog.alias(TENANT_CATALOG), target.alias(TARGET_TABLE)
    )
    rejected = df.filter(~is_valid_tenant(tenant)).withColumn(REJECT_REASON, illegal_tenant_message(tenant))
    return routed, rejected
