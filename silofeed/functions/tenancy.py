"""Tenant ids and the isolated catalog each of them maps to."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Catalog prefix, and the form of a legal tenant id (whole string, 1-63 characters).
TENANT_PREFIX = "df_"
TENANT_ID = "[a-z0-9][a-z0-9-]{0,62}"

# `$` would also accept a trailing line break, so the column form is anchored with \A and \z.
_WHOLE_ID = rf"\A{TENANT_ID}\z"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_valid_tenant(tenant: Column | str) -> Column:
    """True where the whole value is a legal tenant id; null is not legal."""
    return F.coalesce(as_column(tenant).rlike(_WHOLE_ID), F.lit(False))


def illegal_tenant_message(tenant: Column | str) -> Column:
    shown = F.coalesce(as_column(tenant), F.lit("null"))
    return F.concat(F.lit("illegal tenantId: "), shown)


def tenant_catalog(tenant: Column | str, strict: bool = True) -> Column:
    """Catalog of a tenant; an illegal id fails the query.

    With ``strict=False`` a missing (null) tenant gives a null catalog, which suits overviews that are
    not bound to one tenant. An illegal id fails either way.
    """
    tenant = as_column(tenant)
    known = F.when(is_valid_tenant(tenant), F.concat(F.lit(TENANT_PREFIX), tenant))
    failed = F.raise_error(illegal_tenant_message(tenant))
    if strict:
        return known.otherwise(failed)
    return known.when(tenant.isNull(), F.lit(None)).otherwise(failed)


def tenant_catalog_or_null(tenant: Column | str) -> Column:
    """Catalog of a tenant, null where the id is missing or illegal (for splitting off rejects)."""
    tenant = as_column(tenant)
    return F.when(is_valid_tenant(tenant), F.concat(F.lit(TENANT_PREFIX), tenant))


def spark_database(catalog: Column | str) -> Column:
    """Spark database that holds a tenant catalog.

    Spark's session catalog refuses hyphens. Underscores cannot occur in a tenant id, so replacing the
    one by the other keeps tenants apart.
    """
    return F.translate(as_column(catalog), "-", "_")


def catalog_for(tenant: str | None) -> str:
    """Catalog name of one tenant, for job set-up on the driver."""
    if tenant is None or not re.fullmatch(TENANT_ID, tenant):
        raise ValueError(f"illegal tenantId: {tenant}")
    return TENANT_PREFIX + tenant


def database_for(tenant: str) -> str:
    return catalog_for(tenant).replace("-", "_")
