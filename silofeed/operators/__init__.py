"""Operators over rows: alignment, routing, admission, comparison, changes and tenant tables."""

from .align import align_to_schema, align_with_rejects
from .buckets import (
    StaleVersion,
    apply_to_buckets,
    compact,
    create_bucketed,
    manifest,
    read_bucketed,
    versions,
)
from .changes import apply_changes, latest_changes
from .compare import diff_tables, tables_equal
from .isolation import NotYours, foreign_relations, tenant_query
from .quota import (
    QuotaExceeded,
    TenantQuota,
    check_quota,
    count_by_tenant,
    planned_records,
    quota_verdicts,
    validate_quotas,
)
from .routing import route_line, route_records
from .sinks import (
    cluster_by_tenant,
    create_tenant_database,
    publish_snapshot,
    read_tenant,
    read_tenant_table,
    register_tenant,
    tenant_table,
    write_fan_out,
    write_tenant_table,
)

__all__ = [
    "NotYours",
    "QuotaExceeded",
    "StaleVersion",
    "TenantQuota",
    "align_to_schema",
    "align_with_rejects",
    "apply_changes",
    "apply_to_buckets",
    "check_quota",
    "cluster_by_tenant",
    "compact",
    "count_by_tenant",
    "create_bucketed",
    "create_tenant_database",
    "diff_tables",
    "foreign_relations",
    "latest_changes",
    "manifest",
    "planned_records",
    "publish_snapshot",
    "quota_verdicts",
    "read_bucketed",
    "read_tenant",
    "read_tenant_table",
    "register_tenant",
    "tenant_table",
    "route_line",
    "route_records",
    "tables_equal",
    "tenant_query",
    "tenant_table",
    "validate_quotas",
    "versions",
    "write_fan_out",
    "write_tenant_table",
]
