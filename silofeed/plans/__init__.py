"""Jobs that are put together from sources, operators and sinks."""

from .jobs import (
    IngestRequest,
    admit,
    copy_table,
    ingest_lines,
    ingest_source,
    ingest_table,
    ingest_tenants,
    require_admitted,
    tenant_verdicts,
    validate_jobs,
)
from .ranges import Ranges, read_ranges, sync_ranges
from .snapshot import follow_log, read_snapshot, snapshot_with_log
from .sync import read_increment, sync_changes, sync_full, sync_incremental, sync_tenant_incremental

__all__ = [
    "IngestRequest",
    "Ranges",
    "admit",
    "copy_table",
    "follow_log",
    "ingest_lines",
    "ingest_source",
    "ingest_table",
    "ingest_tenants",
    "read_increment",
    "read_ranges",
    "read_snapshot",
    "require_admitted",
    "snapshot_with_log",
    "sync_changes",
    "sync_full",
    "sync_incremental",
    "sync_ranges",
    "sync_tenant_incremental",
    "tenant_verdicts",
    "validate_jobs",
]
