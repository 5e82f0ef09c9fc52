"""Admission of ingest jobs against tenant quotas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tenancy import as_column

# The quota of a tenant that has none of its own.
DEFAULT_MAX_RECORDS = 1_000_000
DEFAULT_MAX_PARALLELISM = 4


class QuotaExceeded(RuntimeError):
    """A job asks for more than its tenant may use."""


@dataclass(frozen=True)
class TenantQuota:
    """Largest number of rows and of parallel writers of one run. Reaching a limit is allowed."""

    max_records: int = DEFAULT_MAX_RECORDS
    max_parallelism: int = DEFAULT_MAX_PARALLELISM

    def __post_init__(self):
        if self.max_records <= 0:
            raise ValueError("maxRecordsPerRun must be > 0")
        if self.max_parallelism <= 0:
            raise ValueError("maxParallelism must be > 0")


def check_quota(tenant: str, planned: int, parallelism: int, quota: TenantQuota) -> None:
    """Raise :class:`QuotaExceeded` when one job is over its quota; rows are looked at first."""
    if planned > quota.max_records:
        raise QuotaExceeded(f"tenant '{tenant}' planned {planned} records exceeds quota {quota.max_records}")
    if parallelism > quota.max_parallelism:
        raise QuotaExceeded(
            f"tenant '{tenant}' parallelism {parallelism} exceeds quota {quota.max_parallelism}"
        )


def planned_records(df: DataFrame) -> int:
    """Rows a job would move: a distributed count, which reads no column of a parquet table."""
    return df.count()


def count_by_tenant(df: DataFrame, tenant: Column | str) -> DataFrame:
    """Planned rows per tenant. Rows are counted before the shuffle, so a large tenant costs no more."""
    return df.groupBy(as_column(tenant).alias("tenant")).agg(F.count(F.lit(1)).alias("planned"))


def validate_quotas(quotas: DataFrame) -> DataFrame:
    """Adds ``error`` to quotas (``tenant, max_records, max_parallelism``), null where they are valid."""

    def positive(name: str) -> Column:
        return F.coalesce(F.col(name) > 0, F.lit(False))

    error = F.when(~positive("max_records"), F.lit("maxRecordsPerRun must be > 0")).when(
        ~positive("max_parallelism"), F.lit("maxParallelism must be > 0")
    )
    return quotas.withColumn("error", error)


def quota_verdicts(jobs: DataFrame, quotas: DataFrame | None = None) -> DataFrame:
    """One verdict per job (``tenant, planned, parallelism``).

    ``quotas`` has at most one row per tenant; tenants without one get the default quota. The result has
    the columns of ``jobs``, the two limits, ``admitted`` and ``message`` (null for admitted jobs). A job without a
    tenant, a number of rows or a parallelism is refused.
    """
    max_records, max_parallelism = F.lit(DEFAULT_MAX_RECORDS).cast("long"), F.lit(DEFAULT_MAX_PARALLELISM)
    if quotas is not None:
        limits = quotas.select(
            "tenant", F.col("max_records").alias("_records"), F.col("max_parallelism").alias("_parallelism")
        )
        # Catalyst broadcasts the quotas only while they are below its size limit.
        jobs = jobs.join(limits, "tenant", "left")
        max_records = F.coalesce(F.col("_records").cast("long"), max_records)
        max_parallelism = F.coalesce(F.col("_parallelism").cast("int"), max_parallelism)
    known = F.concat(F.lit("tenant '"), F.coalesce("tenant", F.lit("null")), F.lit("'"))
    over_records = F.concat(
        known, F.lit(" planned "), F.col("planned").cast("string"),
        F.lit(" records exceeds quota "), F.col("max_records").cast("string"),
    )
    over_parallelism = F.concat(
        known, F.lit(" parallelism "), F.col("parallelism").cast("string"),
        F.lit(" exceeds quota "), F.col("max_parallelism").cast("string"),
    )
    message = (
        F.when(F.col("planned") > F.col("max_records"), over_records)
        .when(F.col("parallelism") > F.col("max_parallelism"), over_parallelism)
        .when(F.col("tenant").isNull(), F.lit("tenant must not be null"))
        .when(F.col("planned").isNull(), F.concat(known, F.lit(" has no planned records")))
        .when(F.col("parallelism").isNull(), F.concat(known, F.lit(" has no parallelism")))
    )
    return (
        jobs.withColumns({"max_records": max_records, "max_parallelism": max_parallelism})
        .withColumn("message", message)
        .withColumn("admitted", F.col("message").isNull())
        .drop("_records", "_parallelism")
    )
