"""Tables of tenants in the lake."""

from __future__ import annotations

import re
import uuid
from urllib.parse import quote_plus

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import spark_name
from ..functions.tenancy import catalog_for, database_for
from ..workspace import match_files, remove_folder
from .align import align_to_schema
from .routing import TARGET_TABLE, TENANT_CATALOG

RUN_ID = "run_id"


def cluster_by_tenant(df: DataFrame) -> DataFrame:
    """Bring the rows of a tenant together before a write that is partitioned by tenant.

    Without it every task writes a file per tenant. A plain repartition would hand a large tenant to one
    task; rebalancing splits it by size and merges small tenants. That needs adaptive execution; without
    it the rows stay where they are, which costs files but no balance.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", TENANT_CATALOG)
    return df


def gather(df: DataFrame) -> DataFrame:
    """Bring few rows out of many partitions together, so that not every task writes a small file."""
    return df.hint("rebalance")


def run_folder(run_id: str) -> str:
    """Folder of a run as Spark names it: of what ``quote_plus`` leaves, Spark escapes the percent signs again."""
    return f"{RUN_ID}=" + quote_plus(run_id).replace("%", "%25")


def write_run(rows: DataFrame, path: str, run_id: str, *partition_by: str, writers: int | None = None) -> None:
    """Write the rows of one run to a table of many runs, partitioned by ``partition_by`` and the run.

    A run replaces what the same run has written before, also where it has no rows any more, and touches no other.
    ``writers`` bounds the number of tasks that write at a time.
    """
    taken = [c for c in rows.columns if c.lower() == RUN_ID]
    if taken:
        raise ValueError(f"the column {taken[0]} is where the name of a run goes: rename it")
    spark, name = rows.sparkSession, run_folder(run_id)
    if TENANT_CATALOG in partition_by:
        rows = cluster_by_tenant(rows)
    if writers:
        rows = rows.coalesce(writers)
    there = f"{path}/" + "/".join([*[f"{c}=*" for c in partition_by], name, "*"])
    before = set(match_files(spark, there))
    (
        rows.withColumn(RUN_ID, F.lit(quote_plus(run_id)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by, RUN_ID)
        .parquet(path)
    )
    # Partitions that this run has not written again still hold the files of the last time.
    for file in before.intersection(match_files(spark, there)):
        remove_folder(spark, file)


def write_fan_out(routed: DataFrame, path: str, run_id: str, writers: int | None = None) -> None:
    """Write routed rows of many tenants to one table, partitioned by tenant and run; see :func:`write_run`."""
    write_run(routed.drop(TARGET_TABLE), path, run_id, TENANT_CATALOG, writers=writers)


def read_tenant(spark: SparkSession, path: str, tenant: str) -> DataFrame:
    """Rows of one tenant; the files of other tenants are not looked at.

    The columns are those of all its runs, so that a run may add some: the footers are read on the executors.
    """
    reader = spark.read.option("mergeSchema", True)
    return reader.parquet(f"{path}/{TENANT_CATALOG}={catalog_for(tenant)}").drop(RUN_ID)


def tenant_table(tenant: str, table: str) -> str:
    """Name of a tenant's table in the Spark catalog."""
    if not re.fullmatch("[A-Za-z0-9_]+", table):
        raise ValueError(f"illegal table name: {table}")
    return f"`{database_for(tenant)}`.`{table}`"


def _text(value: str) -> str:
    """Text literal of Spark SQL."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def create_tenant_database(spark: SparkSession, tenant: str, location: str | None = None) -> None:
    """Database of a tenant, in the warehouse or in a folder of its own."""
    place = "" if location is None else f" LOCATION {_text(location)}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database_for(tenant)}`{place}")


def register_tenant(spark: SparkSession, path: str, tenant: str, table: str) -> None:
    """Make a tenant's part of a fanned-out table known in the tenant's database, as a view of its folder.

    The rows stay where the fan-out has put them, and those of later runs are seen. The view has the columns that
    :func:`read_tenant` finds on that day; register it again after a run that adds some. A table of that name is not
    given up for it.
    """
    name = tenant_table(tenant, table)
    create_tenant_database(spark, tenant)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table with rows of its own")
    folder = f"{path}/{TENANT_CATALOG}={catalog_for(tenant)}".replace("`", "``")
    columns = ", ".join(map(spark_name, read_tenant(spark, path, tenant).columns))
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{folder}` WITH ('mergeSchema' = 'true')")


def read_tenant_table(spark: SparkSession, tenant: str, table: str) -> DataFrame:
    return spark.table(tenant_table(tenant, table))


def write_tenant_table(df: DataFrame, tenant: str, table: str) -> None:
    """Append to a tenant's table, aligned to its columns; the first write creates it."""
    spark, name = df.sparkSession, tenant_table(tenant, table)
    create_tenant_database(spark, tenant)
    if spark.catalog.tableExists(name):
        df = align_to_schema(df, spark.table(name).schema)
    df.write.mode("append").format("parquet").saveAsTable(name)


def publish_snapshot(df: DataFrame, tenant: str, table: str) -> None:
    """Replace the content of a tenant's table.

    The rows go to a new folder and the table is pointed at it at the end. ``df`` may therefore read the
    table itself, queries that are running keep the old rows, and a failed job changes nothing. The old
    folder is left for the lake's own clean-up.
    """
    spark, name = df.sparkSession, tenant_table(tenant, table)
    create_tenant_database(spark, tenant)
    root = spark.catalog.getDatabase(database_for(tenant)).locationUri
    folder = f"{root}/{table}-{uuid.uuid4().hex}"
    if spark.catalog.tableExists(name):
        df = align_to_schema(df, spark.table(name).schema)
        df.write.parquet(folder)
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(folder)}")
        spark.catalog.refreshTable(name)
    else:
        df.write.parquet(folder)
        spark.catalog.createTable(name, path=folder, source="parquet", schema=df.schema)
