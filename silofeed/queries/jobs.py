"""Tenant tables, synchronisation and streams."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    NotYours,
    apply_changes,
    apply_to_buckets,
    compact,
    create_bucketed,
    create_tenant_database,
    latest_changes,
    read_bucketed,
    read_tenant,
    read_tenant_table,
    route_records,
    tenant_query,
    write_fan_out,
)
from ..plans import (
    Ranges,
    follow_log,
    ingest_tenants,
    read_ranges,
    read_snapshot,
    snapshot_with_log,
    sync_changes,
    sync_full,
    sync_incremental,
    sync_ranges,
    sync_tenant_incremental,
)
from ..streaming import ingest_stream, land_changes
from ..workspace import new_folder
from .records import STATE_SQL, USER_GONE, USER_KEY, USER_ORDER, state_and_log
from .registry import query, table
from .tenants import QUOTAS_SQL, orders_per_tenant, orders_with_tenant, tenant_quotas

TENANT_ORDERS_SQL = """
    SELECT o_orderkey, o_custkey, o_totalprice, 'df_' || lower(c_mktsegment) AS tenant_catalog
    FROM orders JOIN customer ON o_custkey = c_custkey"""


def fanned_out(spark: SparkSession, sf_dir: str) -> str:
    """Two runs: the second adds a column; the first is then repeated without one of its tenants."""
    path = new_folder(spark, "orders")
    rows = orders_with_tenant(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "tenant")
    routed, _ = route_records(rows, "tenant", "orders")
    first = routed.filter("o_orderstatus <> 'F'").drop("tenant", "o_orderstatus")
    write_fan_out(first, path, "first")
    write_fan_out(routed.filter("o_orderstatus = 'F'").drop("tenant"), path, "second")
    write_fan_out(first.filter("tenant_catalog <> 'df_building'"), path, "first")
    return path


RUNS_SQL = """
    SELECT o_orderkey, o_custkey, o_totalprice, CASE o_orderstatus WHEN 'F' THEN 'F' END AS o_orderstatus,
           'df_' || lower(c_mktsegment) AS tenant_catalog
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' OR c_mktsegment <> 'BUILDING'"""


@query("fan_out", RUNS_SQL)
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of all tenants written by several runs, and read back."""
    return spark.read.option("mergeSchema", True).parquet(fanned_out(spark, sf_dir)).drop("run_id")


@query("tenant_table", f"""
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM ({RUNS_SQL}) o
    WHERE tenant_catalog = 'df_furniture'""")
def one_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tenant of a fanned-out table; the files of the others are not looked at."""
    return read_tenant(spark, fanned_out(spark, sf_dir), "furniture")


@query("ingest_tenants", f"""
    WITH o AS ({TENANT_ORDERS_SQL}),
    refused AS (
        SELECT 'df_' || p.tenant AS tenant_catalog
        FROM (SELECT tenant_catalog[4:] AS tenant, count(*) AS planned FROM o GROUP BY 1) p
        LEFT JOIN ({QUOTAS_SQL}) q ON p.tenant = q.tenant
        WHERE planned > coalesce(max_records, 1000000))
    SELECT * FROM o WHERE tenant_catalog NOT IN (SELECT tenant_catalog FROM refused)""")
def admitted_tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over all tenants that leaves out those whose quota it would exceed."""
    path = new_folder(spark, "orders")
    rows = orders_with_tenant(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice", "tenant")
    quotas = tenant_quotas(spark, sf_dir)
    planned = orders_per_tenant(spark, sf_dir)
    ingest_tenants(rows, "tenant", "orders", path, "first", quotas, 4, skip_refused=True, planned=planned)
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_totalprice", "tenant_catalog")


def tenant_database(spark: SparkSession, tenant: str) -> None:
    """Database of a tenant whose files lie in the shared folder."""
    create_tenant_database(spark, tenant, new_folder(spark, tenant))


@query("sync_full", "SELECT * FROM embeddings")
def full_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    tenant_database(spark, "sync-full")
    sync_full(table(spark, sf_dir, "embeddings"), "sync-full", "embeddings")
    return read_tenant_table(spark, "sync-full", "embeddings")


@query("sync_incremental", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'")
def incremental_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = sync_incremental(table(spark, sf_dir, "events"), "ts", datetime.datetime(2024, 1, 15))
    return rows


@query("sync_tenant_incremental", "SELECT * FROM events")
def incremental_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as it was in the middle of the month, and then the whole log from a day before."""
    events, tenant = table(spark, sf_dir, "events"), "sync-incremental"
    tenant_database(spark, tenant)
    sync_full(events.filter("ts <= timestamp_ntz'2024-01-15 00:00:00'"), tenant, "events")
    day = datetime.timedelta(days=1)
    sync_tenant_incremental(events, tenant, "events", "ts", keys=["event_id"], overlap=day)
    return read_tenant_table(spark, tenant, "events")


@query("sync_incremental_versions", """
    SELECT event_id, user_id, value, ts FROM events WHERE ts IS NOT NULL AND event_id % 5 <> 0
    UNION ALL SELECT event_id, user_id, value, CAST(NULL AS TIMESTAMP) FROM events WHERE event_id % 5 = 0
    UNION ALL SELECT event_id, user_id, value, ts + INTERVAL 1 SECOND FROM events
    WHERE event_id % 5 <> 0 AND event_id % 7 = 0 AND ts > (
        SELECT max(ts) FROM events WHERE event_id % 5 <> 0) - INTERVAL 1 DAY""")
def new_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows within the overlap that have changed since are new versions; rows without a cursor come once."""
    events, tenant = table(spark, sf_dir, "events"), "sync-versions"
    cursor = F.when(F.col("event_id") % 5 != 0, F.col("ts")).alias("ts")
    before = events.select("event_id", "user_id", "value", cursor)
    day, last = datetime.timedelta(days=1), before.agg(F.max("ts")).first()[0]
    moved = (F.col("event_id") % 7 == 0) & (F.col("ts") > F.lit(str(last - day)).cast("timestamp_ntz"))
    after = before.withColumn("ts", F.when(moved, F.expr("ts + INTERVAL 1 SECOND")).otherwise(F.col("ts")))
    tenant_database(spark, tenant)
    for rows in (before, before, after):
        sync_tenant_incremental(rows, tenant, "events", "ts", keys=["event_id"], overlap=day)
    return read_tenant_table(spark, tenant, "events")


@query("sync_changes", STATE_SQL)
def synced_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of every user in a tenant's table: the later half of the log comes first, then the earlier one, then both."""
    tenant, events = "sync-changes", table(spark, sf_dir, "events")
    snapshot, later = state_and_log(spark, sf_dir)
    tenant_database(spark, tenant)
    sync_full(snapshot.filter(F.lit(False)), tenant, "users")
    for log in (later, events.join(later.select("event_id"), "event_id", "left_anti"), events):
        sync_changes(log, tenant, "users", USER_KEY, USER_ORDER, USER_GONE)
    return read_tenant_table(spark, tenant, "users")


@query("bucketed_changes", STATE_SQL)
def changed_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of every user in a table of buckets: the later half of the log first, the earlier one, then both again."""
    path, events = new_folder(spark, "users"), table(spark, sf_dir, "events")
    snapshot, later = state_and_log(spark, sf_dir)
    schema = events.select("user_id", "event_id", "event_type", "value", "ts").schema
    create_bucketed(spark, path, schema, USER_KEY, USER_ORDER, 8)
    for log in (later, events.join(later.select("event_id"), "event_id", "left_anti"), events):
        apply_to_buckets(log, path, USER_GONE)
    compact(spark, path)
    return read_bucketed(spark, path).select(*snapshot.columns)


@query("incremental_snapshot", """
    SELECT user_id, event_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
    WHERE rn = 1 AND event_type <> 'error'""")
def snapshot_of_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of all users, read in chunks while it changes: every look at it, or at its log, sees a longer log."""
    path, events = new_folder(spark, "snapshot"), table(spark, sf_dir, "events")
    last, chunks, looks = events.agg(F.max("event_id")).first()[0] or 0, 4, iter(range(1, 1000))

    def log() -> DataFrame:
        # Each look is a fourteenth of the log further; the log ends while the last chunk is read.
        return events.filter(F.col("event_id") <= last * next(looks) // 14)

    def state() -> DataFrame:
        newest = latest_changes(log(), USER_KEY, ["event_id"])
        return newest.filter(f"NOT ({USER_GONE})").select("user_id", "event_id", "event_type", "value")

    # The first call stops half way, the second goes on.
    for at_most in (chunks // 2, None):
        done = snapshot_with_log(state, log, path, USER_KEY, "event_id", chunks, 8, USER_GONE, at_most)
    follow_log(events, path, "event_id", USER_GONE, after=done[0].low)
    return read_snapshot(spark, path)


@query("sync_ranges", """
    SELECT event_id, user_id, CASE WHEN event_id % 5 <> 0 THEN ts END AS ts,
           CASE WHEN event_id % 10 = 0 OR ts < TIMESTAMP '2024-01-03 00:00:00' THEN value + 1 ELSE value END AS value
    FROM events WHERE event_id % 15 <> 0""")
def ranges_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of events, copied twice: in between, rows without a cursor and rows of old days change, and some go."""
    path = new_folder(spark, "ranges")
    before = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.when(F.col("event_id") % 5 != 0, F.col("ts")).alias("ts"), F.col("ts").alias("day"), "value")
    changed = (F.col("event_id") % 10 == 0) | (F.col("day") < F.expr("timestamp_ntz'2024-01-03 00:00:00'"))
    after = before.withColumn("value", F.when(changed, F.col("value") + 1).otherwise(F.col("value"))).filter("event_id % 15 <> 0")
    for rows in (before, after):
        sync_ranges(rows.drop("day"), path, Ranges("ts"))
    return read_ranges(spark, path)


@query("isolated_query", """
    SELECT c_nationkey, count(*) AS customers, min(c_custkey) AS first FROM customer
    WHERE c_mktsegment = 'BUILDING' AND c_custkey > (SELECT min(c_custkey) FROM customer WHERE c_mktsegment = 'BUILDING')
    GROUP BY c_nationkey""")
def query_of_one_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each segment's customers belong to a tenant; one of them asks for its own, and in vain for another's."""
    customers = table(spark, sf_dir, "customer")
    for segment in ("BUILDING", "MACHINERY"):
        tenant = f"own-{segment.lower()}"
        tenant_database(spark, tenant)
        sync_full(customers.filter(F.col("c_mktsegment") == segment), tenant, "customers")
    try:
        tenant_query(spark, "own-building", "SELECT * FROM customers UNION ALL SELECT * FROM df_own_machinery.customers")
        raise AssertionError("the rows of another tenant were given away")
    except NotYours:
        pass
    return tenant_query(spark, "own-building", """
        SELECT c_nationkey, count(*) AS customers, min(c_custkey) AS first FROM customers
        WHERE c_custkey > (SELECT min(c_custkey) FROM customers) GROUP BY c_nationkey""")


def event_halves(spark: SparkSession, sf_dir: str) -> list[str]:
    """The events as two folders of files, told apart by a condition."""
    events, root = table(spark, sf_dir, "events"), new_folder(spark, "sources")
    folders = []
    for name, condition in (("even", "event_id % 2 = 0"), ("odd", "event_id % 2 <> 0 OR event_id IS NULL")):
        folders.append(f"{root}/{name}")
        events.filter(condition).write.parquet(folders[-1])
    return folders


@query("ingest_stream", """
    SELECT event_id, ts, user_id, event_type, value, props, 'df_' || event_type AS tenant_catalog FROM events""")
def streamed_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources, in two runs, into one table; each tenant's quota is what the larger of its runs needs."""
    events = table(spark, sf_dir, "events")
    path, checkpoint = new_folder(spark, "events"), new_folder(spark, "stream")
    quotas = events.groupBy(F.col("event_type").alias("tenant")).agg(
        F.count(F.lit(1)).alias("max_records"), F.lit(4).alias("max_parallelism"))
    for n, folder in enumerate(event_halves(spark, sf_dir)):
        ingest_stream(spark, folder, events.schema, "event_type", path, f"{checkpoint}/{n}", quotas, parallelism=4)
    return spark.read.parquet(path).drop("run_id")


@query("stream_changes", STATE_SQL)
def streamed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log arrives as two streams; what the snapshot knows already does no harm."""
    events = table(spark, sf_dir, "events")
    path, checkpoint = new_folder(spark, "changes"), new_folder(spark, "stream")
    for n, folder in enumerate(event_halves(spark, sf_dir)):
        log = land_changes(spark, folder, events.schema, path, f"{checkpoint}/{n}")
    snapshot, _ = state_and_log(spark, sf_dir)
    return apply_changes(snapshot, log, USER_KEY, USER_ORDER, USER_GONE)
