"""Records, alignment, comparison and changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType, StructType, TimestampNTZType

from ..functions import (
    record_columns,
    record_get,
    record_has,
    record_set,
    record_size,
    record_to_row,
    records_equal,
    row_to_record,
    row_to_typed_record,
    typed_record_to_row,
)
from ..operators import align_to_schema, align_with_rejects, apply_changes, diff_tables, latest_changes
from .registry import as_double, derived, query, table

ORDER_ROWS = {
    "o_orderkey": "o_orderkey",
    "status": "nullif(o_orderstatus, 'F')",
    "amount": "CAST(o_totalprice AS DECIMAL(18, 2))",
    "placed": "o_orderdate",
}
ORDER_SCHEMA = (
    StructType()
    .add("o_orderkey", LongType())
    .add("status", StringType())
    .add("amount", DecimalType(18, 2))
    .add("placed", TimestampNTZType())
)


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived(table(spark, sf_dir, "orders"), ORDER_ROWS)
    return rows.select("o_orderkey", row_to_record(rows).alias("record"))


@query("record_functions", """
    SELECT o_orderkey, nullif(o_orderstatus, 'F') AS got,
           CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS amount,
           CAST(NULL AS VARCHAR) AS got_absent, true AS has_status, false AS has_absent, 4 AS n,
           'o_orderkey,status,amount,placed' AS names
    FROM orders""")
def record_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_records(spark, sf_dir).select(
        "o_orderkey",
        record_get("record", "status").alias("got"),
        record_get("record", "amount").alias("amount"),
        record_get("record", "absent").alias("got_absent"),
        record_has("record", "status").alias("has_status"),
        record_has("record", "absent").alias("has_absent"),
        record_size("record").alias("n"),
        F.array_join(record_columns("record"), ",").alias("names"),
    )


@query("record_round_trip", """
    SELECT o_orderkey, nullif(o_orderstatus, 'F') AS status,
           CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS amount, o_orderdate AS placed
    FROM orders""")
def record_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    restored = order_records(spark, sf_dir).select(*record_to_row("record", ORDER_SCHEMA))
    return restored.withColumn("amount", as_double("amount"))


@query("record_set", """
    SELECT o_orderkey, 'o_orderkey,status,amount,placed,note' AS names, 'x' || o_orderkey AS status,
           CAST(o_orderkey AS VARCHAR) AS note
    FROM orders""")
def record_building(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Setting a column that is there keeps its place; a new one goes to the end."""
    key = F.col("o_orderkey").cast("string")
    records = order_records(spark, sf_dir)
    for column, value in (("status", F.concat(F.lit("x"), key)), ("note", key)):
        records = records.withColumn("record", record_set("record", column, value))
    return records.select(
        "o_orderkey",
        F.array_join(record_columns("record"), ",").alias("names"),
        record_get("record", "status").alias("status"),
        record_get("record", "note").alias("note"),
    )


@query("records_equal", """
    SELECT o_orderkey, true AS same_content, o_orderstatus = 'F' AS same_without_status
    FROM orders""")
def record_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived(table(spark, sf_dir, "orders"), ORDER_ROWS)
    record = row_to_record(rows)
    return rows.select(
        "o_orderkey",
        records_equal(record, row_to_record(rows, rows.columns[::-1])).alias("same_content"),
        records_equal(record, record_set(record, "status", F.lit(None))).alias("same_without_status"),
    )


CONTRACT_SCHEMA = (
    StructType().add("id", LongType()).add("tenant", StringType()).add("amount", DecimalType(12, 2))
)


@query("align_schema", """
    SELECT o_orderkey AS id, CAST(NULL AS VARCHAR) AS tenant,
           CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE) AS amount
    FROM orders""")
def aligned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that are reordered, extra, absent, and spelled in another case."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.selectExpr("o_totalprice AS amount", "o_custkey", "o_orderkey AS id", "o_orderstatus AS TENANT")
    return align_to_schema(rows, CONTRACT_SCHEMA).withColumn("amount", as_double("amount"))


SIZES = {"p_partkey": "p_partkey", "size": "CASE WHEN p_size > 25 THEN p_name ELSE CAST(p_size AS STRING) END"}
SIZE_SCHEMA = StructType().add("p_partkey", LongType()).add("size", IntegerType())


@query("align_fitting", "SELECT p_partkey, p_size AS size FROM part WHERE p_size <= 25")
def aligned_fitting(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitting, _ = align_with_rejects(derived(table(spark, sf_dir, "part"), SIZES), SIZE_SCHEMA)
    return fitting


@query("align_rejects", "SELECT p_partkey, p_name AS size FROM part WHERE p_size > 25")
def aligned_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = align_with_rejects(derived(table(spark, sf_dir, "part"), SIZES), SIZE_SCHEMA)
    return rejected




@query("diff_tables", """
    WITH side AS (
        SELECT l_suppkey, l_returnflag, 1 AS n FROM lineitem WHERE l_linestatus = 'O'
        UNION ALL SELECT l_suppkey, l_returnflag, -1 AS n FROM lineitem WHERE l_linestatus <> 'O'),
    balance AS (SELECT l_suppkey, l_returnflag, CAST(sum(n) AS BIGINT) AS n FROM side GROUP BY 1, 2)
    SELECT l_suppkey, l_returnflag, CASE WHEN n > 0 THEN 'left' ELSE 'right' END AS side, abs(n) AS copies
    FROM balance WHERE n <> 0""")
def table_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open against finished lines, as bags of supplier and flag; the columns come in another order."""
    lines = table(spark, sf_dir, "lineitem")
    left = lines.filter("l_linestatus = 'O'").select("l_suppkey", "l_returnflag")
    right = lines.filter("l_linestatus <> 'O'").select("l_returnflag", "l_suppkey")
    return diff_tables(left, right)


@query("typed_record_vectors", "SELECT * FROM embeddings")
def typed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with arrays as typed records, and back."""
    vectors = table(spark, sf_dir, "embeddings")
    record = vectors.select(row_to_typed_record(vectors).alias("record"))
    return record.select(*typed_record_to_row("record", vectors.schema))


@query("typed_record_events", """
    SELECT event_id, ts, value, [user_id, event_id] AS ids, event_type AS kind, CAST(value AS DECIMAL(18, 2)) AS amount FROM events""")
def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, times, an array and a struct as typed records, and back."""
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "value", "array(user_id, event_id) AS ids",
        "named_struct('kind', event_type, 'amount', CAST(value AS DECIMAL(18, 2))) AS inside")
    record = rows.select(row_to_typed_record(rows).alias("record"))
    return record.select(*typed_record_to_row("record", rows.schema)).select(
        "event_id", "ts", "value", "ids", "inside.kind", "inside.amount")


NEWEST_SQL = """
    SELECT {columns} FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1 {condition}"""


@query("latest_changes", NEWEST_SQL.format(columns="event_id, ts, user_id, event_type, value, props", condition=""))
def newest_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_changes(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


MIDDLE = "timestamp_ntz'2024-01-15 00:00:00'"
USER_KEY, USER_ORDER, USER_GONE = ["user_id"], ["ts", "event_id"], "event_type = 'error'"
STATE_SQL = NEWEST_SQL.format(
    columns="user_id, event_id, event_type, value", condition="AND event_type <> 'error'"
)


def state_and_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """State of every user in the middle of the month, and the log from then on."""
    events = table(spark, sf_dir, "events")
    before = latest_changes(events.filter(f"ts <= {MIDDLE}"), USER_KEY, USER_ORDER)
    snapshot = before.filter(f"NOT ({USER_GONE})").select("user_id", "event_id", "event_type", "value")
    return snapshot, events.filter(f"ts > {MIDDLE}")


@query("apply_changes", STATE_SQL)
def applied_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot, later = state_and_log(spark, sf_dir)
    return apply_changes(snapshot, later, USER_KEY, USER_ORDER, USER_GONE)
