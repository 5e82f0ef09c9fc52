"""Source inventories, metadata scans, table scans and appends."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    dialect_for_url,
    qualified_name,
    quote_identifier,
    redact_sources,
    source_supported,
    validate_sources,
)
from ..functions.tenancy import catalog_for
from ..operators import create_tenant_database, tenant_table
from ..plans import copy_table, ingest_tenants
from ..sources import (
    JDBC,
    PARQUET,
    TABLE,
    SourceConfig,
    TableRef,
    append_table,
    describe_tables,
    list_schemas,
    list_tables,
    primary_key_columns,
    read_table,
)
from ..sources.jdbc import run_statements
from ..workspace import new_folder
from .registry import as_double, derived, derived_sql, query, table

# An inventory of sources: one per customer, of all dialects and with all kinds of flaws.
INVENTORY = {
    "c_custkey": "c_custkey",
    "type": "CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'parquet' WHEN 2 THEN '  ' ELSE 'jdbc' END",
    "url": "CASE c_custkey % 8 WHEN 0 THEN 'jdbc:postgresql://reader:pw' || c_custkey || '@db' || c_nationkey "
    "|| ':5432/df_' || lower(c_mktsegment) "
    "WHEN 1 THEN 'jdbc:mysql://db:3306/df_acme?user=reader&password=pw' || c_custkey || '&useSSL=true' "
    "WHEN 2 THEN 'jdbc:dm://db:5236/' || lower(c_mktsegment) "
    "WHEN 3 THEN 'jdbc:kingbase8://db:54321/' || lower(c_mktsegment) || '?PASSWORD=pw' "
    "WHEN 4 THEN 'jdbc:oceanbase://db:2881/' || lower(c_mktsegment) "
    "WHEN 5 THEN 'jdbc:h2:mem:df_' || lower(c_mktsegment) || ';PASSWORD=pw;MODE=x' "
    "WHEN 6 THEN '/lake/df_' || lower(c_mktsegment) ELSE '' END",
    "username": "c_name",
    "secret_ref": "'SECRET_' || c_custkey",
}
INVENTORY_SQL = derived_sql(INVENTORY, "customer")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = derived(table(spark, sf_dir, "customer"), INVENTORY)
    options = F.create_map(F.lit("sslmode"), F.lit("require"), F.lit("fetchsize"), F.col("secret_ref"))
    return sources.withColumn("options", options)


@query("validate_sources", f"""
    SELECT c_custkey, type, url, CASE WHEN trim(type) = '' THEN 'type must not be blank'
                                      WHEN trim(url) = '' THEN 'url must not be blank' END AS error
    FROM ({INVENTORY_SQL}) i""")
def source_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_sources(inventory(spark, sf_dir)).select("c_custkey", "type", "url", "error")


@query("source_supported", f"""
    SELECT c_custkey, type = 'jdbc' AND starts_with(url, 'jdbc:') AS jdbc, type = 'parquet' AS parquet
    FROM ({INVENTORY_SQL}) i""")
def supported_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory(spark, sf_dir).select(
        "c_custkey",
        source_supported("type", "url", JDBC).alias("jdbc"),
        source_supported("type", "url", PARQUET).alias("parquet"),
    )


@query("redact_sources", rf"""
    SELECT c_custkey, type, username,
           regexp_replace(regexp_replace(url, '//[^/?#;]*@', '//', 'g'),
                          '(?i)((?:password|pwd)=)[^&;]*', '\1***', 'g') AS url,
           'fetchsize,sslmode' AS option_keys
    FROM ({INVENTORY_SQL}) i""")
def redacted_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    redacted = redact_sources(inventory(spark, sf_dir))
    return redacted.withColumn("option_keys", F.array_join("option_keys", ","))


@query("dialect_for_url", f"""
    SELECT c_custkey, CASE
        WHEN starts_with(url, 'jdbc:postgresql:') THEN 'postgresql'
        WHEN starts_with(url, 'jdbc:mysql:') THEN 'mysql'
        WHEN starts_with(url, 'jdbc:dm:') THEN 'dm'
        WHEN starts_with(url, 'jdbc:kingbase8:') THEN 'kingbase'
        WHEN starts_with(url, 'jdbc:oceanbase:') THEN 'oceanbase'
        ELSE 'ansi' END AS dialect
    FROM ({INVENTORY_SQL}) i""")
def source_dialects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory(spark, sf_dir).select("c_custkey", dialect_for_url("url").alias("dialect"))


IDENTIFIERS = {
    "p_partkey": "p_partkey",
    "name": "CASE p_size % 3 WHEN 0 THEN replace(p_name, ' ', '\"') WHEN 1 THEN replace(p_name, ' ', '`') "
    "ELSE p_name END",
    "dialect": "CASE p_size % 2 WHEN 0 THEN 'mysql' ELSE 'postgresql' END",
}


@query("quote_identifier", f"""
    SELECT p_partkey, '"' || replace(name, '"', '""') || '"' AS ansi, CASE dialect
        WHEN 'mysql' THEN '`' || replace(name, '`', '``') || '`'
        ELSE '"' || replace(name, '"', '""') || '"' END AS quoted
    FROM ({derived_sql(IDENTIFIERS, "part")}) p""")
def quoted_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(table(spark, sf_dir, "part"), IDENTIFIERS).select(
        "p_partkey",
        quote_identifier("name").alias("ansi"),
        quote_identifier("name", F.col("dialect")).alias("quoted"),
    )


TABLE_REFS = {
    "o_orderkey": "o_orderkey",
    "catalog": "CASE o_orderkey % 3 WHEN 0 THEN 'df_acme' WHEN 1 THEN ' ' END",
    "schema_name": "CASE o_orderkey % 4 WHEN 0 THEN 'public' WHEN 1 THEN '' WHEN 2 THEN lower(o_orderstatus) END",
    "name": "'orders_' || o_custkey",
}


@query("qualified_name", f"""
    SELECT o_orderkey, concat(CASE WHEN trim(catalog) <> '' THEN catalog || '.' END,
                              CASE WHEN trim(schema_name) <> '' THEN schema_name || '.' END, name) AS qualified
    FROM ({derived_sql(TABLE_REFS, "orders")}) o""")
def qualified_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = derived(table(spark, sf_dir, "orders"), TABLE_REFS)
    return refs.select("o_orderkey", qualified_name("catalog", "schema_name", "name").alias("qualified"))


# Keys of the given tables, which parquet files do not tell.
KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "embeddings": ["vec_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}
KEY_PAIRS = [(name, column) for name, columns in KEYS.items() for column in columns]
KEYS_SQL = "(VALUES " + ", ".join(f"('{t}', '{c}')" for t, c in KEY_PAIRS) + ') AS k("table", "column")'

COLUMNS_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS "table", CAST(row_number() OVER () AS INT) AS ordinal,
        column_name AS "column", column_type AS t FROM (DESCRIBE {name})"""
    for name in KEYS
)
DESCRIBED_SQL = f"""
    SELECT c."table", ordinal, c."column",
           CASE t WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                  WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
                  WHEN 'FLOAT[]' THEN 'array<float>' END AS type_name,
           CASE t WHEN 'BIGINT' THEN -5 WHEN 'INTEGER' THEN 4 WHEN 'DOUBLE' THEN 8 WHEN 'VARCHAR' THEN 12
                  WHEN 'TIMESTAMP' THEN 93 WHEN 'FLOAT[]' THEN 2003 END AS jdbc_type,
           true AS nullable, k."column" IS NOT NULL AS primary_key
    FROM ({COLUMNS_SQL}) c LEFT JOIN {KEYS_SQL} ON c."table" = k."table" AND c."column" = k."column" """


def given_tables(sf_dir: str) -> SourceConfig:
    return SourceConfig(PARQUET, sf_dir, options={"suffix": ".parquet"})


def described(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = spark.createDataFrame(KEY_PAIRS, "table string, column string")
    return describe_tables(spark, given_tables(sf_dir), keys=keys, merge_schema=True)


@query("describe_tables", DESCRIBED_SQL)
def described_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of all tables; the footers of every file are read, on the executors."""
    return described(spark, sf_dir).drop("catalog", "schema")


@query("primary_key_columns", f"""
    SELECT "table", string_agg("column", ',' ORDER BY ordinal) AS key_columns
    FROM ({DESCRIBED_SQL}) d WHERE primary_key GROUP BY 1""")
def key_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = primary_key_columns(described(spark, sf_dir))
    return keys.select("table", F.array_join("key_columns", ",").alias("key_columns"))


@query("list_tables", " UNION ALL ".join(
    f"""SELECT '{name}' AS "table", count(*) AS n_rows FROM {name}""" for name in KEYS))
def listed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table that is found, with the number of its rows."""
    source, counts = given_tables(sf_dir), None
    found = list_tables(spark, source)
    for row in found.collect():  # one small row for each table
        rows = read_table(spark, source, TableRef(row["table"])).agg(F.count(F.lit(1)).alias("n_rows"))
        counted = rows.select(F.lit(row["table"]).alias("table"), "n_rows")
        counts = counted if counts is None else counts.unionByName(counted)
    return found.select("table").join(counts, "table")


@query("list_schemas", """
    SELECT DISTINCT 'df_cust_' || lower(c_mktsegment) AS "schema", 'customer' AS "table" FROM customer""")
def tenant_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers fanned out in one job and registered per tenant, then found by the metadata scan."""
    path = new_folder(spark, "customer")
    tenant = F.concat(F.lit("cust-"), F.lower("c_mktsegment"))
    quotas = table(spark, sf_dir, "customer").groupBy(tenant.alias("tenant")).agg(
        F.count(F.lit(1)).alias("max_records"), F.lit(4).alias("max_parallelism"))
    verdicts = ingest_tenants(
        table(spark, sf_dir, "customer"), tenant, "customer", path, "first", quotas, parallelism=4
    )
    for row in verdicts.select("tenant").toLocalIterator():
        create_tenant_database(spark, row["tenant"], new_folder(spark, row["tenant"]))
        place = f"{path}/tenant_catalog={catalog_for(row['tenant'])}"
        name = tenant_table(row["tenant"], "customer")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{place}'")
    lake = SourceConfig(TABLE, "spark_catalog")
    schemas = list_schemas(spark, lake).filter("schema LIKE 'df\\_cust\\_%'").select("schema")
    return list_tables(spark, lake).join(schemas, "schema").select("schema", "table")


@query("parquet_scan", "SELECT * FROM lineitem")
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, given_tables(sf_dir), TableRef("lineitem"))


# The embedded database lives in the driver's process, which in a local session also runs the tasks.
ORDERS = TableRef("orders", "df_acme")
ORDERS_DDL = """CREATE TABLE "df_acme"."orders" (
    "o_orderkey" BIGINT NOT NULL PRIMARY KEY, "o_custkey" BIGINT NOT NULL, "o_orderstatus" VARCHAR(16),
    "o_totalprice" DOUBLE PRECISION, "o_orderdate" TIMESTAMP, "o_orderpriority" VARCHAR(32))"""
CONTRACT_DDL = """CREATE TABLE "df_acme"."orders" (
    "id" BIGINT NOT NULL PRIMARY KEY, "tenant" VARCHAR(64), "amount" NUMERIC(12, 2))"""


def embedded_database(spark: SparkSession, ddl: str) -> SourceConfig:
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):  # the executors of local-cluster are processes of their own
        raise RuntimeError("the embedded database of this query is only seen by a local session")
    source = SourceConfig(JDBC, f"jdbc:derby:memory:{uuid.uuid4().hex};create=true")
    run_statements(spark, source, 'CREATE SCHEMA "df_acme"', ddl)
    return source


@query("jdbc_scan", "SELECT * FROM orders")
def jdbc_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders put into a database, and read back in parts along the primary key."""
    source = embedded_database(spark, ORDERS_DDL)
    append_table(spark, table(spark, sf_dir, "orders"), source, ORDERS)
    return read_table(spark, source, ORDERS, partitions=8)


@query("copy_table", "SELECT * FROM orders")
def copied_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders copied from files into a database, and from there into files."""
    database, lake = embedded_database(spark, ORDERS_DDL), SourceConfig(PARQUET, new_folder(spark, "lake"))
    table(spark, sf_dir, "orders").filter("false").write.parquet(f"{lake.url}/df_acme/orders")
    copy_table(spark, given_tables(sf_dir), TableRef("orders"), database, ORDERS)
    copy_table(spark, database, ORDERS, lake, ORDERS, partitions=8)
    return read_table(spark, lake, ORDERS)


@query("jdbc_append", """
    SELECT o_orderkey AS id, lower(o_orderstatus) AS tenant, CAST(NULL AS DOUBLE) AS amount
    FROM orders""")
def jdbc_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append is aligned by name: extra columns are dropped, absent ones are null."""
    source = embedded_database(spark, CONTRACT_DDL)
    rows = table(spark, sf_dir, "orders").selectExpr(
        "lower(o_orderstatus) AS tenant", "o_orderkey AS id", "o_custkey", "o_totalprice AS Amount"
    )
    append_table(spark, rows, source, ORDERS)
    return read_table(spark, source, ORDERS, partitions=8).withColumn("amount", as_double("amount"))


@query("jdbc_append_once", """
    SELECT o_orderkey AS id, lower(o_orderstatus) AS tenant,
           CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE) AS amount
    FROM orders""")
def jdbc_append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = embedded_database(spark, CONTRACT_DDL)
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_totalprice AS amount", "lower(o_orderstatus) AS tenant", "o_orderkey AS id"
    )
    append_table(spark, rows, source, ORDERS, once=True)
    return read_table(spark, source, ORDERS, partitions=8).withColumn("amount", as_double("amount"))


@query("jdbc_describe", """
    SELECT * FROM (VALUES (1, 'id', 'BIGINT', -5, false, true), (2, 'tenant', 'VARCHAR(64)', 12, true, false),
                          (3, 'amount', 'NUMERIC(12,2)', 2, true, false))
        AS d(ordinal, "column", type_name, jdbc_type, nullable, primary_key)
    CROSS JOIN (SELECT count(*) AS n FROM orders) o""")
def jdbc_described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of a database table next to the number of rows that it was filled with."""
    source = embedded_database(spark, CONTRACT_DDL)
    orders = table(spark, sf_dir, "orders")
    rows = orders.selectExpr("'acme' AS tenant", "o_totalprice AS amount", "o_orderkey AS id")
    append_table(spark, rows, source, ORDERS)
    n = read_table(spark, source, ORDERS, partitions=8).count()
    found = describe_tables(spark, source, "df_acme", ["orders"]).drop("catalog", "schema", "table")
    return found.withColumn("n", F.lit(n).cast("long"))
