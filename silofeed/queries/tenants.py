"""Tenant names, routing and quotas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import is_valid_tenant, spark_database, tenant_catalog
from ..operators import TenantQuota, planned_records, quota_verdicts, route_line, route_records, validate_quotas
from ..plans import IngestRequest, ingest_lines, validate_jobs
from .registry import derived, derived_sql, query, table

LEGAL = "'[a-z0-9][a-z0-9-]{0,62}'"


@query("tenant_catalog", "SELECT c_custkey, 'df_' || lower(c_mktsegment) AS tenant_catalog FROM customer")
def tenant_catalog_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.select("c_custkey", tenant_catalog(F.lower("c_mktsegment")).alias("tenant_catalog"))


@query("tenant_lenient", "SELECT c_custkey, 'df_' || nullif(lower(c_mktsegment), 'building') AS tenant_catalog FROM customer")
def tenant_catalog_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    tenant = F.nullif(F.lower("c_mktsegment"), F.lit("building"))
    return customer.select("c_custkey", tenant_catalog(tenant, strict=False).alias("tenant_catalog"))


CANDIDATES = {
    "p_partkey": "p_partkey",
    "upper_case": "p_type",
    "lower_case": "lower(p_type)",
    "hash_mark": "lower(p_brand)",
    "hyphen": "replace(lower(p_brand), '#', '-')",
    "leading_hyphen": "'-' || lower(p_type)",
    "underscore": "replace(p_name, ' ', '_')",
    "blank": "p_name",
    "line_break": "lower(p_type) || chr(10)",
    "length": "repeat('a', p_size + 30)",
    "missing": "nullif(lower(p_type), 'economy')",
}
CANDIDATE_NAMES = [name for name in CANDIDATES if name != "p_partkey"]


@query("tenant_invalid", 
    "SELECT p_partkey, "
    + ", ".join(f"coalesce(regexp_full_match({n}, {LEGAL}), false) AS {n}" for n in CANDIDATE_NAMES)
    + f" FROM ({derived_sql(CANDIDATES, 'part')}) c"
)
def tenant_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = derived(table(spark, sf_dir, "part"), CANDIDATES)
    return candidates.select("p_partkey", *[is_valid_tenant(n).alias(n) for n in CANDIDATE_NAMES])


@query("spark_database", """
    SELECT p_partkey, 'df_' || replace(lower(p_brand), '#', '-') AS tenant_catalog,
           'df_' || replace(lower(p_brand), '#', '_') AS tenant_database
    FROM part""")
def tenant_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = tenant_catalog(F.replace(F.lower("p_brand"), F.lit("#"), F.lit("-")))
    return table(spark, sf_dir, "part").select(
        "p_partkey", catalog.alias("tenant_catalog"), spark_database(catalog).alias("tenant_database")
    )


@query("route_line", """
    SELECT 'df_' || lower(o_orderstatus) || '.orders <= ' || o_orderkey || ',' ||
           CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS line
    FROM orders""")
def routed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("decimal(18,2)"))
    catalog = tenant_catalog(F.lower("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(route_line(row, catalog, F.lit("orders")).alias("line"))


@query("ingest_lines", """
    SELECT 'df_acme.orders <= ' || o_orderkey || ',acme,' ||
           CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS line
    FROM orders""")
def ingest_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admission, then routing, of the text rows of one tenant."""
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    row = F.concat_ws(",", F.col("o_orderkey").cast("string"), F.lit("acme"), amount.cast("string"))
    orders, parallelism = table(spark, sf_dir, "orders"), spark.sparkContext.defaultParallelism
    quota = TenantQuota(max(1, planned_records(orders)), parallelism)
    return ingest_lines(orders, row, IngestRequest("acme", "orders", quota), parallelism)


def orders_with_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the tenant of their customer. AQE splits the orders of a customer who has very many."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    return joined.select(*orders.columns, F.lower("c_mktsegment").alias("tenant"))


@query("route_records", """
    SELECT o.*, 'df_' || lower(c_mktsegment) AS tenant_catalog, 'orders' AS target_table
    FROM orders o JOIN customer ON o_custkey = c_custkey""")
def routed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed, _ = route_records(orders_with_tenant(spark, sf_dir), "tenant", "orders")
    return routed.drop("tenant")


PART_TENANTS = {
    "p_partkey": "p_partkey",
    "tenant": "CASE p_size % 3 WHEN 0 THEN lower(p_brand) WHEN 1 THEN lower(p_type) END",
}


@query("route_rejects", f"""
    SELECT p_partkey, tenant, 'illegal tenantId: ' || coalesce(tenant, 'null') AS reject_reason
    FROM ({derived_sql(PART_TENANTS, "part")}) p
    WHERE NOT coalesce(regexp_full_match(tenant, {LEGAL}), false)""")
def routing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = route_records(derived(table(spark, sf_dir, "part"), PART_TENANTS), "tenant", "part")
    return rejected


QUOTAS_SQL = """
    SELECT lower(c_mktsegment) AS tenant, count(*) * 10 AS max_records, 64 AS max_parallelism
    FROM customer WHERE c_mktsegment <> 'HOUSEHOLD' GROUP BY 1"""


def tenant_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quota per tenant, which about half of them exceed; one tenant has none of its own."""
    customer = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'HOUSEHOLD'")
    return customer.groupBy(F.lower("c_mktsegment").alias("tenant")).agg(
        (F.count(F.lit(1)) * 10).alias("max_records"), F.lit(64).alias("max_parallelism")
    )


def orders_per_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are counted per customer first, so that the join carries one row per customer."""
    customer = table(spark, sf_dir, "customer")
    per_customer = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    joined = per_customer.join(customer, per_customer["o_custkey"] == customer["c_custkey"])
    return joined.groupBy(F.lower("c_mktsegment").alias("tenant")).agg(F.sum("n").alias("planned"))


VERDICTS_SQL = """
    SELECT v.*, message IS NULL AS admitted FROM (
        SELECT l.*, CASE
            WHEN planned > max_records THEN
                concat('tenant ''', tenant, ''' planned ', planned, ' records exceeds quota ', max_records)
            WHEN parallelism > max_parallelism THEN
                concat('tenant ''', tenant, ''' parallelism ', parallelism, ' exceeds quota ', max_parallelism)
            END AS message
        FROM ({limited}) l) v"""


@query("quota_verdicts", 
    VERDICTS_SQL.format(
        limited=f"""
        SELECT p.tenant, planned, 4 AS parallelism, coalesce(max_records, 1000000) AS max_records,
               coalesce(max_parallelism, 4) AS max_parallelism
        FROM (SELECT lower(c_mktsegment) AS tenant, count(*) AS planned
              FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) p
        LEFT JOIN ({QUOTAS_SQL}) q ON p.tenant = q.tenant"""
    )
)
def record_quota_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = orders_per_tenant(spark, sf_dir).withColumn("parallelism", F.lit(4))
    return quota_verdicts(jobs, tenant_quotas(spark, sf_dir))


JOBS = {
    "o_orderkey": "o_orderkey",
    "tenant": "lower(o_orderstatus)",
    "planned": "CAST(floor(o_totalprice) AS BIGINT) * 10",
    "parallelism": "CAST(o_orderkey % 7 + 1 AS INT)",
}


@query("quota_parallelism", 
    VERDICTS_SQL.format(
        limited=f"""SELECT j.*, CAST(1000000 AS BIGINT) AS max_records, 4 AS max_parallelism
        FROM ({derived_sql(JOBS, "orders")}) j"""
    )
)
def default_quota_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job table with the default quota: rows are checked before parallelism."""
    return quota_verdicts(derived(table(spark, sf_dir, "orders"), JOBS))


QUOTA_ROWS = {
    "tenant": "lower(c_name)",
    "max_records": "CAST(floor(c_acctbal) AS BIGINT)",
    "max_parallelism": "c_nationkey - 3",
}


@query("validate_quotas", f"""
    SELECT q.*, CASE WHEN max_records <= 0 THEN 'maxRecordsPerRun must be > 0'
                     WHEN max_parallelism <= 0 THEN 'maxParallelism must be > 0' END AS error
    FROM ({derived_sql(QUOTA_ROWS, "customer")}) q""")
def quota_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_quotas(derived(table(spark, sf_dir, "customer"), QUOTA_ROWS))


JOB_ROWS = {
    "c_custkey": "c_custkey",
    "tenant": "CASE c_nationkey % 3 WHEN 0 THEN lower(c_mktsegment) WHEN 1 THEN c_mktsegment "
    "ELSE nullif(lower(c_mktsegment), 'building') END",
    "source_table": "CASE c_nationkey % 4 WHEN 0 THEN '' WHEN 1 THEN '  ' ELSE c_name END",
    "max_records": "nullif(CAST(floor(abs(c_acctbal)) AS BIGINT) % 5, 0)",
    "max_parallelism": "4",
}


@query("validate_jobs", f"""
    SELECT j.*, CASE
        WHEN NOT coalesce(regexp_full_match(tenant, {LEGAL}), false)
            THEN 'illegal tenantId: ' || coalesce(tenant, 'null')
        WHEN trim(source_table) = '' THEN 'sourceTable must not be blank'
        WHEN max_records IS NULL OR max_parallelism IS NULL THEN 'quota must not be null' END AS error
    FROM ({derived_sql(JOB_ROWS, "customer")}) j""")
def job_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_jobs(derived(table(spark, sf_dir, "customer"), JOB_ROWS))
