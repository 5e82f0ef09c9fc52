import pytest
from conftest import plan, rows

from silofeed.operators import (
    QuotaExceeded,
    TenantQuota,
    check_quota,
    count_by_tenant,
    planned_records,
    quota_verdicts,
    validate_quotas,
)

QUOTA = TenantQuota(100, 4)
JOBS = "tenant string, planned long, parallelism int"
QUOTAS = "tenant string, max_records long, max_parallelism int"


def test_reaching_a_limit_is_allowed():
    check_quota("acme", 100, 4, QUOTA)


@pytest.mark.parametrize(
    "planned, parallelism, message",
    [
        (101, 4, "tenant 'acme' planned 101 records exceeds quota 100"),
        (1, 5, "tenant 'acme' parallelism 5 exceeds quota 4"),
        (101, 5, "tenant 'acme' planned 101 records exceeds quota 100"),
    ],
)
def test_over_quota(spark, planned, parallelism, message):
    with pytest.raises(QuotaExceeded) as error:
        check_quota("acme", planned, parallelism, QUOTA)
    assert str(error.value) == message
    jobs = spark.createDataFrame([("acme", planned, parallelism)], JOBS)
    quotas = spark.createDataFrame([("acme", 100, 4)], QUOTAS)
    verdict = quota_verdicts(jobs, quotas).first()
    assert (verdict["admitted"], verdict["message"]) == (False, message)


def test_tenants_without_a_quota_get_the_default(spark):
    jobs = spark.createDataFrame([("a", 1_000_000, 4), ("b", 1_000_001, 4), ("c", 1, 5), ("d", 9, 1)], JOBS)
    quotas = spark.createDataFrame([("d", 8, 1)], QUOTAS)
    admitted = {r["tenant"]: (r["admitted"], r["max_records"]) for r in quota_verdicts(jobs, quotas).collect()}
    assert admitted == {"a": (True, 1_000_000), "b": (False, 1_000_000), "c": (False, 1_000_000), "d": (False, 8)}
    assert (TenantQuota().max_records, TenantQuota().max_parallelism) == (1_000_000, 4)
    assert quota_verdicts(jobs).filter("admitted").count() == 2


@pytest.mark.parametrize("records, parallelism", [(0, 4), (-1, 4), (1, 0), (1, -1)])
def test_limits_must_be_positive(spark, records, parallelism):
    with pytest.raises(ValueError, match="must be > 0"):
        TenantQuota(records, parallelism)
    quotas = spark.createDataFrame([("a", records, parallelism)], QUOTAS)
    assert "must be > 0" in validate_quotas(quotas).first()["error"]


def test_missing_limits_are_not_valid(spark):
    quotas = spark.createDataFrame([("a", None, 1), ("b", 1, None), ("c", 1, 1)], QUOTAS)
    assert [r["error"] for r in validate_quotas(quotas).collect()] == [
        "maxRecordsPerRun must be > 0",
        "maxParallelism must be > 0",
        None,
    ]


def test_counts_do_not_depend_on_partitioning(spark):
    # Two thirds of the rows belong to one tenant.
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 > 0 THEN 'hot' ELSE string(id % 7) END AS t")
    expected = rows(count_by_tenant(df.coalesce(1), "t"))
    assert ("hot", 2000) in expected
    assert rows(count_by_tenant(df.repartition(13), "t")) == expected
    assert rows(count_by_tenant(df.repartition(5, "t"), "t")) == expected


def test_rows_are_counted_before_the_shuffle(spark, sf_dir):
    text = plan(count_by_tenant(spark.read.parquet(f"{sf_dir}/events.parquet"), "event_type"))
    assert text.index("partial_count") > text.index("Exchange")
    assert "ReadSchema: struct<event_type:string>" in text


def test_planned_records_reads_no_column(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    assert planned_records(orders) == len(orders.collect())
    assert "ReadSchema: struct<>" in plan(orders.groupBy().count())


def test_jobs_that_lack_a_number_or_a_tenant_are_refused(spark):
    jobs = spark.createDataFrame(
        [(None, 5_000_000, 1), (None, 1, 1), ("acme", None, 1), ("acme", 1, None), ("acme", 1, 1)],
        "tenant string, planned long, parallelism int",
    )
    assert [(r["admitted"], r["message"]) for r in quota_verdicts(jobs).collect()] == [
        (False, "tenant 'null' planned 5000000 records exceeds quota 1000000"), (False, "tenant must not be null"),
        (False, "tenant 'acme' has no planned records"), (False, "tenant 'acme' has no parallelism"), (True, None)]
