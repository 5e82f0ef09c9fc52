import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from silofeed.operators import QuotaExceeded, apply_changes, latest_changes, read_tenant
from silofeed.streaming import ingest_stream, land_changes, read_landed, read_stream, write_stream

QUOTAS = "tenant string, max_records long, max_parallelism int"
SCHEMA = "id long, t string"


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / name) for name in ("source", "out", "checkpoint")]


def test_rows_are_routed_as_a_stream(spark, folders):
    source, out, checkpoint = folders
    df = spark.range(100).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'beta' ELSE 'acme' END AS t")
    df.repartition(4).write.parquet(source)
    verdicts = ingest_stream(spark, source, df.schema, "t", out, checkpoint, parallelism=2)
    assert rows(verdicts, "tenant", "planned") == [("acme", 66), ("beta", 34)]
    expected = rows(df.withColumn("tenant_catalog", F.concat(F.lit("df_"), "t")))
    assert rows(landed(spark, out)) == expected
    # Going on from the same checkpoint adds nothing.
    assert ingest_stream(spark, source, df.schema, "t", out, checkpoint, parallelism=2).isEmpty()
    assert rows(landed(spark, out)) == expected


def landed(spark, path):
    return spark.read.parquet(path).drop("run_id")


def test_two_sources_into_one_table(spark, folders, tmp_path):
    source, out, checkpoint = folders
    for n, name in enumerate(("one", "two")):
        df = spark.createDataFrame([(n, "acme"), (n + 10, "beta")], SCHEMA)
        df.write.parquet(f"{source}/{name}")
        ingest_stream(spark, f"{source}/{name}", df.schema, "t", out, f"{checkpoint}/{name}", parallelism=1)
    assert rows(landed(spark, out), "id") == [(0,), (1,), (10,), (11,)]
    log = str(tmp_path / "log")
    for name in ("one", "two"):
        found = land_changes(spark, f"{source}/{name}", df.schema, log, f"{checkpoint}/log-{name}")
    assert rows(found, "id") == [(0,), (1,), (10,), (11,)]


def test_a_lost_checkpoint_loses_no_rows(spark, folders):
    source, out, checkpoint = folders
    df = spark.createDataFrame([(1, "acme")], SCHEMA)
    df.write.parquet(source)
    ingest_stream(spark, source, df.schema, "t", out, checkpoint, parallelism=1)
    spark.createDataFrame([(2, "acme")], SCHEMA).write.mode("append").parquet(source)
    ingest_stream(spark, source, df.schema, "t", out, checkpoint + "-new", parallelism=1)
    assert rows(landed(spark, out).distinct(), "id") == [(1,), (2,)]


def test_quotas_are_for_the_files_of_a_run(spark, folders):
    source, out, checkpoint = folders
    quotas = spark.createDataFrame([("acme", 1, 4)], QUOTAS)
    for n in range(3):
        df = spark.createDataFrame([(n, "acme")], SCHEMA)
        df.write.mode("append").parquet(source)
        verdicts = ingest_stream(spark, source, df.schema, "t", out, checkpoint, quotas, parallelism=1)
        assert rows(verdicts, "tenant", "planned", "admitted") == [("acme", 1, True)]
    spark.createDataFrame([(8, "acme"), (9, "acme")], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    with pytest.raises(QuotaExceeded, match="planned 2 records exceeds quota 1"):
        ingest_stream(spark, source, df.schema, "t", out, checkpoint, quotas, parallelism=1)
    assert rows(landed(spark, out), "id") == [(0,), (1,), (2,)]
    # The refused files are seen again.
    ingest_stream(spark, source, df.schema, "t", out, checkpoint, parallelism=1)
    assert rows(landed(spark, out), "id") == [(0,), (1,), (2,), (8,), (9,)]


def test_a_refused_tenant_stops_the_stream_before_it_starts(spark, folders):
    source, out, checkpoint = folders
    df = spark.createDataFrame([(1, "acme"), (2, "acme"), (3, "beta")], SCHEMA)
    df.write.parquet(source)
    quotas = spark.createDataFrame([("acme", 1, 4)], QUOTAS)
    with pytest.raises(QuotaExceeded, match="tenant 'acme' planned 2 records exceeds quota 1"):
        ingest_stream(spark, source, df.schema, "t", out, checkpoint, quotas, parallelism=1)
    assert not os.path.exists(out)
    with pytest.raises(QuotaExceeded, match="parallelism 5 exceeds quota 4"):
        ingest_stream(spark, source, df.schema, "t", out, checkpoint, parallelism=5)


def test_an_illegal_tenant_stops_the_stream(spark, folders):
    source, out, checkpoint = folders
    df = spark.createDataFrame([(1, "acme"), (2, "a_b")], SCHEMA)
    df.write.parquet(source)
    with pytest.raises(QuotaExceeded, match="illegal tenantId: a_b"):
        ingest_stream(spark, source, df.schema, "t", out, checkpoint, parallelism=1)


def test_changes_are_collected_over_several_runs(spark, sf_dir, folders):
    source, out, checkpoint = folders
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    order, deleted = ["ts", "event_id"], F.col("event_type") == "error"
    empty = events.select("user_id", "event_id", "event_type").limit(0)
    # The later half arrives first.
    for condition in ("event_id >= 500", "event_id < 500"):
        events.filter(condition).repartition(3).write.mode("append").parquet(source)
        log = land_changes(spark, source, events.schema, out, checkpoint)
    assert log.count() == events.count()
    expected = latest_changes(events, ["user_id"], order).filter(~deleted)
    state = apply_changes(empty, log, ["user_id"], order, deleted)
    assert rows(state) == rows(expected, *state.columns)


def test_a_tenant_of_a_stream(spark, folders):
    source, out, checkpoint = folders
    df = spark.createDataFrame([(1, "acme"), (2, "acme"), (3, "beta")], SCHEMA)
    df.write.parquet(source)
    ingest_stream(spark, source, df.schema, "t", out, checkpoint, parallelism=1)
    assert rows(read_tenant(spark, out, "acme")) == [(1, "acme"), (2, "acme")]


def test_nothing_has_arrived_yet(spark, folders):
    source, out, checkpoint = folders
    schema = spark.createDataFrame([], SCHEMA).schema
    os.makedirs(source)
    assert land_changes(spark, source, schema, out, checkpoint).isEmpty()
    assert ingest_stream(spark, source, schema, "t", out + "2", checkpoint + "2", parallelism=1).isEmpty()


def test_a_stream_that_failed_goes_on_and_writes_each_row_once(spark, folders):
    source, out, checkpoint = folders
    df = spark.range(40).selectExpr("id", "'acme' AS tenant_catalog")
    df.filter("id < 20").coalesce(1).write.parquet(source)
    broken = f"{source}/part-broken.parquet"
    with open(broken, "w") as file:
        file.write("this is not parquet")

    def run():
        rows_in = read_stream(spark, source, df.schema, max_bytes_per_trigger=1)
        return write_stream(rows_in, out, checkpoint, "tenant_catalog")

    with pytest.raises(Exception, match="STREAM_FAILED|FAILED_READ_FILE"):
        run()
    assert rows(read_landed(spark, out, df.schema)) == rows(df.filter("id < 20"))
    df.filter("id >= 20").toPandas().to_parquet(broken)
    run()
    run()
    assert rows(read_landed(spark, out, df.schema)) == rows(df)
