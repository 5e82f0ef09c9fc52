"""Partitioned scans, appends and metadata of databases."""

import datetime
from decimal import Decimal

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from silofeed.plans import copy_table
from silofeed.sources import (
    PARQUET,
    SourceConfig,
    TableRef,
    append_table,
    describe_tables,
    list_schemas,
    list_tables,
    primary_key_columns,
    read_table,
)
from silofeed.sources.jdbc import (
    ROW_ID,
    append_jdbc,
    append_jdbc_once,
    create_stage,
    publish_stage,
    quoted_table,
    read_jdbc,
    run_statements,
    split_by_key,
)

T = TableRef("t", "s")


def filled(spark, database, ddl, df):
    source = database('CREATE SCHEMA "s"', f'CREATE TABLE "s"."t" ({ddl})')
    append_jdbc(spark, df, source, T)
    return source


def partition_sizes(df):
    sizes = df.groupBy(F.spark_partition_id().alias("p")).count()
    return sorted(r["count"] for r in sizes.collect())


def test_clustered_keys_give_equal_partitions(spark, database):
    # Most keys lie close together, a few are far away.
    df = spark.range(1000).selectExpr("CASE WHEN id < 950 THEN id ELSE id * 1000000000000 END AS id")
    source = filled(spark, database, '"id" BIGINT NOT NULL PRIMARY KEY', df)
    scan = read_table(spark, source, T, partitions=8)
    assert rows(scan) == rows(df)
    assert partition_sizes(scan) == [125] * 8


def test_a_hot_first_key_column_is_split_by_the_second(spark, database):
    # Two thirds of the rows share one value of the first key column.
    df = spark.range(900).selectExpr("CASE WHEN id % 3 > 0 THEN 'hot' ELSE concat('c', id) END AS a", "id AS b")
    ddl = '"a" VARCHAR(20) NOT NULL, "b" BIGINT NOT NULL, PRIMARY KEY ("a", "b")'
    source = filled(spark, database, ddl, df)
    scan = read_table(spark, source, T, partitions=9)
    assert rows(scan) == rows(df)
    assert partition_sizes(scan) == [100] * 9


@pytest.mark.parametrize(
    "ddl, values",
    [
        ("VARCHAR(20)", ["it's", "b\\c", "", "z", "é", "a b", '"'] + [f"k{i}" for i in range(50)]),
        ("DATE", [datetime.date(2024, 1, 1) + datetime.timedelta(i) for i in range(60)]),
        ("TIMESTAMP", [datetime.datetime(2024, 1, 1, 0, 0, 0, i) for i in range(60)]),
        ("NUMERIC(12,2)", [Decimal(i) / 4 for i in range(60)]),
        ("DOUBLE", [i / 10 - 3 for i in range(58)] + [1e300, -1e-300]),
        ("REAL", [i / 8 for i in range(60)]),
        ("VARCHAR(8) FOR BIT DATA", [bytes([i, 255 - i]) for i in range(60)]),
    ],
)
def test_keys_of_other_types(spark, database, ddl, values):
    kind = {"VARCHAR(20)": "string", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "NUMERIC(12,2)": "decimal(12,2)",
            "DOUBLE": "double", "REAL": "float", "VARCHAR(8) FOR BIT DATA": "binary"}
    df = spark.createDataFrame([(v,) for v in values], f"id {kind[ddl]}")
    source = filled(spark, database, f'"id" {ddl} NOT NULL PRIMARY KEY', df)
    scan = read_table(spark, source, T, partitions=5)
    assert rows(scan) == rows(df)
    assert max(partition_sizes(scan)) <= -(-len(values) // 5)


def test_a_key_with_duplicates_and_nulls_keeps_every_row(spark, database):
    df = spark.range(300).selectExpr("CASE WHEN id % 3 = 0 THEN 5 WHEN id % 7 = 0 THEN NULL ELSE id END AS id")
    source = filled(spark, database, '"id" BIGINT', df)
    scan = read_jdbc(spark, source, T, ["id"], partitions=6)
    assert rows(scan) == rows(df)
    assert scan.rdd.getNumPartitions() > 1


def test_small_empty_and_keyless_tables(spark, database):
    source = database('CREATE SCHEMA "s"', 'CREATE TABLE "s"."t" ("id" BIGINT NOT NULL PRIMARY KEY)')
    assert read_table(spark, source, T, partitions=4).isEmpty()
    append_jdbc(spark, spark.range(3), source, T)
    assert rows(read_table(spark, source, T, partitions=4)) == [(0,), (1,), (2,)]
    assert split_by_key(spark, source, T, ["id"], 100) == []
    keyless = database('CREATE SCHEMA "s"', 'CREATE TABLE "s"."t" ("id" BIGINT)')
    append_jdbc(spark, spark.range(30), keyless, T)
    assert read_table(spark, keyless, T).rdd.getNumPartitions() == 1
    parts = read_table(spark, keyless, T, predicates=['MOD("id", 2) = 0', 'MOD("id", 2) = 1'])
    assert partition_sizes(parts) == [15, 15]


def test_filters_and_columns_reach_the_database(spark, database):
    df = spark.range(100).selectExpr("id", "id * 2 AS other")
    source = filled(spark, database, '"id" BIGINT NOT NULL PRIMARY KEY, "other" BIGINT', df)
    text = plan(read_table(spark, source, T, partitions=4).filter("id > 90").select("id"))
    assert "GreaterThan(id,90)" in text and "ReadSchema: struct<id:bigint>" in text


def test_a_table_of_another_catalog_is_not_read(spark, database):
    source = filled(spark, database, '"id" BIGINT NOT NULL PRIMARY KEY', spark.range(3))
    with pytest.raises(ValueError, match="the connection is to catalog"):
        read_table(spark, source, TableRef("t", "s", "elsewhere"))


def test_schemas_with_similar_names_are_kept_apart(spark, database):
    ddl = '("id" BIGINT NOT NULL PRIMARY KEY, "{}" BIGINT)'
    source = database(
        'CREATE SCHEMA "df_acme"',
        'CREATE SCHEMA "dfxacme"',
        'CREATE TABLE "df_acme"."orders" ' + ddl.format("mine"),
        'CREATE TABLE "dfxacme"."orders" ' + ddl.format("theirs"),
        'CREATE TABLE "dfxacme"."secret" ' + ddl.format("theirs"),
        'CREATE VIEW "df_acme"."v" AS SELECT * FROM "df_acme"."orders"',
    )
    assert rows(list_tables(spark, source, "df_acme")) == [(None, "df_acme", "orders")]
    assert list_tables(spark, source, "df%").isEmpty()
    found = describe_tables(spark, source, "df_acme", ["orders"])
    assert rows(found, "column") == [("id",), ("mine",)]
    assert {"df_acme", "dfxacme"} <= {r["schema"] for r in list_schemas(spark, source).collect()}
    assert list_schemas(spark, source, "no_such_catalog").isEmpty()


def test_key_columns_come_in_declared_order(spark, database):
    source = database(
        'CREATE SCHEMA "s"',
        'CREATE TABLE "s"."t" ("x" INT, "a" INT NOT NULL, "b" INT NOT NULL, "c" VARCHAR(9) NOT NULL UNIQUE, '
        'PRIMARY KEY ("b", "a"))',
    )
    described = describe_tables(spark, source, "s")
    assert rows(primary_key_columns(described)) == [(None, "s", "t", ["a", "b"])]
    assert rows(described.filter("NOT nullable"), "column") == [("a",), ("b",), ("c",)]


def test_a_failed_append_leaves_rows_unless_it_is_staged(spark, database):
    df = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 0)], "id long").coalesce(2)
    for append, left in ((append_jdbc, False), (append_jdbc_once, True)):
        source = filled(spark, database, '"id" BIGINT NOT NULL PRIMARY KEY', spark.range(1))
        with pytest.raises(Exception, match="duplicate key"):
            append(spark, df, source, T)
        count = read_jdbc(spark, source, T).count()
        assert count == 1 if left else 1 < count < 7
        assert rows(list_tables(spark, source, "s"), "table") == [("t",)]


def test_a_staged_append_drops_rows_that_arrive_twice_but_keeps_equal_rows(spark, database):
    source = database('CREATE SCHEMA "s"', 'CREATE TABLE "s"."t" ("v" BIGINT)')
    equal = spark.createDataFrame([(1,), (1,), (2,)], "v long")
    append_table(spark, equal, source, T, once=True)
    assert rows(read_jdbc(spark, source, T)) == [(1,), (1,), (2,)]

    stage = create_stage(spark, source, T, ["v"])
    numbered = spark.createDataFrame([(7, 0), (7, 1), (8, 2)], f"v long, {ROW_ID} long")
    append_jdbc(spark, numbered, source, stage)
    append_jdbc(spark, numbered.limit(2), source, stage)
    with pytest.raises(RuntimeError, match="4 rows to append, 3 found"):
        publish_stage(spark, source, stage, T, ["v"], 4)
    assert read_jdbc(spark, source, T).count() == 3
    publish_stage(spark, source, stage, T, ["v"], 3)
    assert rows(read_jdbc(spark, source, T)) == [(1,), (1,), (2,), (7,), (7,), (8,)]


def test_writers_and_batches(spark, database):
    source = database('CREATE SCHEMA "s"', 'CREATE TABLE "s"."t" ("id" BIGINT NOT NULL PRIMARY KEY)')
    append_table(spark, spark.range(1000), source, T, writers=2, batch_size=7)
    append_table(spark, spark.range(1000, 1500), source, T, writers=3, once=True)
    assert rows(read_table(spark, source, T)) == [(i,) for i in sorted(range(1500), key=lambda i: repr((i,)))]


def test_statements_are_one_transaction(spark, database):
    source = database('CREATE SCHEMA "s"', 'CREATE TABLE "s"."t" ("id" BIGINT NOT NULL PRIMARY KEY)')
    table = quoted_table(source, T)
    with pytest.raises(Exception, match="duplicate key"):
        run_statements(spark, source, f"INSERT INTO {table} VALUES 1", f"INSERT INTO {table} VALUES 1")
    assert read_jdbc(spark, source, T).isEmpty()


def test_copy_between_sources(spark, sf_dir, database, tmp_path):
    given = SourceConfig(PARQUET, sf_dir, options={"suffix": ".parquet"})
    source = database(
        'CREATE SCHEMA "s"',
        'CREATE TABLE "s"."t" ("c_custkey" BIGINT NOT NULL PRIMARY KEY, "c_acctbal" DOUBLE, "c_name" VARCHAR(99))',
    )
    copy_table(spark, given, TableRef("customer"), source, T, once=True)
    lake = SourceConfig(PARQUET, str(tmp_path))
    columns = ["c_custkey", "c_acctbal", "c_name"]
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(*columns)
    customer.limit(0).write.parquet(f"{tmp_path}/copy")
    copy_table(spark, source, T, lake, TableRef("copy"), partitions=3)
    assert rows(spark.read.parquet(f"{tmp_path}/copy")) == rows(customer)


def test_a_table_without_a_key_is_cut_by_its_columns(spark, database):
    # Two thirds of the rows share a value of the first column; the second is mostly null; the third is repeated.
    df = spark.range(600).selectExpr("CASE WHEN id % 3 > 0 THEN 'hot' ELSE 'cold' END AS a", "CASE WHEN id < 9 THEN id END AS b",
                                     "CAST(id % 200 AS DOUBLE) AS c", "id AS d")
    source = filled(spark, database, '"a" VARCHAR(9), "b" BIGINT, "c" DOUBLE, "d" BIGINT', df)
    scan = read_table(spark, source, T, partitions=6)
    assert rows(scan) == rows(df) and partition_sizes(scan) == [100] * 6
    source = filled(spark, database, '"a" CLOB', spark.sql("SELECT CAST(id AS STRING) AS a FROM range(20)"))
    assert read_table(spark, source, T, partitions=6).rdd.getNumPartitions() == 1
    equal = filled(spark, database, '"a" BIGINT', spark.range(40).selectExpr("1L AS a"))
    assert rows(read_table(spark, equal, T, partitions=4)) == [(1,)] * 40


def test_numbers_that_are_not_finite_are_no_cuts(spark, database, monkeypatch):
    from pyspark.sql import Row

    from silofeed.sources import jdbc

    source = filled(spark, database, '"id" DOUBLE', spark.range(9).selectExpr("CAST(id AS DOUBLE) AS id"))
    cuts = [Row(rn=2, id=1.0), Row(rn=3, id=float("nan")), Row(rn=4, id=float("inf"))]
    monkeypatch.setattr(jdbc, "query", lambda *_: spark.createDataFrame(cuts))
    parts = split_by_key(spark, source, T, ["id"], 3)
    assert len(parts) == 2 and all("1.0E0" in part for part in parts)


def test_binary_and_floating_literals():
    from silofeed.sources.jdbc import _literal

    derby, postgres = SourceConfig("jdbc", "jdbc:derby:x"), SourceConfig("jdbc", "jdbc:postgresql://h/x")
    assert _literal(derby, b"\x01\xff") == "X'01FF'" and _literal(postgres, b"\x01\xff") == "'\\x01FF'::bytea"
    assert [_literal(derby, v) for v in (0.1, 1e300, -2.0)] == ["0.1E0", "1e+300", "-2.0E0"]


def test_tables_without_a_schema_are_those_of_the_current_one(spark, database):
    source = database('CREATE SCHEMA "s"', 'CREATE TABLE "s"."t" ("theirs" INT)', 'CREATE TABLE "t" ("mine" INT)')
    assert rows(describe_tables(spark, source, tables=["t"]), "column") == [("mine",)]
    assert read_table(spark, source, TableRef("t")).columns == ["mine"]


def test_names_with_wildcards_and_lengths_of_types(spark, database):
    source = database(
        'CREATE SCHEMA "a_b"', 'CREATE SCHEMA "axb"', 'CREATE TABLE "axb"."t%" ("other" INT)', 'CREATE TABLE "a_b"."txx" ("no" INT)',
        'CREATE TABLE "a_b"."t%" ("c_1" CHAR(3) FOR BIT DATA, "v" VARCHAR(5) FOR BIT DATA, "d" DECIMAL(7,3), "x" DOUBLE NOT NULL, '
        '"k" INT NOT NULL PRIMARY KEY)',
    )
    found = describe_tables(spark, source, "a_b", ["t%"])
    assert rows(found, "ordinal", "column", "type_name", "nullable", "primary_key") == [
        (1, "c_1", "CHAR(3) FOR BIT DATA", True, False), (2, "v", "VARCHAR(5) FOR BIT DATA", True, False),
        (3, "d", "DECIMAL(7,3)", True, False), (4, "x", "DOUBLE", False, False), (5, "k", "INTEGER", False, True)]
    assert rows(list_tables(spark, source, "a_b"), "table") == [("t%",), ("txx",)]
    assert describe_tables(spark, source, "a_b", ["none"]).isEmpty()


def test_metadata_needs_no_queries_of_a_catalog(spark, database, monkeypatch):
    from silofeed.sources import metadata

    source = database('CREATE SCHEMA "s"', 'CREATE TABLE "s"."t" ("id" BIGINT NOT NULL PRIMARY KEY)')
    monkeypatch.setattr(metadata, "query", lambda *_: pytest.fail("a catalog was queried"))
    assert rows(describe_tables(spark, source, "s"), "column", "primary_key") == [("id", True)]
    assert rows(list_tables(spark, source, "s"), "table") == [("t",)]
    assert ("s",) in rows(list_schemas(spark, source), "schema")
    asked = SourceConfig(source.type, source.url, options={"metadata": "information_schema"})
    assert asked.catalog_queries and "metadata" not in asked.connection_options()


def test_the_embedded_database_is_refused_where_executors_are_other_processes(monkeypatch):
    from types import SimpleNamespace

    from silofeed.queries import sources

    made = []
    monkeypatch.setattr(sources, "run_statements", lambda *statements: made.append(statements))
    for master in ("local-cluster[3,2,1000]", "spark://host:7077", "yarn", ""):
        with pytest.raises(RuntimeError, match="local session"):
            sources.embedded_database(SimpleNamespace(conf={"spark.master": master}), "")
    for master in ("local", "local[4]", "local[*]"):
        sources.embedded_database(SimpleNamespace(conf={"spark.master": master}), "")
    assert len(made) == 3
