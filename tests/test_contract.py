"""One contract for all kinds of sources: what is written is found, described and read back."""

import uuid

import pytest
from conftest import rows
from decimal import Decimal
from pyspark.sql.types import DecimalType, LongType

from silofeed.operators import create_tenant_database
from silofeed.sources import (
    PARQUET,
    TABLE,
    SourceConfig,
    TableRef,
    append_table,
    count_table,
    declare_key,
    describe_table,
    list_schemas,
    list_tables,
    primary_key_columns,
    describe_tables,
    read_table,
    require_tables,
)

NAMES = ["id", "tenant", "amount"]
SEED = [(11, "north", Decimal("7.25")), (12, "south", Decimal("-0.50")), (40, "north", None)]


def seed(spark):
    df = spark.createDataFrame(SEED, "id long, tenant string, amount decimal(12,2)")
    return declare_key(df, ["id"], ["tenant"])


@pytest.fixture(params=["jdbc", "parquet", "table"])
def source(request, spark, database, tenant, tmp_path):
    schema = "df_acme" if request.param == "jdbc" else f"df_{tenant}"
    ref = TableRef("orders", schema)
    if request.param == "jdbc":
        config = database(
            'CREATE SCHEMA "df_acme"',
            'CREATE TABLE "df_acme"."orders" ("id" BIGINT NOT NULL PRIMARY KEY, "tenant" VARCHAR(64) NOT NULL, '
            '"amount" NUMERIC(12, 2))',
        )
        append_table(spark, seed(spark), config, ref)
    elif request.param == "parquet":
        config = SourceConfig(PARQUET, str(tmp_path))
        seed(spark).write.parquet(f"{tmp_path}/{schema}/orders")
    else:
        config = SourceConfig(TABLE, "spark_catalog")
        create_tenant_database(spark, tenant)
        seed(spark).write.saveAsTable(f"`{schema.replace('-', '_')}`.orders")
    return config, ref


def test_schema_and_table_are_listed(spark, source):
    config, ref = source
    schemas = [r["schema"] for r in list_schemas(spark, config).collect()]
    assert (ref.schema.replace("-", "_") if config.type == TABLE else ref.schema) in schemas
    assert rows(list_tables(spark, config, ref.schema)) == [(None, ref.schema, "orders")]


def test_columns_and_key_are_described(spark, source):
    config, ref = source
    columns = describe_table(spark, config, ref)
    assert [c.column for c in columns] == NAMES
    assert [c.ordinal for c in columns] == [1, 2, 3]
    assert [c.nullable for c in columns] == [False, False, True]
    assert [c.primary_key for c in columns] == [True, False, False]
    assert columns[0].jdbc_type == -5 and columns[1].jdbc_type == 12
    assert columns[2].jdbc_type in (2, 3)
    assert columns[2].type_name.lower() in ("numeric(12,2)", "decimal(12,2)")
    keys = primary_key_columns(describe_tables(spark, config, ref.schema))
    assert rows(keys) == [(None, ref.schema, "orders", ["id"])]


def test_rows_are_read_in_declared_order_of_columns(spark, source):
    df = read_table(spark, *source)
    assert df.columns == NAMES
    assert isinstance(df.schema["id"].dataType, LongType) and df.schema["amount"].dataType == DecimalType(12, 2)
    assert rows(df) == SEED


def test_a_row_is_written_and_read_back(spark, source):
    row = spark.sql("SELECT 19.75D AS amount, 'x' AS extra, 'west' AS tenant, 57 AS id")
    append_table(spark, row, *source)
    assert count_table(spark, *source) == 4
    assert rows(read_table(spark, *source)) == [*SEED, (57, "west", Decimal("19.75"))]
    assert [c.primary_key for c in describe_table(spark, *source)] == [True, False, False]


def test_a_missing_table_is_an_error(spark, source):
    config, ref = source
    missing = TableRef("no_such_table", ref.schema)
    for use in (describe_table, read_table, count_table):
        with pytest.raises(ValueError, match=f"table not found: {ref.schema}.no_such_table"):
            use(spark, config, missing)
    with pytest.raises(ValueError, match="table not found"):
        append_table(spark, seed(spark), config, missing)
    described = describe_tables(spark, config, ref.schema)
    require_tables(described, [ref])
    with pytest.raises(ValueError, match="table not found: .*no_such_table"):
        require_tables(described, [ref, missing])


def test_a_source_of_unknown_kind_is_refused(spark):
    with pytest.raises(ValueError, match="no connector"):
        read_table(spark, SourceConfig("queue", "x"), TableRef("orders"))
    with pytest.raises(ValueError, match="no connector"):
        read_table(spark, SourceConfig("jdbc", f"http://{uuid.uuid4().hex}"), TableRef("orders"))


@pytest.mark.parametrize("name", ["..", "*", "o?ders", "[a-z]*", "{orders,x}", "../df_other/orders", "a\\*"])
def test_a_name_does_not_lead_out_of_a_tenants_folder(spark, tmp_path, name):
    seed(spark).write.parquet(f"{tmp_path}/df_acme/orders")
    seed(spark).write.parquet(f"{tmp_path}/df_other/orders")
    config = SourceConfig(PARQUET, str(tmp_path))
    for ref in (TableRef(name, "df_acme"), TableRef("orders", name)):
        with pytest.raises(ValueError, match="illegal name"):
            read_table(spark, config, ref)
    with pytest.raises(ValueError, match="illegal name"):
        list_tables(spark, config, name)


def test_names_in_the_spark_catalog_are_quoted(spark):
    with pytest.raises(ValueError, match="table not found"):
        read_table(spark, SourceConfig(TABLE, "spark_catalog"), TableRef("x` UNION SELECT `y"))
