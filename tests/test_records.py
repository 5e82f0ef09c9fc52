import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silofeed.functions import (
    record_columns,
    record_get,
    record_has,
    record_set,
    record_size,
    record_to_row,
    records_equal,
    row_to_record,
)


@pytest.fixture
def orders(spark):
    df = spark.createDataFrame(
        [(1, "acme", "100.00"), (2, None, "250.00")], "id long, tenant string, amount string"
    ).withColumn("amount", F.col("amount").cast("decimal(12,2)"))
    return df.withColumn("record", row_to_record(df))


def test_access(orders):
    shown = orders.orderBy("id").select(
        record_get("record", "tenant"),
        record_get("record", "absent"),
        record_has("record", "tenant"),
        record_has("record", "absent"),
        record_size("record"),
        record_columns("record"),
    )
    names = ["id", "tenant", "amount"]
    assert [tuple(r) for r in shown.collect()] == [
        ("acme", None, True, False, 3, names),
        (None, None, True, False, 3, names),
    ]


def test_round_trip_and_absent_columns(orders):
    schema = StructType().add("amount", "decimal(12,2)").add("note", "string").add("id", "long")
    df = orders.orderBy("id").select(*record_to_row("record", schema))
    assert df.schema.names == ["amount", "note", "id"]
    assert [(str(r[0]), r[1], r[2]) for r in df.collect()] == [("100.00", None, 1), ("250.00", None, 2)]


def test_setting_a_column(orders):
    again = record_set("record", "id", F.lit("x"))
    new = record_set("record", "note", F.lit(5))
    null = record_set("record", "id", F.lit(None))
    entries = [F.map_entries(m) for m in (again, new)]  # a collected map has no order
    row = orders.filter("id = 1").select(*entries, record_has(null, "id"), record_get(null, "id")).first()
    assert [tuple(e) for e in row[0]] == [("id", "x"), ("tenant", "acme"), ("amount", "100.00")]
    assert [tuple(e) for e in row[1]] == [("id", "1"), ("tenant", "acme"), ("amount", "100.00"), ("note", "5")]
    assert row[2:] == (True, None)
    with pytest.raises(ValueError, match="column name"):
        record_set("record", None, F.lit(1))


def test_equality_ignores_order_and_heeds_nulls(spark):
    df = spark.sql("""
        SELECT map('a', '1', 'b', NULL) AS m, map('b', NULL, 'a', '1') AS same,
               map('a', '1') AS fewer, map('a', '1', 'b', 'x') AS other,
               CAST(NULL AS MAP<STRING, STRING>) AS nothing""")
    row = df.select(*[records_equal("m", c) for c in ("m", "same", "fewer", "other", "nothing")]).first()
    assert tuple(row) == (True, True, False, False, False)


def test_typed_records_keep_types(spark):
    from silofeed.functions import row_to_typed_record, typed_record_get, typed_record_to_row

    given = spark.sql("""SELECT 1 AS id, array(1.5D, null) AS list, named_struct('a', 'x', 'b', date'2024-01-02') AS one,
        X'00FF' AS raw, timestamp_ntz'2024-01-02 03:04:05.678901' AS at, 12.34BD AS amount, map('k', 2) AS map, true AS yes,
        CAST(null AS INT) AS nothing, 'text' AS `a b.c`""")
    record = given.select(row_to_typed_record(given).alias("r"))
    assert record.select(*typed_record_to_row("r", given.schema)).collect() == given.collect()
    assert record.select(typed_record_get("r", "absent", "int").alias("x")).first()["x"] is None
