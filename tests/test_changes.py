import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from silofeed.functions import record_columns, row_to_record
from silofeed.operators import apply_changes, diff_tables, latest_changes

LOG = "id long, seq int, op string, name string"


def brute_force(snapshot, changes):
    state = dict(snapshot)
    for key, _, op, name in sorted(changes, key=lambda c: c[1]):
        if op == "d":
            state.pop(key, None)
        else:
            state[key] = name
    return sorted(state.items())


def test_changes_against_brute_force(spark):
    snapshot = [(i, f"old{i}") for i in range(200)]
    # Key 7 gets a third of all changes.
    changes = [(7 if s % 3 == 0 else s * 37 % 300, s, "d" if s * 7 % 10 < 3 else "u", f"v{s}") for s in range(1500)]
    base = spark.createDataFrame(snapshot, "id long, name string").repartition(3)
    log = spark.createDataFrame(changes, LOG)
    expected = brute_force(snapshot, changes)
    for parts in (1, 7):
        applied = apply_changes(base, log.repartition(parts), ["id"], ["seq"], F.col("op") == "d")
        assert applied.columns == ["id", "name"]
        assert sorted(map(tuple, applied.collect())) == expected


def test_without_a_mark_nothing_is_removed(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    log = spark.createDataFrame([(2, 1, "u", "c"), (3, 2, None, "d")], LOG)
    assert rows(apply_changes(base, log, ["id"], ["seq"])) == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(apply_changes(base, log, ["id"], ["seq"], F.col("op") == "u")) == [(1, "a"), (3, "d")]


def test_keys_of_more_than_one_column_and_null_values(spark):
    log = spark.createDataFrame(
        [(1, "x", 1, "a"), (1, "y", 2, "b"), (1, "x", 3, None)], "a int, b string, s int, v string"
    )
    assert rows(latest_changes(log, ["a", "b"], ["s"])) == [(1, "x", 3, None), (1, "y", 2, "b")]


def test_rows_with_maps_and_orders_with_nulls(spark):
    log = spark.sql("""
        SELECT * FROM VALUES (1, 1, map('a', 1)), (1, 3, map('b', 2)), (1, 2, NULL), (2, NULL, map('c', 3)),
            (2, 0, NULL), (3, NULL, map('d', 4)) AS log(id, seq, m)""")
    newest = latest_changes(log, ["id"], ["seq"])
    assert rows(newest) == [(1, 3, {"b": 2}), (2, 0, None), (3, None, {"d": 4})]
    plain = latest_changes(log.selectExpr("id", "seq", "m['b'] AS b"), ["id"], ["seq"])
    assert rows(plain) == [(1, 3, 2), (2, 0, None), (3, None, None)]
    assert rows(latest_changes(log.select("id", "seq"), ["id"], ["seq", "id"])) == [(1, 3), (2, 0), (3, None)]


def test_names_with_dots_and_quotes(spark):
    names = ["a.id", "the `seq`", "v.w"]
    base = spark.createDataFrame([(1, 0, "old"), (2, 0, "kept")], "a int, b int, c string").toDF(*names)
    log = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (3, 1, "z")], "a int, b int, c string").toDF(*names)
    applied = apply_changes(base, log, ["a.id"], ["the `seq`"])
    assert applied.columns == names
    assert sorted(map(tuple, applied.collect())) == [(1, 2, "y"), (2, 0, "kept"), (3, 1, "z")]
    assert sorted(r[3:] for r in diff_tables(base, applied).collect()) == [("left", 1), ("right", 1), ("right", 1)]
    assert base.select(record_columns(row_to_record(base))).first()[0] == names


def test_a_null_key_fails(spark):
    log = spark.createDataFrame([(None, 1, "u", "a")], LOG)
    base = spark.createDataFrame([(1, "a")], "id long, name string")
    for df in (latest_changes(log, ["id"], ["seq"]), apply_changes(base, log, ["id"], ["seq"])):
        with pytest.raises(Exception, match="key columns must not be null: id"):
            df.collect()


def test_snapshot_plus_changes_is_the_latest_of_the_whole_log(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    order, deleted = ["ts", "event_id"], F.col("event_type") == "error"
    whole = latest_changes(events, ["user_id"], order).filter(~deleted)
    early = events.filter("ts <= timestamp_ntz'2024-01-10 00:00:00'")
    base = latest_changes(early, ["user_id"], order).filter(~deleted)
    later = events.filter("ts > timestamp_ntz'2024-01-10 00:00:00'")
    assert rows(apply_changes(base, later, ["user_id"], order, deleted)) == rows(whole)


def test_one_row_per_key_is_shuffled_and_the_snapshot_is_not(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    orders = orders.selectExpr("o_orderkey AS user_id", "o_custkey AS value")
    text = plan(apply_changes(orders, events, ["user_id"], ["ts", "event_id"]))
    assert "partial_max(struct" in text and "Window" not in text
    assert "BroadcastHashJoin" in text and "LeftAnti" in text
    assert text.count("Exchange hashpartitioning") == 2
