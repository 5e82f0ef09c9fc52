import datetime

import pytest
from conftest import plan, rows

from silofeed.plans import Ranges, read_ranges, sync_ranges
from silofeed.plans import ranges as r

SCHEMA = "id int, at long, name string"
BASE = [(i, i * 3 - 30, f"v{i}") for i in range(40)] + [(100, None, "none"), (101, None, "none"), (101, None, "none")]


def table(spark, given, schema=SCHEMA):
    return spark.createDataFrame(given, schema).repartition(3)


def test_only_ranges_that_differ_are_read_again(spark, tmp_path):
    path, ranges = f"{tmp_path}/t", Ranges("at", 10)
    first = sync_ranges(table(spark, BASE), path, ranges)
    assert len(first) == 13 and rows(read_ranges(spark, path)) == rows(table(spark, BASE))
    before = r.ledger(spark, path)["ranges"]
    assert sync_ranges(table(spark, BASE), path, ranges) == [] and r.ledger(spark, path)["version"] == 0
    # A late row, a change without a new cursor, one row fewer, and a change of a row that has no cursor.
    changed = [x for x in BASE if x[0] not in (0, 15, 101)] + [(500, -25, "late"), (15, 15, "new"), (101, None, "none"), (101, None, "changed")]
    assert sync_ranges(table(spark, changed), path, ranges) == ["-3", "1", "none"]
    assert rows(read_ranges(spark, path)) == rows(table(spark, changed)) and rows(read_ranges(spark, path, 0)) == rows(table(spark, BASE))
    after = r.ledger(spark, path)["ranges"]
    assert {n: e for n, e in after.items() if n not in ("-3", "1", "none")} == {n: e for n, e in before.items() if n not in ("-3", "1", "none")}


def test_ranges_that_are_gone(spark, tmp_path):
    path = f"{tmp_path}/t"
    for given in (BASE, BASE[:3], []):
        sync_ranges(table(spark, given), path, Ranges("at", 10))
        assert rows(read_ranges(spark, path)) == rows(table(spark, given))


def test_other_columns_copy_all(spark, tmp_path):
    path = f"{tmp_path}/t"
    sync_ranges(table(spark, BASE), path, Ranges("at", 10))
    wide = table(spark, BASE).selectExpr("*", "1 AS more")
    assert len(sync_ranges(wide, path, Ranges("at", 10))) == 13 and rows(read_ranges(spark, path)) == rows(wide)


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "timestamp"])
def test_days(spark, tmp_path, kind):
    days = [(i, str(datetime.datetime(1969, 12, 28) + datetime.timedelta(hours=7 * i)), "x") for i in range(30)]
    df = table(spark, days, "id int, at string, name string").selectExpr("id", f"CAST(at AS {kind}) AS at", "name")
    path = f"{tmp_path}/t"
    assert len(sync_ranges(df, path, Ranges("at", 2))) == 5 and rows(read_ranges(spark, path)) == rows(df)
    assert sync_ranges(df.selectExpr("id", "at", "IF(id = 3, 'y', name) AS name"), path, Ranges("at", 2)) == ["-2"]


def test_bounds_reach_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id AS at", "id").write.parquet(f"{tmp_path}/s")
    source = spark.read.parquet(f"{tmp_path}/s")
    ranges = Ranges("at", 10)
    found = source.filter(ranges.among(source, ["3", "4", "7"]))
    assert sorted(x["at"] for x in found.collect()) == [*range(30, 50), *range(70, 80)]
    assert "GreaterThanOrEqual(at,30)" in plan(found) and "LessThan(at,50)" in plan(found)


def test_many_intervals(spark, monkeypatch):
    monkeypatch.setattr(r, "INTERVALS", 1)
    source = spark.range(100).selectExpr("IF(id = 50, NULL, id) AS at")
    found = source.filter(Ranges("at", 10).among(source, ["3", "7", "none"]))
    assert sorted(x["at"] or -1 for x in found.collect()) == [-1, *range(30, 40), *range(70, 80)]


def test_values_that_move_between_columns_are_seen(spark, tmp_path):
    path = f"{tmp_path}/t"
    for a, b in (("x", None), (None, "x")):
        df = spark.createDataFrame([(1, a, b)], "at long, a string, b string")
        assert sync_ranges(df, path, Ranges("at")) == ["1"] and rows(read_ranges(spark, path)) == rows(df)


def test_cursors_of_other_types_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="whole number"):
        sync_ranges(table(spark, BASE), f"{tmp_path}/t", Ranges("name"))
