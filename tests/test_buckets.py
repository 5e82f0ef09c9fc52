import pytest
from conftest import rows
from pyspark.sql import functions as F

from silofeed.operators import StaleVersion, apply_to_buckets, compact, create_bucketed, manifest, read_bucketed, versions
from silofeed.operators import buckets as b
from silofeed.workspace import list_names, publish_text, read_text

LOG = "id long, name string, seq int, op string"


@pytest.fixture
def path(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, name string, seq int").schema
    create_bucketed(spark, str(tmp_path / "t"), schema, ["id"], ["seq"], 4)
    return str(tmp_path / "t")


def log(spark, *changes):
    return spark.createDataFrame(changes, LOG).repartition(3)


def bring(spark, path, *changes, **options):
    return apply_to_buckets(log(spark, *changes), path, "op = 'd'", **options)


def state(changes):
    """Brute force: the change with the largest order wins."""
    last = {}
    for c in sorted(changes, key=lambda c: c[2]):
        last[c[0]] = c
    return sorted(((c[0], c[1], c[2]) for c in last.values() if c[3] != "d"), key=repr)


def files(path):
    from pathlib import Path

    return {str(p) for p in Path(path).rglob("*.parquet")}


def test_logs_in_any_order_and_twice(spark, path):
    changes = [(s * 37 % 50, f"v{s}", s, "d" if s % 7 == 0 else "u") for s in range(400)]
    for part in (changes[200:], changes[:200], changes[100:300]):
        bring(spark, path, *part)
    assert rows(read_bucketed(spark, path)) == state(changes) and versions(spark, path) == [0, 1, 2, 3]
    compact(spark, path)
    assert rows(read_bucketed(spark, path)) == state(changes)
    # Marks of removed keys are kept: a late change stays without effect.
    bring(spark, path, *changes[:50])
    assert rows(read_bucketed(spark, path)) == state(changes)


def test_only_changed_buckets_are_written_and_old_versions_stay(spark, path):
    first = [(i, "a", 1, "u") for i in range(40)]
    bring(spark, path, *first)
    before, folders = files(path), manifest(spark, path).folders
    changed = spark.createDataFrame([(7,)], "id long").select(b.bucket_of(["id"], 4)).first()[0]
    bring(spark, path, (7, "z", 2, "u"))
    new, after = files(path) - before, manifest(spark, path).folders
    assert before <= files(path) and all(f"_bucket={changed}/" in name for name in new) and new
    assert {k: v for k, v in after.items() if k != changed} == {k: v for k, v in folders.items() if k != changed}
    before = files(path)
    compact(spark, path)
    assert all(f"_bucket={changed}/" in name for name in files(path) - before)
    assert rows(read_bucketed(spark, path, 1)) == state(first)
    assert rows(read_bucketed(spark, path)) == state([*first, (7, "z", 2, "u")])


def test_many_deltas_become_a_base(spark, path):
    for seq in range(6):
        bring(spark, path, (1, f"v{seq}", seq, "u"), compact_after=3)
    assert max(map(len, manifest(spark, path).folders.values())) <= 4
    assert rows(read_bucketed(spark, path)) == [(1, "v5", 5)]


def test_a_version_is_published_once(spark, path):
    bring(spark, path, (1, "a", 1, "u"))
    late = manifest(spark, path, 0)
    with pytest.raises(StaleVersion):
        b._publish(spark, path, b.Manifest(1, late.schema, late.keys, late.order_by, late.buckets))
    assert rows(read_bucketed(spark, path)) == [(1, "a", 1)]


def test_nothing_to_do(spark, path):
    assert rows(read_bucketed(spark, path)) == []
    assert bring(spark, path, *[]).version == 0 and compact(spark, path).version == 0
    with pytest.raises(ValueError):
        manifest(spark, path + "x")


def test_null_keys_fail_and_change_nothing(spark, path):
    with pytest.raises(Exception, match="key columns must not be null"):
        bring(spark, path, (None, "a", 1, "u"))
    assert versions(spark, path) == [0]


def test_old_marks_may_go(spark, path):
    bring(spark, path, (1, "a", 1, "u"), (2, "b", 1, "u"))
    bring(spark, path, (1, None, 2, "d"), (2, None, 9, "d"))
    compact(spark, path, keep_marks_from=F.col("seq") > 5)
    stored = [tuple(r) for r in b._rows(spark, path, manifest(spark, path)).collect()]
    assert stored == [(2, None, 9, True)] and rows(read_bucketed(spark, path)) == []


def test_small_files(spark, tmp_path):
    assert publish_text(spark, f"{tmp_path}/a/x.json", "one ö") and not publish_text(spark, f"{tmp_path}/a/x.json", "two")
    assert read_text(spark, f"{tmp_path}/a/x.json") == "one ö" and list_names(spark, f"{tmp_path}/a/*") == ["x.json"]
