import pytest
from conftest import rows

from silofeed.operators import manifest
from silofeed.plans import follow_log, read_snapshot, snapshot_with_log
from silofeed.plans.snapshot import chunk_ends, finished

CHANGES = [(s, s * 37 % 60, f"v{s}", "d" if s % 5 == 0 else "u") for s in range(300)]


class Source:
    """A table and its log; each look at one of them sees more changes."""

    def __init__(self, spark, step, seen=60):
        self.spark, self.step, self.seen = spark, step, seen

    def changes(self):
        self.seen = min(self.seen + self.step, len(CHANGES))
        return CHANGES[: self.seen]

    def state(self):
        last = {key: (key, name, op) for _, key, name, op in self.changes()}
        return self.spark.createDataFrame([x[:2] for x in last.values() if x[2] != "d"], "id long, name string")

    def log(self):
        return self.spark.createDataFrame(self.changes(), "pos long, id long, name string, op string")


def final():
    last = {key: (key, name, op) for _, key, name, op in CHANGES}
    return sorted((x[:2] for x in last.values() if x[2] != "d"), key=repr)


@pytest.mark.parametrize("step", [0, 7, 40])
def test_a_snapshot_while_the_table_changes(spark, tmp_path, step):
    source, path = Source(spark, step), f"{tmp_path}/t"
    done = snapshot_with_log(source.state, source.log, path, ["id"], "pos", 4, 4, "op = 'd'", at_most=2)
    assert len(done) == 2 and finished(spark, path) == done
    # Another process goes on where this one has stopped, with the same chunks.
    done = snapshot_with_log(source.state, source.log, path, ["id"], "pos", 4, 4, "op = 'd'")
    assert [c.number for c in done] == [0, 1, 2, 3] and all(c.low <= c.high for c in done)
    assert [c.after for c in done[1:]] == [c.until for c in done[:-1]]
    if not step:
        assert rows(read_snapshot(spark, path)) == rows(source.state())
    log = spark.createDataFrame(CHANGES, "pos long, id long, name string, op string")
    for _ in range(2):
        follow_log(log, path, "pos", "op = 'd'", after=done[0].low)
        assert rows(read_snapshot(spark, path)) == final()


def test_a_finished_snapshot_reads_nothing_more(spark, tmp_path):
    source, path = Source(spark, 0), f"{tmp_path}/t"
    snapshot_with_log(source.state, source.log, path, ["id"], "pos", 2, 2, "op = 'd'")
    version = manifest(spark, path).version
    snapshot_with_log(source.state, source.log, path, ["id"], "pos", 2, 2, "op = 'd'")
    assert manifest(spark, path).version == version


def test_cuts(spark):
    table = spark.range(1000)
    assert len(chunk_ends(table, "id", 5)) == 4 and chunk_ends(table, "id", 1) == [] and chunk_ends(table.limit(0), "id", 3) == []


def test_null_keys_are_refused(spark, tmp_path):
    table = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c")], "id long, name string")
    log = spark.createDataFrame([], "pos long, id long, name string, op string")
    with pytest.raises(Exception, match="key columns must not be null"):
        snapshot_with_log(lambda: table, lambda: log, f"{tmp_path}/t", ["id"], "pos", 2, 2)
