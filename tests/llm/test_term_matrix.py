import itertools
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from silofeed.llm import tables
from silofeed.llm import term_matrix as m

from .conftest import TEXTS

LABELS = "doc_id long, quality int, toxic int, id string"


def brute(texts, labels):
    """Rows of the audit; ``texts`` has id, text and part."""
    good = {i for i, quality, _ in labels if i is not None and quality == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    least = {}
    for i, text, _ in texts:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    docs = []
    for i, text, part in texts:
        text = text or ""
        words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
                 "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), "D": any(c in "#$%&*|" for c in text),
                 "E": i is not None and i > least[text]}
        docs.append((part or "", {f for f, bad in fails.items() if bad}, i in good, i in toxic))
    rows = []
    for part in {d[0] for d in docs}:
        removals = Counter()
        found = []
        for order in map("".join, itertools.permutations("ABCDE")):
            for step in range(5):
                own, before = order[step], set(order[:step])
                mine = [d for d in docs if d[0] == part]
                gone = [d for d in mine if own in d[1] and not d[1] & before]
                removals[own] += len(gone)
                found.append((own, (part, order, step + 1, sum(not d[1] & (before | {own}) for d in mine), len(gone),
                              sum(own in d[1] and bool(d[1] & before) for d in mine), sum(d[1] == {own} for d in mine),
                              sum(d[2] for d in gone), sum(d[3] for d in gone))))
        rows += [(*row, removals[own]) for own, row in found]
    return sorted(rows)


EXTRA = [(30, "#" + " ok" * 60, "a"), (31, "LOUD " * 70, "b"), (32, " ".join(f"w{i}" for i in range(60)), None), (33, " ".join(f"w{i}" for i in range(60)), "b"),
         (33, " ".join(f"w{i}" for i in range(60)), "b"), (34, "one\x0btwo\x0cthree\rfour\nfive", ""), (None, None, "a"), (3, None, "a")]


def test_audit_by_brute_force(spark):
    texts = [(i, t, "src" if t else None) for i, t in TEXTS] + EXTRA
    labels = [(1, 1, 0), (4, 1, 1), (30, 0, 1), (31, 1, 0), (31, 0, 1), (33, 1, None), (None, 1, 1), (99, 1, 1)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string").withColumns(
        {c: F.lit(c) for c in ("id", "part", "row", "n", "flags", "content")}).repartition(3)
    found = m.audit(docs, spark.createDataFrame([(*x, "x") for x in labels], LABELS))
    assert sorted(map(tuple, found.collect())) == brute(texts, labels)


def test_audit_of_given_documents(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    texts = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    marks = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]
    assert sorted(map(tuple, m.audit(docs, labels).collect())) == brute(texts, marks)


def rebuilt(shards, words):
    names = {r["code"]: bytes(r["word"]) for r in words.collect()}
    found = []
    for s in shards.collect():
        ends, codes, counts = (np.frombuffer(s[c], kind).tolist() for c, kind in (("ends", "<i4"), ("codes", "<i8"), ("counts", "<i4")))
        for row, begin, end in zip(s["rows"], [0, *ends[:-1]], ends, strict=True):
            found.append((row, {names[c]: n for c, n in zip(codes[begin:end], counts[begin:end], strict=True)}))
    return names, found


@pytest.mark.parametrize("limits", [(1 << 20, 1 << 14), (40, 3)])
def test_matrix_holds_all_words(spark, messy, monkeypatch, limits):
    monkeypatch.setattr(m, "WORDS", limits[0])
    monkeypatch.setattr(m, "ROWS", limits[1])
    shards, words = m.term_matrix(messy, F.col("doc_id"))
    names, found = rebuilt(shards, words)
    want = [(i, dict(Counter((t or "").encode().split()))) for i, t in TEXTS]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    distinct = {w for _, row in want for w in row}
    assert sorted(names) == list(range(len(distinct))) and set(names.values()) == distinct and words.count() == len(distinct)


def test_sums_of_rows(spark, messy):
    shards, _ = m.term_matrix(messy, F.col("doc_id"))
    found = sorted((tuple(r) for r in m.row_sums(shards).collect()), key=repr)
    want = sorted(((i, len((t or "").encode().split()), len(set((t or "").encode().split()))) for i, t in TEXTS), key=repr)
    assert found == want


def test_words_are_no_objects_of_python(monkeypatch):
    monkeypatch.setattr(m, "PORTION", 20)
    shard, texts = m._Shard(), pa.array(["b a\x0bb ", "", "\x1c\xa0 c", " \t", "c b b b", "a"])
    for at, stop in m._portions(texts):
        shard.add(texts.slice(at, stop - at))
    assert shard.n_words == 10 and len(shard.parts) > 1 and all(pa.types.is_dictionary(part.type) for part in shard.parts)
    one = shard.batch(pa.array(range(6)))
    names, ends, terms, counts = one.column("words").flatten().to_pylist(), *(m.numbers_of(one, x).tolist() for x in ("ends", "terms", "counts"))
    found = [{names[t]: n for t, n in zip(terms[i:j], counts[i:j], strict=True)} for i, j in zip([0, *ends[:-1]], ends, strict=True)]
    assert found == [dict(Counter(t.encode().split())) for t in texts.to_pylist()]


def test_words_move_in_blocks(spark, monkeypatch):
    """A shard has a row for each task that gives codes, however many words it has, and goes on over the next texts."""
    monkeypatch.setattr(m, "short_batches", lambda spark, rows=7: tables.short_batches(spark, min(rows, 7)))
    docs = spark.range(0, 200, 1, 1).selectExpr("id AS doc_id", "concat_ws(' ', 'a', id, 'größe', 'b' || id % 9) AS text")
    with m.short_batches(spark):
        local = m.local_shards(docs, F.col("doc_id")).cache()
        assert local.count() == 1 and len(m.numbers_of(local.toArrow().to_batches()[0], "sizes")) == 211
        found = m.coded(local).collect()
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(r["shard"] is not None for r in found) <= buckets and sum(len(r["places"] or "") for r in found) == 4 * 211
    shards, words = m.term_matrix(docs, F.col("doc_id"))
    names, rows = rebuilt(shards, words)
    assert sorted(names) == list(range(211))
    assert sorted(rows, key=repr) == sorted(((i, dict.fromkeys([b"a", str(i).encode(), "größe".encode(), b"b%d" % (i % 9)], 1)) for i in range(200)), key=repr)


def test_hot_text(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot text', 'text ' || id) AS text", "'s' AS source")
    counted = m.cells(m.flagged(docs), spark.createDataFrame([], LABELS)).collect()
    assert {(r["flags"], r["n"]) for r in counted} == {(1, 2001), (1 | 16, 999)}


def test_empty_tables(spark, nothing):
    assert m.audit(nothing, spark.createDataFrame([], LABELS)).count() == 0
    shards, words = m.term_matrix(nothing, F.col("doc_id"))
    assert shards.count() == 0 and words.count() == 0
