import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from silofeed.llm import simhash as S
from silofeed.llm import tables
from silofeed.llm.graph import components

from .conftest import TEXTS


def brute(text, words=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or [" ".join(found)] * bool(found)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, distance=3):
    """Smallest id reachable, over pairs of id and fingerprint."""
    least = {}
    for i, fp in fps:
        least[fp] = min(least.get(fp, i), i)
    label = dict(least)
    changed = True
    while changed:
        changed = False
        for a in label:
            for b in label:
                if (a ^ b).bit_count() <= distance and label[b] < label[a]:
                    label[a], changed = label[b], True
    return {(i, fp, label[fp]) for i, fp in fps}


def test_fingerprint():
    for _, text in TEXTS:
        assert S.fingerprint(text) == brute(text)


def test_spark_and_library_hash_alike(spark):
    assert spark.sql("SELECT xxhash64('größe')").first()[0] % 2**64 == xxhash.xxh64_intdigest("größe".encode(), 42)


def test_given_documents(docs, texts):
    found = S.near_duplicates(docs).select("doc_id", S.hex_digits(F.col("fp")), "component_id").collect()
    expected = groups([(i, brute(t)) for i, t in texts.items()])
    assert {tuple(r) for r in found} == {(i, f"{fp:016x}", c) for i, fp, c in expected}


def test_close_pairs_are_all_found(spark):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(20)] + [0, 2**64 - 1]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), n)) for c in centres for n in range(6) for _ in range(5)}
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    for distance in range(4):
        found = S.close_pairs(spark.createDataFrame(signed, "fp long"), distance).collect()
        pairs = {frozenset((r["a"] % 2**64, r["b"] % 2**64)) for r in found}
        assert pairs == {frozenset((a, b)) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= distance}


def test_distance_beyond_the_grid(spark):
    with pytest.raises(ValueError):
        S.close_pairs(spark.createDataFrame([], "fp long"), 4)


def test_messy_rows(messy):
    found = S.near_duplicates(messy).collect()
    assert len(found) == len(TEXTS)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["fp"] == by_id[2]["fp"] == 0 and by_id[2]["component_id"] == by_id[3]["component_id"] == 1
    assert by_id[14]["component_id"] == 6 and by_id[9]["component_id"] == 8


def test_dropping_keeps_one_of_each_component(messy):
    kept = S.drop_near_duplicates(messy)
    assert kept.columns == messy.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert not {2, 3, 9, 14} & set(ids) and {1, 6, 8, 10, 11} <= set(ids)


def test_empty_table(nothing):
    assert S.near_duplicates(nothing).count() == 0 and S.drop_near_duplicates(nothing).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_workers_get_few_texts_at_once(spark, docs, monkeypatch):
    def sizes(batches):
        yield from (batch[["id"]].agg({"id": "count"}).to_frame("n") for batch in batches)

    def asked():
        return spark.conf.get(tables.BATCH_SETTING, None)

    before, seen, stored = asked(), {}, tables.stored
    monkeypatch.setattr(tables, "stored", lambda df, purpose, *rest: seen.setdefault(purpose, asked()) and None or stored(df, purpose, *rest))
    assert S.near_duplicates(docs, similarity=0.8).count() == docs.count()
    assert seen["sketches"] == seen["sets"] == str(tables.BATCH_ROWS) and seen["pairs"] == before == asked()
    with tables.short_batches(spark, 10):
        found = spark.range(95).coalesce(1).mapInPandas(sizes, "n long").collect()
    assert sorted(r["n"] for r in found) == [5] + [10] * 9 and asked() == before
