import hashlib
import re
from collections import defaultdict

import pytest

from silofeed.llm.exact_dedup import drop_duplicates, exact_duplicates

from .conftest import TEXTS, documents


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normal(text)].append((-len(text or ""), doc_id is None, doc_id))
    out = []
    for doc_id, text in rows:
        group = groups[normal(text)]
        keep = min(group, key=lambda g: (g[0], g[1], g[2] or 0))[2]
        out.append((doc_id, keep, len(group), doc_id == keep))
    return sorted(out, key=repr)


def test_messy_rows(messy):
    found = exact_duplicates(messy).collect()
    assert sorted([tuple(r) for r in found], key=repr) == expected(TEXTS)


def test_prefix_alone_does_not_decide(spark):
    rows = [(1, "p" * 400 + "a"), (2, "p" * 400 + "b"), (3, "p" * 400 + "a")]
    assert sorted(tuple(r) for r in exact_duplicates(documents(spark, rows)).collect()) == expected(rows)


def test_dropping_keeps_one_row_and_all_columns(messy):
    kept = drop_duplicates(messy)
    assert kept.columns == messy.columns
    groups = [normal(r["text"]) for r in kept.collect()]
    assert len(groups) == len(set(groups)) and set(groups) == {normal(t) for _, t in TEXTS}


def test_one_id_with_two_texts(spark):
    rows = [(1, "same"), (2, "same"), (2, "other")]
    assert sorted((r["doc_id"], r["text"]) for r in drop_duplicates(documents(spark, rows)).collect()) == [(1, "same"), (2, "other")]


def test_hot_group(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot text', 'text ' || id) AS text")
    found = exact_duplicates(df).where("group_size > 1")
    assert found.count() == 1000 and found.where("kept").collect() == [(0, 0, 1000, True)]


def test_empty_table(nothing):
    assert exact_duplicates(nothing).count() == 0 and drop_duplicates(nothing).count() == 0


@pytest.mark.parametrize("text", ["a b", None])
def test_carried_columns(spark, text):
    from pyspark.sql import functions as F

    from silofeed.llm.exact_dedup import normalised

    digest = {"d": F.sha2(normalised(F.col("text")), 256)}
    found = exact_duplicates(documents(spark, [(1, text), (2, "alone")]), carry=digest).where("doc_id = 1").first()
    assert found["d"] == hashlib.sha256(normal(text).encode()).hexdigest()
