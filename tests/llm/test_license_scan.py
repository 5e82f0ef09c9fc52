import random
import re

import pytest

from silofeed.llm import license_scan as L

from .conftest import NOTICE, TEXTS, documents


def brute(text):
    """Templates of which some stretch of their own length in words holds enough shingles."""
    words, found = L.words_of(text or ""), set()
    for name, template in L.TEMPLATES.items():
        wanted, n = L.shingles_of(L.words_of(template)), len(L.words_of(template))
        for i in range(len(words)):
            if len(L.shingles_of(words[i : i + n]) & wanted) >= L.CONTAINED * len(wanted):
                found.add(name)
                break
    return found


def found(df):
    return {(r["doc_id"], r["template"]) for r in L.scan(df).collect()}


def test_given_documents(docs, texts):
    assert found(docs) == {(i, name) for i, t in texts.items() for name in brute(t)}


def test_whole_and_damaged_templates(spark):
    rng = random.Random(8)
    rows = []
    for n, template in enumerate(L.TEMPLATES.values()):
        words = template.split()
        for k in range(6):
            damaged = list(words)
            for _ in range(k * len(words) // 60):
                damaged[rng.randrange(len(words))] = "other"
            around = [f"w{rng.randrange(999)}" for _ in range(rng.randrange(300))]
            rows.append((100 * n + k, " ".join([*around, *damaged, *around])))
    assert found(documents(spark, rows)) == {(i, name) for i, t in rows for name in brute(t)}


def test_messy_rows(messy):
    rows = L.scan(messy).collect()
    assert [(r["doc_id"], r["template"], r["containment"]) for r in rows] == [(10, "Apache-2.0", 1.0)]


def test_repeated_rows_and_null_ids_count_once(spark):
    rows = [(1, NOTICE), (1, NOTICE), (None, NOTICE), (2, "license " * 3), (3, "Software license. " * 2000 + NOTICE)]
    assert sorted((r["doc_id"] or 0, r["template"]) for r in L.scan(documents(spark, rows)).collect()) == [
        (0, "Apache-2.0"), (1, "Apache-2.0"), (3, "Apache-2.0")]


def test_empty_table(nothing):
    assert L.scan(nothing).count() == 0


def test_settings():
    for c in L.template_classes():
        for words in c.templates.values():
            wanted = len(L.shingles_of(words))
            shared = -(-int(wanted * 100 * L.CONTAINED) // 100)
            similarity = shared / (c.window - L.SHINGLE + 1 + wanted - shared)
            assert 1 - (1 - similarity) ** c.bands >= L.SURE and len(words) + c.step <= c.window


def test_templates_need_markers_and_words():
    with pytest.raises(ValueError, match="marker"):
        L.template_classes({"x": "one two three four five six seven"})
    with pytest.raises(ValueError, match="fewer"):
        L.template_classes({"x": "a license"})


def test_plan_is_native(spark, docs):
    assert not re.search("Python|Arrow|Pandas", L.scan(docs)._jdf.queryExecution().executedPlan().toString())
    assert len(TEXTS) > 0
