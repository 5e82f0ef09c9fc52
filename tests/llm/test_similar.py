import random

import pytest

import corpus_pipeline
from silofeed.llm import similar
from silofeed.llm import simhash as S

from .conftest import documents
from .test_simhash import brute


def shingles(text, words=5):
    found = (text or "").lower().split()
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def alike(a, b):
    return bool(a and b) and 5 * len(a & b) >= 4 * len(a | b)


def kept_by_brute_force(rows):
    """Ids that are the smallest of their component, over links of three bits or of four fifths of the shingles."""
    sets, fps, label = {i: shingles(t) for i, t in rows}, {i: brute(t) for i, t in rows}, {i: i for i, _ in rows}
    linked = [(a, b) for a in label for b in label
              if a < b and ((fps[a] ^ fps[b]).bit_count() <= 3 or alike(sets[a], sets[b]))]
    for _ in rows:
        for a, b in linked:
            label[a] = label[b] = min(label[a], label[b])
    return {i for i, least in label.items() if i == least}, [p for p in linked if (fps[p[0]] ^ fps[p[1]]).bit_count() > 3]


@pytest.fixture(scope="module")
def copies():
    """Texts with copies of some changed words, chains of copies and a group whose members differ from each other."""
    rng = random.Random(11)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    texts = []
    for group in range(12):
        text = words(60 + 20 * group)
        texts.append(text)
        for _ in range(8):
            base = text if group % 2 else texts[-1]
            changed = list(base)
            for at in rng.sample(range(len(base)), rng.choice([1, 2, len(base) // 50 + 1, len(base) // 35 + 1])):
                changed[at] = f"new{rng.randrange(10**6)}"
            texts.append(changed)
    texts += [words(80) for _ in range(10)] + [["a", "b"], ["a", "b", "c", "d"]]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_the_stage_against_brute_force(spark, copies):
    expected, far = kept_by_brute_force(copies)
    assert len(far) > 20
    kept = corpus_pipeline.near_copies(spark, documents(spark, copies), "").collect()
    assert {r["doc_id"] for r in kept} == expected


def test_given_documents(spark, docs, texts):
    expected, far = kept_by_brute_force(sorted(texts.items()))
    assert far
    assert {r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, "").collect()} == expected


def test_op5_keeps_its_links(spark, copies):
    found = S.near_duplicates(documents(spark, copies))
    assert len({r["component_id"] for r in found.collect()}) > len(kept_by_brute_force(copies)[0])


def test_settings(nothing, spark):
    assert similar.bands_for(0.8) == 22 and (1 - 0.8**4) ** 22 < 1 - similar.SURE
    with pytest.raises(ValueError):
        similar.bands_for(0)
    assert S.drop_near_duplicates(nothing, similarity=0.8).count() == 0


def test_a_large_group_is_not_compared_by_pairs(spark, monkeypatch):
    """Texts that are nearly similar to many linked ones meet the middle of the group, not each of them."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(150)]
    texts = [base]
    for i in range(60):
        near, far = list(base), list(base)
        near[rng.randrange(5, 145)] = f"near{i}"
        for at in range(10 + i // 2, 140, 36):
            far[at] = f"far{i}"
        far[5] = f"shared{i // 2}"
        texts += [near, far]
    rows, met, stored = [(i, " ".join(t)) for i, t in enumerate(texts)], [], similar.written

    def counted(df, purpose, *rest):
        table = stored(df, purpose, *rest)
        if purpose == "met":
            met.append(table.count())
        return table

    monkeypatch.setattr(similar, "written", counted)
    monkeypatch.setattr(similar, "FEW", 4, raising=False)
    kept = {r["doc_id"] for r in corpus_pipeline.near_copies(spark, documents(spark, rows), "").collect()}
    assert kept == kept_by_brute_force(rows)[0]
    assert max(met) <= 2 * len(rows)
