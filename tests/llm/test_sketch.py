import hashlib

import numpy as np
import pytest

from silofeed.llm import sketch as S

from .conftest import TEXTS, documents


def test_given_documents(docs, texts):
    order = sorted(texts)
    following = dict(zip(order, order[1:] + order[:1], strict=True))
    found = S.edits(docs).collect()
    assert sorted(r["doc_id"] for r in found) == order
    for r in found:
        text, other = texts[r["doc_id"]], texts[following[r["doc_id"]]]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        own, changed, after = (S.sketch(t) for t in (text, edited, other))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (S.digits(own), S.digits(changed))
        assert r["near_edited"] == S.resemblance(own, changed) and r["near_next"] == S.resemblance(own, after)


def test_messy_rows(messy):
    found = S.edits(messy).collect()
    assert len(found) == len(TEXTS)
    ordered = sorted(((i, t or "") for i, t in TEXTS if i is not None))
    following = [t for _, t in ordered[1:] + ordered[:1]]
    expected = [(i, len(t), S.edited_text(t, n)) for (i, t), n in zip(ordered, following, strict=True)]
    expected += [(None, len(t or ""), S.edited_text(t or "", "")) for i, t in TEXTS if i is None]
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found), key=repr) == sorted(
        ((i, n, hashlib.sha256(e.encode()).hexdigest()) for i, n, e in expected), key=repr)


def test_one_row_follows_itself(spark):
    row = S.edits(documents(spark, [(5, "abcd efgh")])).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcd abcd").hexdigest() and row["near_next"] == 1.0


def test_estimates():
    words = [f"w{i}" for i in range(40_000)]
    large, small = " ".join(words), " ".join(words[5_000:9_000])
    a, b = S.sketch(large), S.sketch(small)
    assert S.containment(b, a) == 1.0 and abs(S.containment(a, b) - 0.1) < 0.02 and abs(S.resemblance(a, b) - 0.1) < 0.02
    other = S.sketch(" ".join(words[20_000:30_000]))
    assert np.array_equal(S.merge(b, other), np.union1d(b, other))
    assert np.array_equal(S.parsed(S.digits(a)), a)


@pytest.mark.parametrize("text", [None, "", " \n", "one", "A  b\nC d e f", "x " * 5000])
def test_equal_texts_have_equal_fingerprints(text):
    assert np.array_equal(S.sketch(text), S.sketch(text and " ".join(text.split()).upper()))
    assert S.resemblance(S.sketch(text), S.sketch(text)) == 1.0


def test_short_texts_keep_a_hash():
    assert all(len(S.sketch(f"only a few words {i}")) == 1 for i in range(50))


def test_fingerprints_and_empty_table(messy, nothing):
    found = {r["doc_id"]: r["fingerprint"] for r in S.fingerprints(messy).collect()}
    assert found[1] == found[2] == "" and found[6] == found[14]
    assert S.edits(nothing).count() == 0 and S.fingerprints(nothing).count() == 0
