import hashlib
import random

import numpy as np
import pytest

from silofeed.llm import suffix_dedup as S

from .conftest import documents


def brute(rows):
    """Digest columns by id, over rows in the order in which strings count as earlier."""
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            if data[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(data[i : i + 100])
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def check(df, rows, **options):
    found = [(r[0], r[1], r[2], r[3], r[4], bytes(r[5])) for r in S.remove_repeats(df, **options).collect()]
    assert sorted(found, key=repr) == sorted(brute(rows), key=repr)


def passages():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(40) for _ in range(4)] + ["é" * 70, "ab" * 80, prose(19)[:100], prose(19)[:99]]
    rows = [(i, prose(rng.randint(0, 60)) + rng.choice(shared) + prose(rng.randint(0, 60)) + rng.choice(shared)) for i in range(60)]
    rows += [(100, "z" * 500), (101, "z" * 99), (102, "z" * 100), (103, rows[0][1] * 3), (104, None), (105, ""), (106, rows[3][1])]
    return rows


@pytest.mark.parametrize("together", [2, S.TOGETHER])
def test_passages(spark, together):
    check(documents(spark, passages()), passages(), together=together)


def test_given_documents(docs, texts):
    check(docs, sorted(texts.items()))


def test_repeated_rows_and_null_ids(spark):
    a, b = "first text " * 15, "another one, with no repeats: " + "".join(map(chr, range(300, 420)))
    rows = [(1, a), (1, a), (None, b), (2, b), (None, None)]
    found = {(r["doc_id"], r["n_removed"]) for r in S.remove_repeats(documents(spark, rows)).collect()}
    own = brute([(1, a)])[0][2]
    assert found == {(1, own), (2, 0), (None, len(b.encode())), (None, 0)}


def test_hot_passage_with_many_surroundings(spark):
    shared = "".join(chr(97 + i * i % 23) for i in range(300))
    rows = [(i, f"{hashlib.sha256(str(i).encode()).hexdigest()}{shared}{hashlib.md5(str(i).encode()).hexdigest()}") for i in range(200)]
    check(documents(spark, rows), rows, together=16)


def test_empty_table(nothing):
    assert S.remove_repeats(nothing).count() == 0


def test_anchors_of_equal_strings_are_alike():
    rng = random.Random(2)
    string = bytes(rng.randrange(97, 103) for _ in range(100))
    for _ in range(50):
        before = bytes(rng.randrange(97, 103) for _ in range(rng.randrange(90)))
        data = np.frombuffer(before + string + bytes(rng.randrange(97, 103) for _ in range(40)), np.uint8)
        _, at, first, last = S.anchors(data)
        which = np.flatnonzero((first <= len(before)) & (last >= len(before)))
        _, alone, _, _ = S.anchors(np.frombuffer(string, np.uint8))
        assert at[which[0]] - len(before) == alone[0]


def test_loser_tree_shares_prefixes():
    rng = random.Random(4)
    runs = [sorted("".join(rng.choice("ab") for _ in range(rng.randrange(12))).encode() for _ in range(rng.randrange(30))) for _ in range(7)]

    def coded(run):
        before = b""
        for line in run:
            yield line, S.common(before, line, 0), ()
            before = line

    merged = list(S.LoserTree([coded(run) for run in runs]))
    assert [line for line, _, _ in merged] == sorted(x for run in runs for x in run)
    for (a, _, _), (b, shared, _) in zip(merged, merged[1:], strict=False):
        assert shared == S.common(a, b, 0)
