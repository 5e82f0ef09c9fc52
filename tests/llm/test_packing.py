import itertools
import random
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from silofeed.llm import packing as P
from silofeed.llm import tables
from silofeed.llm.workers import tokenizer_file
from silofeed.workspace import folder_exists

from .conftest import TEXTS


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file(P.VOCABULARY))


def check(pieces, rows, library, sequence=P.SEQUENCE):
    """Every id in one piece, sequences without gaps; the padding. Rows of one id are told apart by ``row``."""
    expected = sorted(tuple(library.encode(t or "", add_special_tokens=False).ids) + (P.SEPARATOR,) for _, t in rows)
    by_row, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_row[p["row"], p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert sorted((i for _, i in by_row), key=repr) == sorted((i for i, _ in rows), key=repr)
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(library.encode(t or "", add_special_tokens=False).ids + [P.SEPARATOR])
    for (_, i), own in by_row.items():
        own.sort(key=lambda p: p["start"])
        assert [p["start"] for p in own] == [0, *itertools.accumulate(p["length"] for p in own)][:-1]
        crcs = [(p["start"], p["length"], p["ids_crc32"]) for p in own]
        assert any(all(zlib.crc32(array("I", ids[s : s + n]).tobytes()) == c for s, n, c in crcs)
                   and len(ids) == own[0]["doc_tokens"] == sum(p["length"] for p in own) for ids in texts[i])
    padding = 0
    for own in by_sequence.values():
        own.sort(key=lambda p: p["offset"])
        ends = list(itertools.accumulate(p["length"] for p in own))
        assert [p["offset"] for p in own] == [0, *ends][:-1] and ends[-1] <= sequence
        padding += 0 if ends[-1] & (ends[-1] - 1) == 0 else sequence - ends[-1]
    assert sum(p["length"] for p in pieces) == sum(map(len, expected))
    return padding


def test_given_documents(docs, texts, library):
    assert check(P.pack(docs).collect(), list(texts.items()), library) == 0


@pytest.mark.parametrize("sequence, classes", [(64, 16), (1024, 256)])
def test_messy_rows(messy, library, sequence, classes):
    assert check(P.pack(messy, sequence=sequence, classes=classes).collect(), TEXTS, library, sequence) == 0


def test_equal_lengths(spark, library):
    rows = [(i, "the cat sat on the mat") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert check(P.pack(df, sequence=64, classes=16).collect(), rows, library, 64) == 0


def test_empty_table(nothing):
    assert P.pack(nothing).count() == 0


def test_ids_are_those_of_the_library(library):
    rng = random.Random(9)
    bits = ["a", "Straße", "ΣΑΣ", "İ", "é", " ", "  ", "\n", "\x1c", "\x85", "'s", "12", "!?", "<|endoftext|>", "<|", "中", "ﬁ", " ", "A."]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    found = P.WordCoder(tokenizer_file(P.VOCABULARY)).encode_all(texts)
    for text, ids in zip(texts, found, strict=True):
        assert list(array("I", ids)) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_of_many_texts_are_looked_up_once(library, monkeypatch):
    monkeypatch.setattr(P, "TOGETHER", 2000)
    rng = random.Random(4)
    bits = ["cat", "Öl", "été", "straße", "don't", "a1b2", "x.y", " ", " ", "\n", ".", "...", "$$$", ",***", ".'s", "ÿ!", "\xa0", "中", "ΣΑΣ", "aΣ", "a.Σ", "İ.", "e\u0301", "\x85", "\u3000", "<|endoftext|>"]
    texts = [None, "", " ", "***", *("".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(500)), ".end", None]
    coder, end = P.WordCoder(tokenizer_file(P.VOCABULARY)), np.array([P.SEPARATOR], "<u4").tobytes()
    found = []
    for some in P._portions(pa.array(texts)):
        ids, sizes = coder.encode(some, end)
        found += [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert found == [[*library.encode(t or "", add_special_tokens=False).ids, P.SEPARATOR] for t in texts]

    coder.forget()  # what a task does at its end
    assert coder.known == {"": b""} and not coder.older
    assert [list(array("I", ids)) for ids in coder.encode_all(["été, cat"])] == [library.encode("été, cat", add_special_tokens=False).ids]

    asked = []
    monkeypatch.setattr(coder, "ids_of", lambda words: asked.append(sorted(words)) or [b""] * len(words))
    coder.encode(pa.array(["cat. cat, Cat *** cat..."] * 50))
    assert asked == [["***", ",", ".", "...", "cat"]]


def test_cheapest_fill_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(200):
        prices = np.where(rng.random(6) < 0.3, np.inf, rng.random(6))
        best = min((sum(c * p for c, p in zip(n, prices, strict=True) if c)
                    for n in itertools.product(*[range(9 // s + 1) for s in range(1, 7)]) if sum(c * s for c, s in zip(n, range(1, 7), strict=True)) == 9),
                   default=np.inf)
        found = P.cheapest_fill(prices, 9)
        assert (found is None) == np.isinf(best)
        if found is not None:
            assert found @ np.arange(1, 7) == 9 and np.isclose(prices[found > 0] @ found[found > 0], best)


def test_patterns_fill_sequences_within_the_histogram():
    histogram = np.full(63, 300)
    chosen = P.patterns(histogram, 64)
    used = sum(pattern * times for pattern, times in chosen)
    assert all(pattern @ np.arange(1, 64) == 64 for pattern, _ in chosen) and (used <= histogram).all()
    # Rounding costs less than one sequence for each class.
    assert sum(times for _, times in chosen) >= histogram @ np.arange(1, 64) / 64 - 64
    assert P.patterns(np.zeros(63, np.int64), 64) == []


def test_places_are_taken_once():
    chosen = P.patterns(np.random.default_rng(3).integers(0, 50, 15), 16)
    places = P.Places(chosen)
    taken = defaultdict(list)
    for size in range(1, 16):
        sequence, slot = places.find(np.full(60, size), np.arange(60))
        for q, s in zip(sequence, slot, strict=True):
            if q >= 0:
                taken[int(q)].append((int(s), size))
    assert len(taken) == places.sequences
    assert all(sum(n for _, n in t) == 16 and [s for s, _ in sorted(t)] == list(range(len(t))) for t in taken.values())


def test_workers_get_few_rows_at_once_and_tables_go(spark, docs, texts, library, monkeypatch):
    def asked():
        return spark.conf.get(tables.BATCH_SETTING, None)

    def spy(df, purpose, *rest):
        table, folder = stored(df, purpose, *rest)
        seen[purpose] = asked(), folder
        return table, folder

    before, seen, stored = asked(), {}, tables.stored
    monkeypatch.setattr(tables, "stored", spy)
    monkeypatch.setattr(P, "stored", spy)
    pieces = P.pack(docs)
    assert seen["tokens"][0] == seen["pieces"][0] == str(tables.BATCH_ROWS) and asked() == before
    assert {purpose for purpose, (_, folder) in seen.items() if folder_exists(spark, folder)} == {"pieces"}
    assert check(pieces.collect(), list(texts.items()), library) == 0


def test_a_coder_that_forgets_gives_the_same(library):
    words = P.WordCoder(tokenizer_file(P.VOCABULARY))
    first = list(words.encode_all([t or "" for _, t in TEXTS]))
    words.forget()
    assert not words.known.keys() - {""} and not words.older
    assert first == list(words.encode_all([t or "" for _, t in TEXTS]))
