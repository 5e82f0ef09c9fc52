import hashlib
import random
from array import array

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from silofeed.llm import bpe
from silofeed.llm.workers import tokenizer_file

from .conftest import TEXTS


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file(bpe.VOCABULARY))


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(tokenizer_file(bpe.VOCABULARY))


def test_random_texts(library, encoder):
    rng = random.Random(3)
    bits = ["a", "the", "b", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "é", "ß", "中", "1", "²", "'s", "'ll", "!", "#",
            "<|endoftext|>", "́", "😀", "\r\n", "\x00", "Զ", "Ա"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    for text, packed in zip(texts, encoder.encode_all(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert list(array("I", packed)) == expected, repr(text)
        assert encoder.decode(packed) == library.decode(expected, skip_special_tokens=False)


def test_all_lengths_and_long_words(library, encoder):
    texts = ["ab" * n for n in range(1, 60)] + ["z" * 5000, "0123456789" * 30, "ciónmente" * 20]
    assert [list(array("I", p)) for p in encoder.encode_all(texts)] == [library.encode(t).ids for t in texts]


def test_words_are_forgotten_at_the_bound(library, encoder, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "TOGETHER", 5)
    texts = ["one two three", "two three four", "five six", "one two three"]
    assert [list(array("I", p)) for p in encoder.encode_all(texts)] == [library.encode(t).ids for t in texts]


def test_given_documents(docs, texts, library):
    for r in bpe.digests(docs).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_round_trip_of_messy_rows(messy):
    back = bpe.decode(bpe.encode(messy))
    assert back.columns == ["doc_id", "text"]
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(((i, t or "") for i, t in TEXTS), key=repr)


def test_null_ids_and_empty_table(spark, nothing):
    assert bpe.decode(spark.createDataFrame([(None,)], "ids binary")).first()["text"] is None
    assert bpe.encode(nothing).count() == 0 and bpe.digests(nothing).select(F.count("*")).first()[0] == 0
