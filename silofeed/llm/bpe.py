"""Byte-level BPE on contiguous rank arrays.

A word is a list of parts with, beside it, the list of the ranks of its adjacent pairs. The smallest rank is found by a
scan, the boundary behind it deleted, and the two ranks beside it refreshed, until no pair has a rank. Words are short,
so the scan over an array beats a heap.

The vocabulary is a file of the tokenizers library; its path is a parameter and it is read by each Python worker.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from .workers import importable, tokenizer_file

VOCABULARY = "byte_bpe_50k.json"

#: White space as Unicode lists it; str.isspace() also takes the four separators from 1C to 1F.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: the pattern that splits text before the merges.
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
#: A blank after white space: only there can a blank be other than the start of a word.
DOUBLE_SPACE = rf"[{SPACE}] |^ "
#: Outside these blocks letters and digits depend on the version of Unicode; there the library cuts the words.
SETTLED = r"\u0000-\u0527\u2000-\u2064"

#: Chunks and words that a worker remembers with their ids before it starts over.
REMEMBERED = 3 << 17
#: Longer words and chunks are not remembered; longer words are merged one by one.
SHORT = 40
#: Characters of text whose new words are merged together, and rows of a rank array.
TOGETHER = 1 << 20
ROWS = 1 << 13
NO_RANK = (1 << 31) - 1


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes as such, then from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


class Encoder:
    """Encodes and decodes with one vocabulary. Ids are packed as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"]
        letters = byte_letters()
        self.first = np.array([vocabulary[letter] for letter in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        pairs = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in merges], np.int64)
        #: Id of the merged part by rank, and ranks by pair, sorted for look-ups.
        self.merged = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        self.rank_of = np.argsort(pairs).astype(np.int32)
        self.pairs = pairs[self.rank_of]
        value = {letter: b for b, letter in enumerate(letters)}
        self.bytes_of = {i: bytes(value[c] for c in token) for token, i in vocabulary.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.bytes_of |= {i: text.encode() for text, i in self.special.items()}
        self.words = regex.compile(WORDS)
        self.letter_bytes = value
        self.unsettled = re.compile(rf"[^{SETTLED}]")
        self.cut_words = ByteLevel(add_prefix_space=False, use_regex=True)
        self.double_space = re.compile(DOUBLE_SPACE)
        self.word_ends = re.compile(rf"(?<=[^{SPACE}])(?=[{SPACE}])")
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.chunk_ids: dict[str, bytes] = {}
        self.word_ids: dict[str, bytes] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.rank_of[at], NO_RANK)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that are not empty. Row by row: parts and, contiguous, the ranks of adjacent parts."""
        length = np.array([len(w) for w in words])
        width = int(length.max())
        padded = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        parts = self.first[padded]
        columns = np.arange(width)
        ranks = np.full((len(words), width), NO_RANK, np.int32)
        if width > 1:
            ranks[:, :-1] = self.ranks(parts[:, :-1], parts[:, 1:])
            ranks[columns >= (length - 1)[:, None]] = NO_RANK
        row = np.arange(len(words))
        live, live_parts, live_ranks = row, parts, ranks
        while len(live):
            at = live_ranks.argmin(axis=1)
            least = live_ranks[np.arange(len(live)), at]
            on = least != NO_RANK
            if not on.all():
                parts[live] = live_parts
                live, live_parts, live_ranks, at, least = live[on], live_parts[on], live_ranks[on], at[on], least[on]
                if not len(live):
                    break
            r = np.arange(len(live))
            # Delete the boundary behind the smallest rank, then refresh the ranks on both sides.
            moved = np.minimum(columns + (columns > at[:, None]), width - 1)
            live_parts = np.take_along_axis(live_parts, moved, 1)
            live_ranks = np.take_along_axis(live_ranks, np.minimum(columns + (columns >= at[:, None]), width - 1), 1)
            live_ranks[:, -1] = NO_RANK
            live_parts[r, at] = self.merged[least]
            length[live] -= 1
            before = at > 0
            live_ranks[r[before], at[before] - 1] = self.ranks(
                live_parts[r[before], at[before] - 1], live_parts[r[before], at[before]])
            after = at + 1 < length[live]
            live_ranks[r[after], at[after]] = self.ranks(
                live_parts[r[after], at[after]], live_parts[r[after], at[after] + 1])
            ends = ~after
            live_ranks[r[ends], at[ends]] = NO_RANK
        packed, ends = parts.astype("<u4"), length * 4
        width *= 4
        rows = packed.tobytes()
        return [rows[i * width : i * width + n] for i, n in enumerate(ends.tolist())]

    def learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of chunks; those of short ones and of their words are remembered."""
        known = self.chunk_ids
        fresh = {chunk: self.words_of(chunk) for chunk in chunks if chunk not in known}
        new = {word for words in fresh.values() for word in words if word not in self.word_ids}
        by_length = sorted((word.encode("utf-8", "replace"), word) for word in new)
        by_length.sort(key=lambda pair: len(pair[0]))
        found: dict[str, bytes] = {}
        short = [pair for pair in by_length if len(pair[0]) <= SHORT]
        for at in range(0, len(short), ROWS):
            some = short[at : at + ROWS]
            self.word_ids.update(zip((w for _, w in some), self.merge([b for b, _ in some]), strict=True))
        for encoded, word in by_length[len(short) :]:
            found[word] = self.merge([encoded])[0]
        once: dict[str, bytes] = {}
        for chunk, words in fresh.items():
            ids = b"".join([self.word_ids[w] if w in self.word_ids else found[w] for w in words])
            (known if len(chunk) <= SHORT else once)[chunk] = ids
        return once

    def words_of(self, chunk: str) -> list[str]:
        if not self.unsettled.search(chunk):
            return self.words.findall(chunk)
        words = [word for word, _ in self.cut_words.pre_tokenize_str(chunk)]
        return [bytes(self.letter_bytes[c] for c in word).decode() for word in words]

    def chunks(self, text: str) -> list[str]:
        """The text cut before blanks where no word reaches over: behind what is not white space."""
        if self.double_space.search(text):
            return self.word_ends.split(text)
        first, *rest = text.split(" ")
        return [first, *[" " + chunk for chunk in rest]]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        some: list[str] = []
        size = 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size >= TOGETHER:
                out += self._encode(some)
                some, size = [], 0
        return out + self._encode(some)

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.chunk_ids) + len(self.word_ids) > REMEMBERED:
            self.chunk_ids.clear()
            self.word_ids.clear()
        cut: list[list[str]] = []
        for text in texts:
            if self.at_special is None or not self.at_special.search(text):
                cut.append(self.chunks(text) if text else [])
                continue
            parts = self.at_special.split(text)
            cut.append([c for i, p in enumerate(parts) if p for c in ([p] if i % 2 else self.chunks(p))])
        unseen: set[str] = set()
        for chunks in cut:
            unseen.update(chunks)
        once = self.learn(unseen - self.special.keys())
        once.update((text, np.uint32(i).tobytes()) for text, i in self.special.items())
        ids = self.chunk_ids
        return [b"".join([ids[c] if c in ids else once[c] for c in chunks]) for chunks in cut]

    def decode(self, packed: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, array("I", packed))).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker and vocabulary."""
    return Encoder(path)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Id and ``ids`` (little-endian unsigned 32-bit integers) of each row.

    Null text has no ids, as the empty one. Strings of special tokens in a text become those tokens, as in the library
    by default. Repeated rows are encoded each; other columns are ignored; an empty table gives no rows.
    """
    importable(docs.sparkSession)
    path = vocabulary or tokenizer_file(VOCABULARY)

    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = encoder(path)
        for texts in batches:
            yield pd.Series(coder.encode_all([t or "" for t in texts]), dtype=object)

    return docs.select(F.col(id_col), F.pandas_udf(each, "binary")(F.col(text_col)).alias("ids"))


def decode(encoded: DataFrame, ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``text`` of the packed ids, in place of them; null ids give null. An unknown id is an error."""
    importable(encoded.sparkSession)
    path = vocabulary or tokenizer_file(VOCABULARY)

    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = encoder(path)
        for packed in batches:
            yield pd.Series([None if p is None else coder.decode(p) for p in packed], dtype=object)

    text = F.pandas_udf(each, "string")(F.col(ids_col)).alias("text")
    return encoded.select(*[c for c in encoded.columns if c != ids_col], text)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of each row: a round trip that moves no ids."""
    importable(docs.sparkSession)
    path = vocabulary or tokenizer_file(VOCABULARY)

    def each(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = encoder(path)
        for texts in batches:
            packed = coder.encode_all([t or "" for t in texts])
            yield pd.DataFrame({
                "n_tokens": [len(p) // 4 for p in packed],
                "ids_sha256": [hashlib.sha256(p).hexdigest() for p in packed],
                "decoded_sha256": [hashlib.sha256(coder.decode(p).encode("utf-8", "replace")).hexdigest() for p in packed],
            })

    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    found = F.pandas_udf(each, kind)(F.col(text_col)).alias("found")
    return docs.select(F.col(id_col), found).select(id_col, "found.*")
