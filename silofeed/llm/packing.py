"""Packing of documents into sequences as a cutting-stock problem, solved by column generation.

Whole sequences are cut off long documents first. What is left of each document has a length below the sequence's; these
lengths form a histogram of fixed size. A linear program over patterns, each a multiset of length classes that fills a
sequence, says how often to use which pattern. Patterns are generated as columns: a knapsack over the classes, priced by
the program's duals, gives the one that helps most. The counts are rounded down, and the documents of a class, ranked by
counting, take the places that the patterns have for it. A document that is longer than its class has its end cut off
where its sequence ends; ends and documents without a place follow each other in further sequences. The last of these is
split by powers of two, which need no padding.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import remove_folder
from .tables import passing, scratch, short_batches, stored, written
from .workers import importable, tokenizer_file

VOCABULARY = "word_bpe_49k.json"
#: Id after each document, and tokens of a sequence.
SEPARATOR = 2
SEQUENCE = 4096
#: Length classes of the histogram.
CLASSES = 256
#: Simplex steps; fewer than the program needs cost patterns, not correctness.
STEPS = 4000
#: Words that a worker remembers with their ids before it starts over, twice.
REMEMBERED = 3 << 17
#: Bytes of texts that are encoded together, and new words that one call of the library encodes.
TOGETHER = 1 << 22
AT_ONCE = 1 << 15
#: Rows of a batch that are worked on at once.
ROWS = 500


class WordCoder:
    """Ids of texts by a vocabulary of the tokenizers library that drops white space.

    Many texts are cut into words together, so that a word is looked up once for all of them. The library encodes the
    words that are new in a few calls, with a mark between them that has an id of its own. Spellings in capitals share an
    entry where lowering is plain, and a word with marks behind it that of the word.
    """

    #: Texts that go to the library as a whole: with its own tokens, the mark, or what only Python takes as white space.
    IRREGULAR = r"<\||[\x01\x1c-\x1f]"
    #: Letters whose case and composition may depend on what stands around them, and white space that is not ASCII's.
    WIDE = r"[^\x00-\x{84}\x{86}-\x{9f}\x{a1}-\x{ff}]"
    #: Letters that are one word for the library, in the form that it gives them.
    LETTERS = re.compile(r"[a-zß-öø-ÿ]+")
    LAST = frozenset(filter(LETTERS.fullmatch, map(chr, range(256))))
    #: Marks that are words of their own behind letters, however many there are.
    BEHIND = ".,;:!?#$%&*"

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        #: The same for words of letters, which need no changes but that of their bytes into the vocabulary's letters.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        for each in (self.library, self.plain):
            each.no_truncation()
            each.no_padding()
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        #: What is written for the bytes of a letter; none of it is such a letter again.
        self.letters = {c: level.pre_tokenize_str(c)[0][0] for c in self.LAST if not c.isascii()}
        self.marks = np.isin(np.arange(256), np.frombuffer(self.BEHIND.encode(), np.uint8))
        #: Ids of words; what was known before the last start-over and is met again is taken from there.
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def forget(self) -> None:
        """Gives back the space of all words and of Arrow's arrays; a worker that waits for other work would hold it."""
        self.known, self.older = {"": b""}, {}
        pa.default_memory_pool().release_unused()

    def whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def words(self, library, words: list[str], mark: str) -> Iterator[bytes]:
        """Ids of each of many words; none holds the mark."""
        between = library.encode(mark, add_special_tokens=False).ids
        for at in range(0, len(words), AT_ONCE):
            some = words[at : at + AT_ONCE]
            joined = f" {mark} ".join(some)
            if library is self.plain and not joined.isascii():
                for letter, written_as in self.letters.items():
                    joined = joined.replace(letter, written_as)
            ids = np.array(library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(ids == between[0]) if len(between) == 1 else ()
            if len(stops) == len(some) - 1:
                packed, stops = ids.tobytes(), [4 * stop for stop in stops]
                yield from (packed[i:j] for i, j in zip([0, *(s + 4 for s in stops)], [*stops, len(packed)], strict=True))
            else:
                yield from map(self.whole, some)

    def learn(self, unseen: set[str]) -> None:
        """Adds words to what is known."""
        old = [word for word in unseen if word in self.older]
        self.known.update((word, self.older[word]) for word in old)
        unseen.difference_update(old)
        letters = [word for word in unseen if self.LETTERS.fullmatch(word)]
        others = list(unseen.difference(letters))
        self.known.update(zip(letters, self.words(self.plain, letters, "!"), strict=True))
        self.known.update(zip(others, self.words(self.library, others, "\x01"), strict=True))

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of each of many different words of regular texts."""
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {"": b""}
        known = self.known
        found = list(map(known.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        new = {words[i] for i in missing}
        # Words with marks behind them, cut after the last letter that is surely one for the library.
        marked = {chunk: word for chunk in new if (word := chunk.rstrip(self.BEHIND)) != chunk and word[-1:] in self.LAST}
        new.difference_update(marked)
        new.update(filterfalse(known.__contains__, marked.values()))
        new.update({chunk[len(word):] for chunk, word in marked.items()}.difference(known))
        self.learn(new)
        for i in missing:
            chunk = words[i]
            word = marked.get(chunk, chunk)
            found[i] = known[word] if word is chunk else known[word] + known[chunk[len(word):]]
        return found

    def encode(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end to end, and how many each has; each text's are followed by ``end``."""
        texts = pc.fill_null(texts, "")
        irregular = pc.match_substring_regex(texts, self.IRREGULAR)
        regular = pc.if_else(irregular, "", texts)
        wide = pc.match_substring_regex(regular, self.WIDE)
        spaced = [" ".join(text.split()) for text in regular.filter(wide).to_pylist()]
        lowered = pc.replace_with_mask(pc.utf8_lower(regular), wide, pa.array(spaced, texts.type))
        cut = pc.ascii_split_whitespace(self._apart(lowered))
        coded = cut.flatten().dictionary_encode()
        wholes = [self.whole(text) for text in texts.filter(irregular).to_pylist()]
        entries = [*self.ids_of(coded.dictionary.to_pandas(deduplicate_objects=False).tolist()), end, *(ids + end for ids in wholes)]
        # Behind each text's words stands the entry of the end, or that of an irregular text as a whole.
        last = np.full(len(texts), len(coded.dictionary))
        last[irregular.to_numpy(zero_copy_only=False)] += np.arange(1, len(wholes) + 1)
        codes = np.insert(coded.indices.to_numpy(), np.cumsum(pc.list_value_length(cut).to_numpy()), last)
        sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[codes]
        before = np.concatenate([[0], np.cumsum(lengths)])
        ids = np.frombuffer(b"".join(entries), "<u4")[np.repeat(starts[codes] - before[:-1], lengths) + np.arange(before[-1])]
        stops = before[np.cumsum(pc.list_value_length(cut).to_numpy().astype(np.int64) + 1)]
        return ids, np.diff(stops, prepend=0)

    def _apart(self, texts: pa.Array) -> pa.Array:
        """Texts with a space between each letter from a to z and marks behind it, where the library cuts anyway."""
        _, offsets, held = texts.buffers()
        if held is None or not held.size:
            return texts
        ends = np.frombuffer(offsets, "<i4")[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(held, np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        at = np.flatnonzero(self.marks[data[1:]] & (data[:-1] >= ord("a")) & (data[:-1] <= ord("z"))) + 1
        data = np.insert(data, at, ord(" "))
        ends = (ends + np.searchsorted(at, ends)).astype(np.int32)
        return pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(data))

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        for some in _portions(pa.array(texts, pa.string())):
            ids, sizes = self.encode(some)
            for stop, size in zip(np.cumsum(sizes).tolist(), sizes.tolist(), strict=True):
                yield ids[stop - size : stop].tobytes()


def _portions(texts: pa.Array) -> Iterator[pa.Array]:
    """Texts by about so many bytes at a time that are encoded together; a longer one is alone, or the last of a portion."""
    stops = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = np.flatnonzero(np.diff(stops // TOGETHER)) + 1
    for at, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)], strict=True):
        yield texts.slice(at, stop - at)


@lru_cache(maxsize=2)
def coder(path: str) -> WordCoder:
    return WordCoder(path)


def tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``row`` (a number of each row), ``id``, ``n`` (ids) and ``ids``, packed as unsigned 32-bit integers, as a table.

    Each text's ids are followed by the separator. Null text is the empty one.
    """
    spark = docs.sparkSession
    importable(spark)
    path = vocabulary or tokenizer_file(VOCABULARY)
    end = np.array([SEPARATOR], "<u4").tobytes()

    def packed(words: WordCoder, some: pa.Array) -> pa.Array:
        ids, sizes = words.encode(some, end)
        ends = np.concatenate([[0], 4 * np.cumsum(sizes)])
        if ends[-1] < 1 << 31:
            return pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids)])
        return pa.array([ids[i // 4 : j // 4].tobytes() for i, j in itertools.pairwise(ends.tolist())], pa.binary())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = coder(path)
        try:
            for batch in batches:
                at = 0
                for some in _portions(batch.column(1)):
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(some)), packed(words, some)], ["id", "ids"])
                    at += len(some)
        finally:
            words.forget()

    kind = docs.schema[id_col].dataType.simpleString()
    encoded = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(each, f"id {kind}, ids binary")
    with short_batches(spark):
        return written(encoded.select(
            F.monotonically_increasing_id().alias("row"), "id", (F.octet_length("ids") / 4).cast("long").alias("n"), "ids",
        ), "tokens")


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch by a few rows at a time, so that little of it is there twice."""
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


def cheapest_fill(prices: np.ndarray, capacity: int) -> np.ndarray | None:
    """The multiset of sizes 1, 2, ... that sums to the capacity at the least price, as counts; null if none does.

    ``prices[i]`` is that of size ``i + 1``; sizes that are not there cost infinitely much.
    """
    best = np.full(capacity + 1, np.inf)
    best[0] = 0
    last = np.zeros(capacity + 1, np.int64)
    for filled in range(1, capacity + 1):
        sizes = min(filled, len(prices))
        cost = best[filled - sizes : filled][::-1] + prices[:sizes]
        last[filled] = cost.argmin()
        best[filled] = cost[last[filled]]
    if not np.isfinite(best[capacity]):
        return None
    counts = np.zeros(len(prices), np.int64)
    filled = capacity
    while filled:
        counts[last[filled]] += 1
        filled -= last[filled] + 1
    return counts


def patterns(histogram: np.ndarray, capacity: int, steps: int = STEPS) -> list[tuple[np.ndarray, int]]:
    """Patterns (counts by size 1, 2, ...) and how often to use each, within the histogram of sizes.

    Maximises the number of filled sequences by the revised simplex method with columns made on demand, and rounds down.
    """
    there = np.flatnonzero(histogram)
    rows = len(there)
    if not rows:
        return []
    inverse = np.eye(rows)
    value = histogram[there].astype(float)
    gain = np.zeros(rows)  # of the basic columns: 1 for a pattern, 0 for a slack
    basis: list[np.ndarray | None] = [None] * rows
    for _ in range(steps):
        duals = gain @ inverse
        if duals.min() < -1e-9:
            entering, pattern = np.eye(rows)[duals.argmin()], None
        else:
            prices = np.full(len(histogram), np.inf)
            prices[there] = np.maximum(duals, 0)
            pattern = cheapest_fill(prices, capacity)
            if pattern is None or pattern[there] @ duals > 1 - 1e-7:
                break
            entering = pattern[there].astype(float)
        column = inverse @ entering
        positive = column > 1e-9
        if not positive.any():
            break
        ratio = np.where(positive, value / np.where(positive, column, 1), np.inf)
        leaving = int(ratio.argmin())
        pivot = inverse[leaving] / column[leaving]
        step = value[leaving] / column[leaving]
        inverse -= np.outer(column, pivot)
        inverse[leaving] = pivot
        value = np.maximum(value - step * column, 0)
        value[leaving] = step
        gain[leaving], basis[leaving] = float(pattern is not None), pattern
    used = [(p, int(v + 1e-6)) for p, v in zip(basis, value, strict=True) if p is not None and v + 1e-6 >= 1]
    return _within(used, histogram)


def _within(used: list[tuple[np.ndarray, int]], histogram: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """The patterns as often as the histogram truly allows, whatever rounding errors the program has made."""
    left, sure = histogram.astype(np.int64).copy(), []
    for pattern, times in used:
        needed = pattern > 0
        times = int(min(times, (left[needed] // pattern[needed]).min()))
        if times:
            left -= times * pattern
            sure.append((pattern, times))
    return sure


class Places:
    """Which sequence and slot the document of a given class and rank takes."""

    def __init__(self, chosen: list[tuple[np.ndarray, int]]) -> None:
        blocks, taken, first = [], {}, 0
        for pattern, times in chosen:
            slot = 0
            for size in np.flatnonzero(pattern) + 1:  # longer pieces last: the end of the last one is cut off
                many = int(pattern[size - 1])
                start = taken.get(size, 0)
                blocks.append((int(size), start, many * times, many, first, slot))
                taken[size] = start + many * times
                slot += many
            first += times
        self.sequences = first
        self.blocks = np.array(sorted(blocks), np.int64).reshape(-1, 6)
        self.keys = self.blocks[:, 0] << 44 | self.blocks[:, 1]

    def find(self, sizes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence, or -1, and slot."""
        if not len(self.keys):
            return np.full(len(sizes), -1), np.zeros(len(sizes), np.int64)
        block = self.blocks[np.maximum(np.searchsorted(self.keys, sizes << 44 | ranks, side="right") - 1, 0)]
        size, start, length, many, first, slot = block.T
        at = ranks - start
        inside = (size == sizes) & (at >= 0) & (at < length)
        return np.where(inside, first + at // many, -1), slot + at % many


def running_sum(rows: DataFrame, value: str, group: list[str], name: str, order: list[str]) -> DataFrame:
    """Adds the sum of ``value`` over all earlier rows of a group; earlier by ``part``, then ``order``.

    Sums within a part need the rows of that part only; sums over parts need one row for each part.
    """
    within = Window.partitionBy("part", *group).orderBy(*order)
    parts = rows.groupBy("part", *group).agg(F.sum(value).alias("of_part"))
    over = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))).orderBy("part")
    before = parts.select("part", *group, (F.sum("of_part").over(over) - F.col("of_part")).alias("before"))
    summed = rows.withColumn("inside", F.sum(value).over(within) - F.col(value))
    return summed.join(before, ["part", *group]).withColumn(name, F.col("before") + F.col("inside")).drop("before", "inside")


PIECE = pa.schema([(n, pa.int64()) for n in (
    "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "row")])


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE,
         classes: int = CLASSES, vocabulary: str | None = None) -> DataFrame:
    """Pieces of all documents: where each lies in its document and in its sequence.

    ``row`` tells rows apart that repeat an id. Null text is the empty one, whose only id is the separator. Null ids
    are packed like others. An empty table gives no rows.
    """
    with scratch(), short_batches(docs.sparkSession):
        pieces, folder = stored(_packed(docs, id_col, text_col, sequence, classes, vocabulary), "pieces")
    passing(docs.sparkSession, folder)
    return pieces.withColumnRenamed("doc_id", id_col) if id_col != "doc_id" else pieces


def _packed(docs: DataFrame, id_col: str, text_col: str, sequence: int, classes: int, vocabulary: str | None) -> DataFrame:
    """Pieces, not run yet; their tables last as long as the scope."""
    table = tokens(docs, id_col, text_col, vocabulary)
    spark = docs.sparkSession
    width = sequence // classes
    narrow = table.select(
        "row", "n", F.shiftright("row", 33).alias("part"), F.floor(F.col("n") / sequence).alias("full"),
        F.pmod("n", F.lit(sequence)).alias("rest"),
    ).withColumn("size", F.floor(F.col("rest") / width)).withColumn("one", F.lit(1).cast("long"))

    counted = narrow.where("size > 0").groupBy("size").count().collect()  # at most one row for each class
    histogram = np.zeros(classes - 1, np.int64)
    for r in counted:
        histogram[r["size"] - 1] = r["count"]
    places = Places(patterns(histogram, classes))

    @F.pandas_udf("sequence long, slot long")
    def place(sizes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        found, slot = places.find(sizes.to_numpy(np.int64), ranks.to_numpy(np.int64))
        return pd.DataFrame({"sequence": found, "slot": slot})

    ranked = running_sum(running_sum(narrow, "one", ["size"], "rank", ["row"]), "full", [], "full_before", ["row"])
    placed, places_folder = stored(ranked.select("row", "part", "n", "full", "full_before", "rest", place("size", "rank").alias("at")).select(
        "row", "part", "n", "full", "full_before", "rest", "at.sequence", "at.slot"), "places")

    # A sequence has no more pieces than classes, so its window is small.
    start = F.sum("rest").over(Window.partitionBy("sequence").orderBy("slot")) - F.col("rest")
    seated = placed.where("sequence >= 0").withColumn("offset", start)
    stood = placed.where("sequence < 0").withColumn("offset", F.lit(sequence).cast("long"))
    kept = F.greatest(F.lit(0).cast("long"), F.least(F.col("rest"), F.lit(sequence) - F.col("offset")))
    cut = seated.unionByName(stood).withColumn("kept", kept).withColumn("over", F.col("rest") - F.col("kept"))
    plan = written(running_sum(cut, "over", [], "over_before", ["row"]).select(
        "row", "full", "full_before", "sequence", "offset", "kept", "over", "over_before"), "plan")
    remove_folder(spark, places_folder)

    totals = plan.agg(F.sum("full"), F.sum("over")).first()
    full_total, over_total = totals[0] or 0, totals[1] or 0
    first_full, first_over = places.sequences, places.sequences + full_total
    ends = _ends(over_total, sequence)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _slices(batch):
                out = [p for r in some.to_pylist() for p in _pieces(r, sequence, first_full, first_over, ends)]
                if out:
                    columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, schema=PIECE)

    return table.join(plan, "row").mapInArrow(emit, ", ".join(f"{f.name} long" for f in PIECE))


def _ends(total: int, sequence: int) -> list[int]:
    """Where the full sequences of what is laid end to end stop, then the ends of one for each power of two left."""
    at = total // sequence * sequence
    ends = [at]
    for power in reversed(range(sequence.bit_length())):
        if (total % sequence) >> power & 1:
            at += 1 << power
            ends.append(at)
    return ends


def _pieces(r: dict, sequence: int, first_full: int, first_over: int, ends: list[int]) -> Iterator[tuple]:
    ids = r["ids"]

    def piece(start: int, length: int, where: int, offset: int) -> tuple:
        return r["id"], start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), r["n"], where, offset, r["row"]

    for i in range(r["full"]):
        yield piece(i * sequence, sequence, first_full + r["full_before"] + i, 0)
    start = r["full"] * sequence
    if r["kept"]:
        yield piece(start, r["kept"], r["sequence"], r["offset"])
    start += r["kept"]
    at, stop = r["over_before"], r["over_before"] + r["over"]
    while at < stop:
        number = at // sequence
        begin, end = number * sequence, (number + 1) * sequence
        if begin == ends[0]:
            last = next(i for i, e in enumerate(ends[1:]) if at < e)
            number, begin, end = number + last, ends[last], ends[last + 1]
        length = min(stop, end) - at
        yield piece(start, length, first_over + number, at - begin)
        start, at = start + length, at + length
