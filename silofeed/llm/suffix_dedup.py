"""Repeated passages, found by a distributed merge sort of suffixes that knows common prefixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier. To sort every suffix would take a hundred
times the text, so suffixes are sampled where equal strings are sampled alike: each string of ``LENGTH`` bytes has an
anchor, its gram of ``GRAM`` bytes with the least hash. Strings that share an anchor are one item: the suffix from the
first of them to the end of the last.

1. Anchors whose gram occurs once are set aside by counting hashes. A task sends each gram once.
2. Each task sorts the items of the other anchors, joins equal ones, and sends front-coded runs to the buckets.
3. A bucket merges its runs in a loser tree that keeps the common prefix of each item with the last one out, so known
   prefixes are never compared again. Equal items stand together: all but the first are repeats. Items of one gram that
   differ are compared string by string; where there are too many for one task, each item is cut in two by the place of
   the gram in its strings, which gives longer grams, and the halves go through step 2 again.

A run holds an item once, so a passage that a third of all documents holds costs a bucket one item for each task.
"""

from __future__ import annotations

import gc
import hashlib
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import written
from .workers import importable

LENGTH = 100
GRAM = 32
#: Places of a gram in a string.
PLACES = LENGTH - GRAM + 1
#: Items that a task sorts together, and different items of one gram that are compared in one task.
RUN_ITEMS = 1 << 18
TOGETHER = 1 << 14
#: Anchors that a task counts together.
COUNTED = 1 << 20
LAST = (1 << 63) - 1

MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of each gram: of pairs, then of pairs of pairs, and so on."""
    h = (data.astype(np.uint64) + np.uint64(1)) * MIX
    width, factor = 1, 0xD6E8FEB86659FD93
    while width < GRAM:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor = factor * factor & ((1 << 64) - 1)
        width *= 2
    h ^= h >> np.uint64(32)
    h *= MIX
    return h ^ (h >> np.uint64(29))


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and place of each anchor, and the first and last start of the strings that have it; leftmost where tied."""
    if len(data) < LENGTH:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, none
    hashes = gram_hashes(data)
    least, place, width = hashes, np.arange(len(hashes), dtype=np.int32), 1
    while width < PLACES:
        step = min(width, PLACES - width)
        later = least[step:] < least[:-step]
        least = np.where(later, least[step:], least[:-step])
        place = np.where(later, place[step:], place[:-step])
        width += step
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], len(place)) - 1
    at = place[first].astype(np.int64)
    return hashes[at], at, first, last


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


# Step 1: anchors whose gram occurs more than once.


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``gram``, ``doc``, ``at``, ``sure``: one for each gram of the task, and the others, known to repeat, dealt out."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            gram, at, first, last = anchors(_bytes(text.as_py()))
            # The place, the gram's offset from the first string's start, and the number of further starts, in one number.
            held.append((gram, np.full(len(at), doc, np.int64), at << 14 | at - first << 7 | last - first))
            size += len(at)
            if size >= COUNTED:
                yield _counted(held)
                held, size = [], 0
    if held:
        yield _counted(held)


def _counted(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    gram, doc, at = (np.concatenate(x) for x in zip(*held, strict=True))
    _, first, which, count = np.unique(gram, return_index=True, return_inverse=True, return_counts=True)
    sure = count[which] > 1
    spread = sure.copy()
    spread[first] = False
    key = gram.copy()
    key[spread] = (doc[spread].astype(np.uint64) + at[spread].astype(np.uint64)) * MIX
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(doc), pa.array(at), pa.array(sure)],
        ["gram", "doc", "at", "sure"])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by gram, those that are sure or have a neighbour of the same gram."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        gram, doc, at, sure = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        if held is not None:
            gram, doc, at, sure = (np.concatenate([h, x]) for h, x in zip(held, (gram, doc, at, sure), strict=True))
        same = gram[1:] == gram[:-1]
        sure = sure.copy()
        sure[1:] |= same
        sure[:-1] |= same
        held = tuple(x[-1:] for x in (gram, doc, at, sure))
        keep = np.flatnonzero(sure[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(doc[keep]), pa.array(at[keep])], ["doc", "at"])
    if held is not None and held[3][0]:
        yield pa.RecordBatch.from_arrays([pa.array(held[1]), pa.array(held[2])], ["doc", "at"])


# Step 2: sorted runs. An item is (key, string, id, doc, start, place of the gram, low, high): of the strings that hold
# the gram at the places low to high, those that start in the item. Its key is the hash of what they all share.

Item = tuple[bytes, bytes, int, int, int, int, int, int]


def item(string: bytes, doc_id: int, doc: int, start: int, place: int, low: int, high: int) -> Item:
    shared = string[place - low if place > low else 0 : place + LENGTH - high]
    key = xxhash.xxh3_64_digest(shared, seed=low << 8 | high) if low or high < PLACES - 1 else xxhash.xxh3_64_digest(shared)
    return key, string, doc_id, doc, start, place, low, high


RUN = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("data", pa.binary()), ("numbers", pa.binary())])
RUN_TYPES = "bucket int, kind int, data binary, numbers binary"
ITEMS, REPEATS = 0, 1


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which the first bytes are known."""
    top = min(len(a), len(b))
    while known < top:
        step = min(32, top - known)
        x, y = a[known : known + step], b[known : known + step]
        if x != y:
            different = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return known + step - (different.bit_length() + 7) // 8
        known += step
    return top


def encoded_run(items: list[tuple[bytes, Item]]) -> tuple[bytes, bytes]:
    """Sorted items, each without what it shares with the one before."""
    tails, numbers, before = [], np.empty((len(items), 8), np.int64), b""
    for i, (line, x) in enumerate(items):
        shared = common(before, line, 0)
        tails.append(line[shared:])
        numbers[i] = shared, len(line) - shared, *x[2:]
        before = line
    pack = zstandard.ZstdCompressor(level=1).compress
    return pack(b"".join(tails)), pack(numbers.T.tobytes())


def decoded_run(data: bytes, numbers: bytes) -> Iterator[tuple[bytes, int, tuple[int, ...]]]:
    """Each item's line (key and string), its common prefix with the one before, and its numbers."""
    unpack = zstandard.ZstdDecompressor().decompress
    tails, table = unpack(data), np.frombuffer(unpack(numbers), np.int64).reshape(8, -1)
    line, at = b"", 0
    for shared, length, *rest in table.T.tolist():
        line = line[:shared] + tails[at : at + length]
        at += length
        yield line, shared, tuple(rest)


def _runs(items: list[Item], buckets: int) -> Iterator[pa.RecordBatch]:
    """One run for each bucket; equal items are joined, and all but the first of them are repeats."""
    lines = sorted(((x[0] + x[1], x) for x in items), key=lambda p: (p[0], p[1][2:5]))
    kept: list[tuple[bytes, Item]] = []
    repeats = []
    for line, x in lines:
        if kept and kept[-1][0] == line:
            if kept[-1][1][2:5] != x[2:5]:
                repeats.append((x[3], x[4], x[4] + len(x[1]) - LENGTH))
        else:
            kept.append((line, x))
    rows = []
    bounds = np.searchsorted(
        np.frombuffer(b"".join(line[:8] for line, _ in kept), ">u8"),
        [((i << 64) // buckets) for i in range(1, buckets)]) if kept else np.zeros(buckets - 1, np.int64)
    edges = [0, *bounds.tolist(), len(kept)]
    for bucket, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        if a < b:
            rows.append((bucket, ITEMS, *encoded_run(kept[a:b])))
    if repeats:
        rows.append((hash(repeats[0]) % buckets, REPEATS, b"", np.array(repeats, np.int64).T.tobytes()))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
        zip(*rows, strict=True) if rows else [[]] * 4, RUN.types, strict=True)], schema=RUN)


def _document_items(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[Item] = []
        for batch in batches:
            for doc_id, doc, text, wanted in zip(*(batch.column(i) for i in range(4)), strict=True):
                doc_id, doc, whole = doc_id.as_py(), doc.as_py(), _bytes(text.as_py()).tobytes()
                doc_id = LAST if doc_id is None else doc_id
                for packed in wanted.values.to_pylist():
                    at, place, starts = packed >> 14, packed >> 7 & 127, packed & 127
                    string = whole[at - place : at - place + starts + LENGTH]
                    items.append(item(string, doc_id, doc, at - place, place, 0, PLACES - 1))
                if len(items) >= RUN_ITEMS:
                    yield from _runs(items, buckets)
                    items = []
        yield from _runs(items, buckets)

    return run


def _halves(buckets: int):
    """Items of strings that hold the gram in the lower and in the upper half of an item's places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[Item] = []
        for batch in batches:
            for row in batch.to_pylist():
                doc_id, doc, start, place, low, high = (row[c] for c in ("id", "doc", "start", "place", "low", "high"))
                string, middle = row["string"], (row["low"] + row["high"]) // 2
                starts = len(string) - LENGTH  # the gram's place falls from `place` to `place - starts`
                for a, b in ((low, middle), (middle + 1, high)):
                    begin, end = max(0, place - b), min(starts, place - a)
                    if begin <= end:
                        items.append(item(string[begin : end + LENGTH], doc_id, doc, start + begin, place - begin, a, b))
            if len(items) >= RUN_ITEMS:
                yield from _runs(items, buckets)
                items = []
        yield from _runs(items, buckets)

    return run


# Step 3: merging runs.


class LoserTree:
    """Merges sorted runs. Each loser keeps the length of its common prefix with the winner that passed it.

    The contestant that shares more with the last winner is smaller, without a comparison; only equal lengths need one,
    from that length on.
    """

    def __init__(self, runs: list[Iterator[tuple[bytes, int, tuple[int, ...]]]]) -> None:
        self.runs = runs
        size = 1
        while size < len(runs):
            size *= 2
        self.size = size
        self.losers: list[tuple[bytes | None, int, tuple[int, ...], int]] = [(None, 0, (), -1)] * size
        self.winner = self._build(1)

    def _next(self, run: int) -> tuple[bytes | None, int, tuple[int, ...], int]:
        if run < len(self.runs) and (got := next(self.runs[run], None)) is not None:
            return (*got, run)
        return None, 0, (), run

    def _build(self, node: int):
        if node >= self.size:
            return self._next(node - self.size)
        won, lost = self._play(self._build(2 * node), self._build(2 * node + 1))
        self.losers[node] = lost
        return won

    @staticmethod
    def _play(a, b):
        if b[0] is None:
            return a, b
        if a[0] is None:
            return b, a
        if a[1] != b[1]:
            return (a, b) if a[1] > b[1] else (b, a)
        x, y = a[0], b[0]
        shared = common(x, y, a[1])
        if shared == len(x) or (shared < len(y) and x[shared] < y[shared]):
            return a, (y, shared, b[2], b[3])
        return b, (x, shared, a[2], a[3])

    def __iter__(self) -> Iterator[tuple[bytes, int, tuple[int, ...]]]:
        """Lines in order, each with its common prefix with the one before."""
        losers = self.losers
        while (won := self.winner)[0] is not None:
            yield won[0], won[1], won[2]
            run = won[3]
            current = self._next(run)
            node = (run + self.size) // 2
            while node:
                current, losers[node] = self._play(current, losers[node])
                node //= 2
            self.winner = current


OUT = pa.schema([
    ("doc", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("id", pa.int64()), ("start", pa.int64()),
    ("place", pa.int32()), ("low", pa.int32()), ("high", pa.int32()), ("string", pa.binary()),
])
OUT_TYPES = "doc long, lo long, hi long, id long, start long, place int, low int, high int, string binary"


class Findings:
    """Starts of repeated strings, and items to be cut in two, gathered for output."""

    def __init__(self) -> None:
        self.repeats: list[tuple[int, int, int]] = []
        self.cuts: list[tuple] = []

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.repeats) >= least and self.repeats:
            doc, lo, hi = (pa.array(c, pa.int64()) for c in zip(*self.repeats, strict=True))
            rest = [pa.nulls(len(doc), t) for t in OUT.types[3:]]
            self.repeats = []
            yield pa.RecordBatch.from_arrays([doc, lo, hi, *rest], schema=OUT)
        if len(self.cuts) >= min(least, 10_000) and self.cuts:
            rows = [{"doc": n[1], "id": n[0], "start": n[2], "place": n[3], "low": n[4], "high": n[5], "string": s}
                    for s, n in self.cuts]
            self.cuts = []
            yield pa.RecordBatch.from_pylist(rows, OUT)

    def group(self, members: list[tuple[bytes, tuple[int, ...]]]) -> None:
        """Different items of one gram: a string in an item repeats if another item has it earlier."""
        if len(members) < 2:
            return
        seen: dict[bytes, tuple[int, int, int]] = {}
        for string, n in members:
            for i in range(len(string) - LENGTH + 1):
                one = string[i : i + LENGTH]
                here = (n[0], n[1], n[2] + i)
                if here < seen.setdefault(one, here):
                    seen[one] = here
        for string, n in members:
            begin = None
            count = len(string) - LENGTH + 1
            for i in range(count + 1):
                again = i < count and seen[string[i : i + LENGTH]] != (n[0], n[1], n[2] + i)
                if again and begin is None:
                    begin = i
                elif not again and begin is not None:
                    self.repeats.append((n[1], n[2] + begin, n[2] + i - 1))
                    begin = None


def _merge(together: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, bucket = Findings(), None
        runs: list[Iterator] = []
        for batch in batches:
            for where, kind, data, numbers in zip(*(batch.column(i) for i in range(4)), strict=True):
                if where.as_py() != bucket:
                    yield from _merged(runs, found, together)
                    runs, bucket = [], where.as_py()
                if kind.as_py() == REPEATS:
                    found.repeats += zip(*np.frombuffer(numbers.as_py(), np.int64).reshape(3, -1).tolist(), strict=True)
                else:
                    runs.append(decoded_run(data.as_py(), numbers.as_py()))
            yield from found.batches(1 << 16)
        yield from _merged(runs, found, together)
        yield from found.batches(0)

    return merge


def _merged(runs: list[Iterator], found: Findings, together: int) -> Iterator[pa.RecordBatch]:
    members: list[tuple[bytes, tuple[int, ...]]] = []  # different items of the current gram, each the first of its equals
    cutting = False
    line = b""
    for new, shared, numbers in LoserTree(runs) if runs else ():
        if shared == len(new) == len(line):  # equal to the one before
            string, first = members[-1]
            if numbers[:3] < first[:3]:
                numbers, first = first, numbers
                members[-1] = string, first
            if numbers[:3] != first[:3]:
                found.repeats.append((numbers[1], numbers[2], numbers[2] + len(string) - LENGTH))
            continue
        if shared < 8:
            _close(members, cutting, found)
            members, cutting = [], False
        elif len(members) >= together and numbers[4] < numbers[5]:
            _close(members, True, found)
            members, cutting = [], True
        line = new
        members.append((new[8:], numbers))
        yield from found.batches(1 << 16)
    _close(members, cutting, found)
    yield from found.batches(1 << 16)


def _close(members: list, cutting: bool, found: Findings) -> None:
    if cutting:
        found.cuts += members
    else:
        found.group(members)


# The whole.


def _exchange(runs: DataFrame, buckets: int, together: int) -> DataFrame:
    return runs.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_merge(together), OUT_TYPES)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps that are done, which it does once the driver has let go of them.

    A driver with memory to spare may not collect its garbage for a long time. The results are tables in the shared
    folder by then.
    """
    for _ in range(2):  # the first round lets go of the driver's objects, the second of what they held
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(1)


def repeated_starts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", together: int = TOGETHER) -> DataFrame:
    """``doc`` (see :func:`keyed`) and ``lo``, ``hi``: ranges of starts of strings that also start earlier, as a table.

    ``together`` bounds the different items of one gram that a task compares; it changes the rounds, not the result.
    """
    spark = docs.sparkSession
    importable(spark)
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = _wanted(docs, id_col, text_col)
    release(spark)
    out = _first_round(docs, wanted, id_col, text_col, buckets, together)
    found = None
    while True:
        release(spark)
        repeats = out.where("lo IS NOT NULL").select("doc", "lo", "hi")
        found = repeats if found is None else found.unionByName(repeats)
        if out.where("string IS NOT NULL").isEmpty():
            return found
        out = _next_round(out, buckets, together)


def _wanted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc`` and ``wanted``, its anchors whose gram occurs more than once, as a table.

    Only the table outlives the call, here and in the rounds; see :func:`release`.
    """
    texts = keyed(docs, id_col, text_col).select("doc", "text")
    grams = texts.mapInArrow(_grams, "gram long, doc long, at long, sure boolean")
    dealt = grams.repartition("gram").sortWithinPartitions("gram")
    found = dealt.mapInArrow(_repeated, "doc long, at long")
    return written(found.groupBy("doc").agg(F.collect_list("at").alias("wanted")), "anchors")


def _first_round(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, buckets: int, together: int) -> DataFrame:
    """Repeats and cuts of all documents, as a table."""
    items = keyed(docs, id_col, text_col).join(wanted, "doc").select("id", "doc", "text", "wanted")
    return written(_exchange(items.mapInArrow(_document_items(buckets), RUN_TYPES), buckets, together), "suffixes")


def _next_round(out: DataFrame, buckets: int, together: int) -> DataFrame:
    """Repeats and cuts among the halves of the items that were cut, as a table."""
    cuts = out.where("string IS NOT NULL").select("id", "doc", "start", "place", "low", "high", "string")
    return written(_exchange(cuts.mapInArrow(_halves(buckets), RUN_TYPES), buckets, together), "suffixes")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``text`` and ``doc``, a hash of both that names a document."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.withColumn("doc", F.xxhash64("id", "text"))


CLEANED = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
    ("kept_sha256", pa.string()), ("kept", pa.binary()),
])


def _cleaned(with_text: bool):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, los, his in zip(*(batch.column(i) for i in range(4)), strict=True):
                data = _bytes(text.as_py())
                depth = np.zeros(len(data) + 1, np.int32)
                if los.is_valid:
                    np.add.at(depth, los.values.to_numpy(), 1)
                    np.add.at(depth, his.values.to_numpy() + LENGTH, -1)
                gone = np.cumsum(depth[:-1]) > 0
                kept = data[~gone].tobytes()
                rows.append({
                    "doc_id": doc_id.as_py(), "n_bytes": len(data), "n_removed": int(gone.sum()),
                    "n_spans": int((gone & ~np.concatenate([[False], gone[:-1]])).sum()),
                    "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept if with_text else None,
                })
            yield pa.RecordBatch.from_pylist(rows, CLEANED)

    return clean


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True,
                   together: int = TOGETHER) -> DataFrame:
    """Each row's id, ``n_bytes``, ``n_removed``, ``n_spans`` (runs of removed bytes), ``kept_sha256`` and ``kept`` bytes.

    A byte is removed if a string of ``LENGTH`` bytes that covers it starts earlier too: in a document with a smaller id,
    or before in the same one. Null ids come last. Rows that repeat id and text are one document, reported as often;
    of different texts with one id, that with the smaller hash is the earlier. Null text is the empty one, and texts
    shorter than a string lose nothing. ``with_text=False`` leaves ``kept`` null. An empty table gives no rows.
    """
    repeats = repeated_starts(docs, id_col, text_col, together).groupBy("doc").agg(
        F.collect_list("lo").alias("los"), F.collect_list("hi").alias("his"))
    joined = keyed(docs, id_col, text_col).join(repeats, "doc", "left").select("id", "text", "los", "his")
    result = joined.mapInArrow(
        _cleaned(with_text),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return result.withColumnRenamed("doc_id", id_col)
