"""Interaction of document filters, from a sparse matrix of documents and terms.

Words are cut in tasks that number their own words and write compressed sparse rows of those numbers, in shards of a
bounded number of entries. The words of all shards then get one dictionary: dense codes that are the same everywhere.
For that a shard's words move in blocks, one for each task that gives codes, and come back as blocks of codes. A shard's
numbers are replaced by these codes. Sums of a row give a document's words, its entries the distinct words;
together with flags that need no words they say which filters a document fails.

How filters interact depends on these flags alone, so documents are counted by part, flags and labels before anything
else is done with them.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import short_batches, written
from .workers import importable

#: Words and rows after which a shard ends, and bytes of texts that are cut into words together.
WORDS, ROWS = 1 << 20, 1 << 14
PORTION = 1 << 21
#: Shards, or blocks of their words, that a worker gets at once.
BLOCKS = 1 << 4
FILTERS = "ABCDE"


def local_shards(docs: DataFrame, row: Column, text_col: str = "text") -> DataFrame:
    """Shards with numbers of their own: ``rows``, ``ends``, ``terms``, ``counts``, words in buckets, and ``shard``, their name.

    Names last once the shards are written. Row i of a shard is ``rows[i]``, what ``row`` gives; its entries are those of
    ``terms`` and ``counts`` from the end of the row before up to ``ends[i]``. Terms are places among the shard's words:
    ``words`` has their bytes, ``sizes`` how many each has, ``stops`` the place behind the last of each bucket. A word has
    the same bucket in all shards. Numbers are little-endian 32-bit integers, end to end, as Spark would otherwise handle
    each of them, and each word, on its own. Null text has no words.
    """
    importable(docs.sparkSession)
    bare = docs.select(row.alias("row"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([
        T.StructField("rows", T.ArrayType(bare.schema["row"].dataType)),
        *[T.StructField(name, T.BinaryType()) for name in ("ends", "terms", "counts", "words", "sizes", "stops")],
    ])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], _Shard()
        for batch in batches:
            texts = pc.fill_null(batch.column(1), b"").cast(pa.string(), safe=False)
            for at, stop in _portions(texts):
                held.add(texts.slice(at, stop - at))
                rows.append(batch.column(0).slice(at, stop - at))
                if held.full():
                    yield in_buckets(held.batch(pa.concat_arrays(rows)), buckets)
                    rows, held = [], _Shard()
        if rows:
            yield in_buckets(held.batch(pa.concat_arrays(rows)), buckets)

    return bare.mapInArrow(shards, schema).withColumn("shard", F.monotonically_increasing_id())


def in_buckets(one: pa.RecordBatch, buckets: int) -> pa.RecordBatch:
    """A shard with its words in the order of their buckets: see :func:`local_shards`."""
    words = one.column("words").flatten()
    bucket = np.empty(len(words), np.int32)
    for at in range(0, len(words), ROWS):
        some = words.slice(at, ROWS).to_numpy(zero_copy_only=False)
        bucket[at : at + ROWS] = pd.util.hash_array(some, categorize=False) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(words), "<i4")
    place[order] = np.arange(len(words), dtype="<i4")
    terms = numbers_of(one, "terms")
    stops = np.cumsum(np.bincount(bucket, minlength=buckets)).astype("<i4")
    data, sizes = packed(words.take(pa.array(order)))
    binaries = [place[terms].tobytes(), one.column("counts")[0].as_py(), data, sizes, stops.tobytes()]
    return pa.RecordBatch.from_arrays(
        [one.column("rows"), one.column("ends"), *[pa.array([values], pa.binary()) for values in binaries]],
        ["rows", "ends", "terms", "counts", "words", "sizes", "stops"])


def packed(words: pa.Array) -> tuple[bytes, bytes]:
    """The bytes of all words, end to end, and how many each has."""
    words = pa.concat_arrays([words])
    if not len(words):
        return b"", b""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    return words.buffers()[2][int(ends[0]) : int(ends[-1])].to_pybytes(), np.diff(ends).astype("<i4").tobytes()


def unpacked(data: bytes, sizes: np.ndarray) -> pa.Array:
    """The words that :func:`packed` has put end to end."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _portions(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Begin and end of the texts that are cut into words together; a longer one is alone, or the last of a portion."""
    stops = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
    rows = np.arange(len(texts)) // ROWS
    cuts = np.flatnonzero((np.diff(stops // PORTION) > 0) | (np.diff(rows) > 0)) + 1
    return zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)], strict=True)


class _Shard:
    """Texts as rows of numbers. Words stay in Arrow's arrays, as objects of Python would take several times the space."""

    def __init__(self) -> None:
        self.parts: list[pa.DictionaryArray] = []
        self.texts: list[np.ndarray] = []
        self.n_words = self.n_texts = 0

    def add(self, texts: pa.Array) -> None:
        cut = pc.ascii_split_whitespace(texts)
        of = np.repeat(np.arange(self.n_texts, self.n_texts + len(texts), dtype=np.int32), pc.list_value_length(cut).to_numpy())
        words = cut.flatten()
        there = pc.greater(pc.binary_length(words), 0)  # white space around a text cuts empty words off
        words = words.filter(there)
        self.parts.append(words.dictionary_encode())
        self.texts.append(of[there.to_numpy(zero_copy_only=False)])
        self.n_texts += len(texts)
        self.n_words += len(words)

    def full(self) -> bool:
        return self.n_words >= WORDS or self.n_texts >= ROWS

    def batch(self, rows: pa.Array) -> pa.RecordBatch:
        def one(values: pa.Array) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        unified = pa.chunked_array(self.parts, pa.dictionary(pa.int32(), pa.string())).unify_dictionaries()
        words = max((part.dictionary for part in unified.chunks), key=len)  # the last ones hold all
        ends, terms, counts = [], [], []
        for part, of in zip(unified.chunks, self.texts, strict=True):
            keys = np.sort(of.astype(np.int64) << 32 | part.indices.to_numpy())
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            terms.append((keys[first] & 0xFFFFFFFF).astype("<i4"))
            counts.append(np.diff(first, append=len(keys)).astype("<i4"))
            ends.append(np.bincount(keys[first] >> 32, minlength=self.n_texts))
        held = [np.cumsum(np.sum(ends, axis=0)).astype("<i4"), np.concatenate(terms), np.concatenate(counts)]
        numbers = [pa.array([values.tobytes()], pa.binary()) for values in held]
        arrays = [one(rows), *numbers, one(words.cast(pa.binary()))]
        return pa.RecordBatch.from_arrays(arrays, ["rows", "ends", "terms", "counts", "words"])


def numbers_of(one: pa.RecordBatch, name: str) -> np.ndarray:
    """The integers that a column of 32-bit integers holds in a single row."""
    return np.frombuffer(one.column(name)[0].as_py(), "<i4")


def coded(local: DataFrame) -> DataFrame:
    """Codes of the words of shards, dense from 0, one for each word: ``shard``, ``begin``, ``code``, ``places``.

    Words of a shard from place ``begin`` on have the codes ``code`` plus ``places``, 32-bit integers. Rows of no shard have
    ``words`` and their ``sizes`` instead, each word once; their codes go up from ``code``. Each bucket of words is dealt to a
    task, which numbers the different ones; their numbers start behind those of the tasks before. They last because they
    are written. A task holds its own words only, a share of the vocabulary.
    """
    buckets = int(local.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                stops = numbers_of(one, "stops")
                begins = np.concatenate([[0], stops[:-1]]).astype(np.int32)
                some = np.flatnonzero(stops > begins)
                data, sizes = one.column("words")[0].as_buffer(), one.column("sizes")[0].as_buffer()
                if not len(some):
                    continue
                # Buckets without words have no rows; those that have some lie end to end.
                ends = np.concatenate([[0], np.cumsum(numbers_of(one, "sizes"), dtype=np.int64)])
                cuts = np.append(begins[some], stops[-1]).astype(np.int64)
                arrays = [
                    pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(offsets.astype(np.int32)), values])
                    for offsets, values in ((ends[cuts], data), (cuts * 4, sizes))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array([one.column("shard")[0].as_py()] * len(some), pa.int64()),
                     pa.array(begins[some]), *arrays], ["bucket", "shard", "begin", "words", "sizes"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[bytes, int] = {}
        names = ["shard", "begin", "part", "place", "places", "words", "sizes"]
        part = TaskContext.get().partitionId()
        for batch in batches:
            places = []
            for data, sizes in zip(batch.column("words"), batch.column("sizes"), strict=True):
                words = unpacked(data.as_py(), np.frombuffer(sizes.as_py(), "<i4")).to_pylist()
                places.append(np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), "<i4", len(words)).tobytes())
            size = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("begin"), pa.array(np.full(size, part, np.int32)), pa.nulls(size, pa.int64()),
                 pa.array(places, pa.binary()), pa.nulls(size, pa.binary()), pa.nulls(size, pa.binary())], names)
        every = iter(numbers)
        for at in range(0, len(numbers), ROWS):
            data, sizes = packed(pa.array(itertools.islice(every, ROWS), pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.array([part], pa.int32()), pa.array([at], pa.int64()),
                 pa.nulls(1, pa.binary()), pa.array([data], pa.binary()), pa.array([sizes], pa.binary())], names)

    blocks = local.select("shard", "words", "sizes", "stops").mapInArrow(
        deal, "bucket int, shard long, begin int, words binary, sizes binary")
    numbered = written(blocks.repartitionById(buckets, "bucket").mapInArrow(
        number, "shard long, begin int, part int, place long, places binary, words binary, sizes binary"), "words", "zstd")
    last = F.col("place") + F.length("sizes") / 4
    sizes = numbered.groupBy("part").agg(F.max(last).cast("long").alias("size")).orderBy("part").collect()  # one row for each task
    before = itertools.accumulate([0, *[r["size"] for r in sizes]])
    starts = local.sparkSession.createDataFrame(
        [(r["part"], start) for r, start in zip(sizes, before, strict=False)], "part int, start long")
    code = F.col("start") + F.coalesce("place", F.lit(0))
    return numbered.join(F.broadcast(starts), "part").select("shard", "begin", code.alias("code"), "places", "words", "sizes")


def term_matrix(docs: DataFrame, row: Column, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The matrix in shards, ``shard``, ``rows``, ``ends``, ``codes``, ``counts``, and its dictionary ``word``, ``code``.

    ``ends`` and ``counts`` are little-endian 32-bit integers, ``codes`` 64-bit ones: see :func:`local_shards`.
    Words are whatever white space in ASCII separates, told apart by their bytes. Every row of ``docs`` is a row of the
    matrix, repeated ones too; texts that are null or have no words are rows without entries. An empty table gives no
    shards and no words.
    """
    with short_batches(docs.sparkSession):
        local = written(local_shards(docs, row, text_col), "shards", "zstd")
    # A shard has each of its words once, so that frequent words weigh as much as there are shards, not documents.
    with short_batches(docs.sparkSession, BLOCKS):
        words = coded(local)
    tables = words.where("shard IS NOT NULL").groupBy("shard").agg(F.collect_list(F.struct("begin", "code", "places")).alias("coded"))
    joined = local.drop("words", "sizes", "stops").join(tables, "shard", "left")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                blocks = one.column("coded")[0].as_py() or []
                table = np.empty(sum(len(block["places"]) for block in blocks) // 4, "<i8")
                for block in blocks:
                    places = np.frombuffer(block["places"], "<i4")
                    table[block["begin"] : block["begin"] + len(places)] = places + np.int64(block["code"])
                codes = table[numbers_of(one, "terms")]
                yield pa.RecordBatch.from_arrays(
                    [one.column("shard"), one.column("rows"), one.column("ends"), pa.array([codes.tobytes()], pa.binary()),
                     one.column("counts")], ["shard", "rows", "ends", "codes", "counts"])

    def dictionary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                found = unpacked(one.column("words")[0].as_py(), numbers_of(one, "sizes"))
                first = one.column("code")[0].as_py()
                yield pa.RecordBatch.from_arrays([found, pa.array(np.arange(first, first + len(found)))], ["word", "code"])

    rows = local.schema["rows"].dataType.simpleString()
    shards = joined.select("shard", "rows", "ends", "terms", "counts", "coded").mapInArrow(
        encode, f"shard bigint, rows {rows}, ends binary, codes binary, counts binary")
    return shards, words.where("shard IS NULL").select("words", "sizes", "code").mapInArrow(dictionary, "word binary, code bigint")


def row_sums(shards: DataFrame) -> DataFrame:
    """Each row of a matrix: ``row``, ``n_words`` (its sum) and ``n_distinct`` (its entries)."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                ends, counts = numbers_of(one, "ends"), numbers_of(one, "counts")
                total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [one.column("rows").flatten(), pa.array(total[ends] - total[starts]), pa.array(ends - starts, pa.int64())],
                    ["row", "n_words", "n_distinct"])

    row = shards.schema["rows"].dataType.elementType.simpleString()
    return shards.select("rows", "ends", "counts").mapInArrow(sums, f"row {row}, n_words bigint, n_distinct bigint")


def bit(letter: str, when: Column) -> Column:
    return F.when(when, F.lit(1 << FILTERS.index(letter))).otherwise(F.lit(0))


def text_flags(text: Column) -> Column:
    """Bits of the filters C and D, which need no words. Null is the empty text, which passes both."""
    text = F.coalesce(text, F.lit(""))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return bit("C", capitals * 100 > F.length(text) * 5).bitwiseOR(bit("D", F.regexp_like(text, F.lit("[#$%&*|]"))))


def flagged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Each row of ``docs`` with the filters that it fails: ``id``, ``part``, ``content``, ``flags`` without E's bit.

    ``content`` is a SHA-256 of the text; null texts and parts are empty ones.
    """
    row = F.struct(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("content"),
        text_flags(F.col(text_col)).alias("flags"),
    )
    shards, _ = term_matrix(docs, row, text_col)
    counted = bit("A", F.col("n_words") < 50).bitwiseOR(bit("B", F.col("n_distinct") * 100 < F.col("n_words") * 65))
    with short_batches(docs.sparkSession, 1):  # a shard at once: workers and their executor hold few copies of it
        sums = written(row_sums(shards), "sums", "zstd")
    return sums.select("row.id", "row.part", "row.content", F.col("row.flags").bitwiseOR(counted).alias("flags"))


def cells(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number ``n`` of documents by ``part``, ``flags``, ``good`` and ``toxic``.

    E is set for a document whose text a document with a smaller id has. Rows that repeat an id are copies of those with
    smaller ids only. A null id is smaller than none and larger than none, so E passes it. A document is good, or toxic,
    when a row of the labels with its id says so; null ids have no labels.
    """
    marks = labels.groupBy(F.col(id_col).alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = rows.join(marks.where("id IS NOT NULL"), "id", "left").select(
        "id", "part", "content", "flags", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    # Rows of one id first, then rows alike but for the id: copies by the million shrink to a row for each part and label.
    alike = ["content", "part", "flags", "good", "toxic"]
    once = known.groupBy("id", *alike).agg(F.count("*").alias("n"))
    groups = once.groupBy(*alike).agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    first = groups.groupBy("content").agg(F.min("least.id").alias("first"))
    fresh = F.col("nameless") + F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)
    split = groups.join(first, "content").select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("flags"), fresh.alias("n")),
            F.struct(F.col("flags").bitwiseOR(bit("E", F.lit(True))).alias("flags"), (F.col("n") - fresh).alias("n")),
        )).alias("cell"))
    return split.where("cell.n > 0").groupBy("part", "cell.flags", "good", "toxic").agg(F.sum("cell.n").alias("n"))


def interactions(counted: DataFrame) -> DataFrame:
    """What each filter does at each step of each order: see :func:`audit`. ``counted`` comes from :func:`cells`.

    A step is known by its filter and the set of filters before it: 80 cases, which the 600 steps of all orders share.
    """
    cases = {}
    for order in map("".join, itertools.permutations(FILTERS)):
        for step, letter in enumerate(order):
            before = sum(1 << FILTERS.index(x) for x in order[:step])
            cases.setdefault((1 << FILTERS.index(letter), before), []).append((order, step + 1))
    case = F.explode(F.array(*[F.struct(F.lit(own).alias("own"), F.lit(before).alias("before")) for own, before in cases]))
    steps = F.create_map(*[
        column for (own, before), places in cases.items() for column in (
            F.lit(own << 5 | before),
            F.array(*[F.struct(F.lit(order).alias("filter_order"), F.lit(step).alias("step")) for order, step in places]))
    ])
    each = counted.select("part", "flags", "good", "toxic", "n", case.alias("case")).select("*", "case.own", "case.before")
    fails = F.col("flags").bitwiseAND(F.col("own")) != 0
    earlier = F.col("flags").bitwiseAND(F.col("before")) != 0
    # Of the orders of all filters, the filter comes before the others that a document fails in one of so many.
    share = F.col("n") * (F.lit(120) / F.greatest(F.bit_count("flags"), F.lit(1))).cast("long")

    def total(when: Column, value: Column = F.col("n")) -> Column:
        return F.coalesce(F.sum(F.when(when, value)), F.lit(0)).cast("long")

    sums = each.groupBy("part", "own", "before").agg(
        total(~fails & ~earlier).alias("kept"), total(fails & ~earlier).alias("removed"),
        total(fails & earlier).alias("redundant"), total(F.col("flags") == F.col("own")).alias("unique_fails"),
        total(fails & ~earlier & (F.col("good") == 1)).alias("good_lost"),
        total(fails & ~earlier & (F.col("toxic") == 1)).alias("toxic_lost"), total(fails, share).alias("shapley"))
    placed = F.explode(F.element_at(steps, F.shiftleft("own", 5).bitwiseOR(F.col("before")))).alias("at")
    return sums.select("*", placed).select(
        "part", "at.filter_order", "at.step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """For each part, order of the five filters and step: what is kept, removed, redundant and lost.

    Failure conditions: A, under 50 words; B, distinct words under 65 % of the words; C, capitals over 5 % of the
    characters; D, any of ``#$%&*|``; E, the text of a document with a smaller id. Zeros are rows too.

    Null texts and parts are empty ones; null ids see :func:`cells`. Repeated rows count as often as they occur; other
    columns are ignored. An empty table has no parts and gives no rows.
    """
    return interactions(cells(flagged(docs, id_col, text_col, part_col), labels, id_col))
