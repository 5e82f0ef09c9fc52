"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps the hash of every shingle below a fixed fraction of the hash range, and the smallest hash in any case.
Its size follows the document's, so sketches of very unequal documents can be compared, and the sketch of a union is the
union of the sketches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workers import importable

#: Words of a shingle; one of SCALE hashes is kept.
WORDS = 5
SCALE = 8
SEED = 42


def sketch(text: str | None, words: int = WORDS, scale: int = SCALE) -> np.ndarray:
    """Sorted distinct hashes kept of a text. Case of ASCII letters does not count, nor how words are spaced.

    Fewer words than a shingle has are one shingle; null and texts without words have an empty sketch.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < words:
        shingles = iter([b" ".join(found)])
    else:
        shingles = map(b" ".join, zip(*[islice(found, i, None) for i in range(words)], strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
    kept = hashes[hashes < np.uint64((1 << 64) // scale)] if scale > 1 else hashes
    return np.unique(kept) if len(kept) else hashes.min(keepdims=True)


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Sketch of two documents together."""
    both = np.union1d(a, b)
    kept = both[both < np.uint64((1 << 64) // scale)] if scale > 1 else both
    return kept if len(kept) else both[:1]


def resemblance(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of all shingles that both have; two empty sketches are alike."""
    if not len(a) and not len(b):
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has; an empty sketch is contained in any."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 1.0


def digits(kept: np.ndarray) -> str:
    """A sketch as text: 16 hexadecimal digits for each hash, ascending."""
    return kept.astype(">u8").tobytes().hex()


def parsed(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                 scale: int = SCALE) -> DataFrame:
    """Id and ``fingerprint`` of each row. Null text is the empty one; repeated rows are reported each."""
    importable(docs.sparkSession)

    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([digits(sketch(t, words, scale)) for t in texts], dtype=object)

    return docs.select(F.col(id_col), F.pandas_udf(each, "string")(F.col(text_col)).alias("fingerprint"))


EDITED = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ("kept_in_edited", pa.float64()),
])


def edited_text(text: str, following: str) -> str:
    """The text with its last half replaced by as many first characters of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are.

    The edited text ends in the beginning of the next document by ascending id; the first follows the last. Rows of one
    id follow each other by text. A null id has no place in the order, and no next document: its last half is cut off.
    Null text is the empty one. Other columns are ignored; an empty table gives no rows.

    Rows are cut into ranges of ids at ids that occur, so the document that follows a range is known to be the one at
    the cut, and goes to both ranges. Each text moves once, each range is a sorted stream.
    """
    spark = docs.sparkSession
    importable(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.agg(F.min("id"), F.percentile_approx("id", shares, 100 * ranges)).first()
    cuts = sorted({c for c in found[1] or [] if c > found[0]})
    edges = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.fillna(0).to_numpy(np.int64), side="right").astype(np.int32))

    spread = F.lit(-1) - F.pmod(F.xxhash64("text"), F.lit(ranges)).cast("int")
    place = F.when(F.col("id").isNull(), spread).otherwise(range_of("id"))
    before = F.when(F.col("id") == F.lit(found[0]), F.lit(len(cuts))).when(F.col("id").isin(cuts), F.col("place") - 1)
    placed = rows.withColumn("place", place).select(
        "id", "text", F.explode(F.array_compact(F.array(
            F.struct(F.col("place").alias("range"), F.lit(False).alias("follows")),
            F.when(before.isNotNull(), F.struct(before.alias("range"), F.lit(True).alias("follows"))),
        ))).alias("at"),
    ).select("at.range", "at.follows", "id", "text")
    streams = placed.repartition(ranges, "range").sortWithinPartitions("range", "follows", "id", "text")
    result = streams.mapInArrow(_compare_neighbours, ", ".join(
        f"{f.name} {'long' if f.type == pa.int64() else 'double' if f.type == pa.float64() else 'string'}" for f in EDITED))
    return result.withColumnRenamed("doc_id", id_col) if id_col != "doc_id" else result


def _compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None  # range, id, text and sketch of the row that waits for the next one
    for batch in batches:
        out = []
        columns = [batch.column(i).to_pylist() for i in range(3)] + [batch.column(3)]
        for place, follows, doc_id, text in zip(*columns, strict=True):
            if held is None and follows:
                continue  # only the first of the rows that follow a range counts
            text = text.as_py()
            own = sketch(text)
            if held is not None:
                out.append(_compared(held, text, own) if held[0] == place and place >= 0 else _compared(held))
            held = None if follows else (place, doc_id, text, own)
        if out:
            yield pa.RecordBatch.from_pylist(out, EDITED)
    if held is not None:
        yield pa.RecordBatch.from_pylist([_compared(held)], EDITED)


def _compared(held: tuple, following: str = "", following_sketch: np.ndarray | None = None) -> dict:
    _, doc_id, text, own = held
    edited = edited_text(text, following)
    changed = sketch(edited)
    return {
        "doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
        "fingerprint": digits(own), "edited_fingerprint": digits(changed), "near_edited": resemblance(own, changed),
        "near_next": 0.0 if following_sketch is None else resemblance(own, following_sketch),
        "kept_in_edited": containment(own, changed),
    }
