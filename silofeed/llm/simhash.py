"""Near duplicates by SimHash, linked through the popcounts of fingerprint segments.

A 64-bit fingerprint is cut into 32 segments of two bits. Its embedding is the number of bits set in each segment. The
Manhattan distance of two embeddings is at most the Hamming distance of the fingerprints, so fingerprints within
``distance`` bits lie within as many grid steps. The two halves of an embedding have 16 coordinates each; at a distance
of at most three, one half differs by at most one step. A grid whose cells are the vectors of a half is joined over that
range: a fingerprint meets those of its own cell and of the cells one step below it. What meets is verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import similar
from .graph import components, hamming
from .tables import free_name, passing, scratch, short_batches, stored, text_key, without, written
from .workers import importable

#: Bits that linked fingerprints may differ in. The grid is exact up to three.
DISTANCE = 3
SEED = 42
PAIRS = 0x5555555555555555
#: Shingles that are unpacked into bits at once.
CHUNK = 1 << 15


def fingerprint(text: str | None, words: int = 3) -> int:
    """Unsigned SimHash of a text. Null and texts without words give 0; fewer words are one shingle."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*[found[i:] for i in range(words)], strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """Id and ``fp`` (the fingerprint's bits as a signed long) of each row."""
    importable(docs.sparkSession)

    def each(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, words) for t in batch], np.uint64).view(np.int64))

    return docs.select(F.col(id_col), F.pandas_udf(each, "long")(F.col(text_col)).alias("fp"))


def embedding(fp: Column) -> Column:
    """Popcounts of the 32 two-bit segments, two bits each: the half adder's carry and sum."""
    upper = F.shiftrightunsigned(fp, 1)
    carry = upper.bitwiseAND(fp).bitwiseAND(F.lit(PAIRS))
    return F.shiftleft(carry, 1).bitwiseOR(upper.bitwiseXOR(fp).bitwiseAND(F.lit(PAIRS)))


def close_pairs(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``a``, ``b`` of different fingerprints (column ``fp``) that differ in at most ``distance`` bits.

    Each pair may come more than once. Null fingerprints have no pairs.
    """
    if not 0 <= distance <= 3:
        raise ValueError("the grid covers distances from 0 to 3")
    mask = (1 << 32) - 1
    halves = distinct.where("fp IS NOT NULL").select(
        "fp",
        F.explode(F.array(
            F.struct(F.lit(0).alias("half"), embedding(F.col("fp")).bitwiseAND(F.lit(mask)).alias("cell")),
            F.struct(F.lit(1).alias("half"), F.shiftrightunsigned(embedding(F.col("fp")), 32).alias("cell")),
        )).alias("place"),
    ).select("fp", "place.half", "place.cell")
    steps = F.array(*[F.lit(1 << (2 * i)).cast("long") for i in range(16)])
    below = F.transform(
        F.filter(steps, lambda step: F.col("cell").bitwiseAND(step * F.lit(3)) != 0), lambda step: F.col("cell") - step
    )
    probes = halves.select(
        F.col("fp").alias("a"), "half", F.col("cell").alias("own"),
        F.explode(F.concat(F.array("cell"), below)).alias("cell"),
    )
    residents = halves.select(F.col("fp").alias("b"), F.col("half").alias("b_half"), F.col("cell").alias("b_cell"))
    # In the same cell a pair is met from both sides; one suffices. Cells below are met from one side.
    once = (F.col("own") != F.col("cell")) | (F.col("a") < F.col("b"))
    close = hamming(F.col("a"), F.col("b")) <= distance
    met = (F.col("half") == F.col("b_half")) & (F.col("cell") == F.col("b_cell"))
    return probes.join(residents, met & once & close).select("a", "b")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, distance: int = DISTANCE,
    similarity: float | None = None, similar_words: int = 5,
) -> DataFrame:
    """Id, ``fp`` and ``component_id`` (smallest id reachable over links, itself included) of each row.

    Equal fingerprints are one node, so copies cost no links. Null text is the empty text, whose fingerprint 0 links
    like any other. Null ids take part, but name no component unless all ids of it are null. Repeated rows are
    reported as often as they occur. Other columns are ignored; an empty table gives no rows.

    With a ``similarity``, texts that share at least that much of their shingles of ``similar_words`` words are linked
    as well, however far apart their fingerprints are; see :mod:`.similar`.
    """
    if similarity is None:
        with short_batches(docs.sparkSession):
            marked = written(fingerprints(docs, id_col, text_col, words).withColumnRenamed(id_col, "id"), "fingerprints")
    else:
        importable(docs.sparkSession)
        sketch = similar.sketch(F.col(text_col), similarity, similar_words, lambda t: fingerprint(t, words))
        with short_batches(docs.sparkSession):
            sketched = written(docs.select(
                F.col(id_col).alias("id"), similar.text_hash(text_col).alias("doc"), sketch.alias("sketch")), "sketches")
        marked = sketched.select("id", "sketch.fp")
    nodes = marked.groupBy("fp").agg(F.min("id").alias("least"))
    pairs = written(close_pairs(nodes, distance).distinct(), "pairs")
    if similarity is not None:
        sketches = sketched.select(F.col("sketch.fp").alias("node"), "doc", "sketch")
        pairs = similar.link_similar(docs, sketches, pairs, similarity, text_col, similar_words)
    member = components(pairs)
    linked = nodes.join(member, nodes["fp"] == member["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    names = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = linked.join(names, "component").select("fp", "component_id")
    return marked.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                         distance: int = DISTANCE, similarity: float | None = None, similar_words: int = 5) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, with all their columns.

    Rows that repeat both id and text are one document and stay, or go, together.
    """
    key = free_name(docs, "document")
    keyed = docs.withColumn(key, text_key(id_col, text_col))
    with scratch():
        found = near_duplicates(keyed, key, text_col, words, distance, similarity, similar_words)
        gone, folder = stored(found.where(F.col(key) != F.col("component_id")).select(key), "copies")
    passing(docs.sparkSession, folder)
    return without(docs, gone, id_col, text_col)
