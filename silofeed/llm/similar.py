"""Links between texts that share most of their shingles.

MinHash bands bring texts together; what meets is verified on the shingles themselves. There are so many bands that two
texts of the least similarity share one with the probability ``SURE``. Two bits of each least value make a signature;
texts whose signatures differ in more places than similar ones do, but for ``MISSED`` of them, are not compared. Only
components are wanted, so a band's texts meet one of them first: the one that shares most bands with others, which is
the middle of its group, then others. What that leaves apart has its shingles read again, once: texts that have another
of their band alike by signature get a longer one. Of these texts, those meet that share a rare one of their first
shingles; those of a band meet as well if both have enough shingles that many texts have, again its middle first.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import components
from .tables import passing, scratch, short_batches, stored, written
from .workers import importable

#: Least probability that two texts of the least similarity share a band, and hashes of a band.
SURE = 0.99999
ROWS = 4
SEED = 42
#: Share of the similar texts that meet and whose signatures differ in too many places.
MISSED = 1e-6
#: Values that are hashed at once, texts whose sets are held at once, and rounds in which a band's texts meet one of them only.
CHUNK = 1 << 17
TEXTS = 500
ROUNDS = 2
#: Places of the longer signatures.
LONG_PLACES = 512
#: Texts that a shingle is in, at most, to bring them together by itself.
FEW = 64
#: Places of a signature in a long, and the lower bits of its two-bit places.
PLACES = 32
LOWER = 0x5555555555555555
#: Texts to be compared that are broadcast, a few bytes each; more are joined by shuffles.
BROADCAST_ROWS = 500_000


def bands_for(similarity: float, rows: int = ROWS, sure: float = SURE) -> int:
    if not 0 < similarity <= 1:
        raise ValueError("a similarity is above 0 and at most 1")
    return 1 if similarity == 1 else math.ceil(math.log(1 - sure) / math.log(1 - similarity**rows))


def shingle_hashes(text: str | None, words: int = 5) -> np.ndarray:
    """Distinct hashes of a text's shingles; null and texts without words have none, fewer words are one shingle."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    shingles = map(b" ".join, zip(*[found[i:] for i in range(min(words, len(found)))], strict=False))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64))


@cache
def keys_of(count: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 63, (count, 2), np.uint64)


def least_values(hashes: np.ndarray, count: int) -> np.ndarray:
    """The least value of each hash function over the shingles."""
    keys = keys_of(count)
    least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    some = CHUNK // count
    for at in range(0, len(hashes), some):
        x = (hashes[at : at + some] ^ keys[:, :1]) * (keys[:, 1:] | np.uint64(1))
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9E3779B97F4A7C15)
        least = np.minimum(least, x.min(axis=1))
    return least


def band_hashes(least: np.ndarray, bands: int) -> np.ndarray:
    """One hash for each band, of the least values of its hash functions and its number."""
    each = least.reshape(bands, -1)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(each)], np.uint64).view(np.int64)


def signature(least: np.ndarray) -> np.ndarray:
    """Two bits of each least value, packed into longs; places behind the last are zero."""
    bits = np.zeros(-(-len(least) // PLACES) * PLACES, np.uint64)
    bits[: len(least)] = least >> np.uint64(20) & np.uint64(3)
    shifts = np.arange(PLACES, dtype=np.uint64) * np.uint64(2)
    return np.bitwise_or.reduce(bits.reshape(-1, PLACES) << shifts, axis=1).view(np.int64)


def tolerance(similarity: float, places: int, missed: float = MISSED) -> int:
    """Places in which the signatures of texts of that similarity differ at most, but for the share ``missed``.

    Two bits of different values are equal in one case of four.
    """
    apart = (1 - similarity) * 3 / 4
    left, at = 1.0, -1
    while left > missed and at < places:
        at += 1
        left -= math.comb(places, at) * apart**at * (1 - apart) ** (places - at)
    return at


def sketch(text: Column, similarity: float, words: int, mark: Callable[[str | None], int]) -> Column:
    """``fp``, what ``mark`` gives, ``n``, the number of distinct shingles, ``bands`` and ``sig``: all in one worker."""
    count = bands_for(similarity)

    def each(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        none = np.zeros(0, np.int64)
        for batch in texts:
            fps, sizes, bands, sigs = np.zeros(len(batch), np.uint64), np.zeros(len(batch), np.int32), [], []
            for at, t in enumerate(batch):
                found = shingle_hashes(t, words)
                fps[at], sizes[at] = mark(t), len(found)
                least = least_values(found, count * ROWS)
                bands.append(band_hashes(least, count) if len(found) else none)
                sigs.append(signature(least))
            yield pd.DataFrame({"fp": fps.view(np.int64), "n": sizes, "bands": bands, "sig": sigs})

    return F.pandas_udf(each, "fp long, n int, bands array<long>, sig array<long>")(text)


def text_hash(text_col: str) -> Column:
    """128 bits that name a text; null is the empty one."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.struct(F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("i"))


def link_similar(docs: DataFrame, sketches: DataFrame, known: DataFrame, similarity: float, text_col: str = "text",
                 words: int = 5) -> DataFrame:
    """Links ``a``, ``b`` of nodes: ``known`` ones, and so many that nodes with similar texts are connected.

    ``sketches`` has ``node``, ``doc`` (the :func:`text_hash`) and ``sketch`` of the texts of ``docs``; equal texts have
    equal nodes. Nodes with texts that share at least ``similarity`` of their distinct shingles (Jaccard) get into one
    component, and only those. Null texts and those without words are similar to none. Empty tables give ``known``.
    """
    importable(docs.sparkSession)
    count = bands_for(similarity)
    longs = -(-count * ROWS // PLACES)
    most = tolerance(similarity, count * ROWS)
    # Copies of a text are put together before its bands are told apart.
    texts = sketches.groupBy("doc").agg(F.first(F.struct("node", "sketch")).alias("t")).select("doc", "t.node", "t.sketch")
    places = texts.select("doc", "node", F.explode("sketch.bands").alias("band"))
    several = places.groupBy("band").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("many")).where("low < high")
    places = written(places.join(several.select("band", "many"), "band").select("band", "doc", "many"), "places")
    shared = places.groupBy("doc").agg(F.sum("many").alias("shared"))
    signs = [F.col("sketch.sig")[i].alias(f"s{i}") for i in range(longs)]
    met_texts = written(texts.join(shared, "doc").select("doc", "node", "shared", F.col("sketch.n").alias("n"), *signs), "met-texts")
    narrow = places.select("band", "doc")

    text = F.struct("doc", "node", "part", "n", *[f"s{i}" for i in range(longs)])
    for turn in range(ROUNDS + 1):
        with scratch():
            named = components(known).withColumnRenamed("node", "named")
            info = met_texts.join(named, F.col("node") == F.col("named"), "left").withColumn(
                "part", F.coalesce("component", "node")).drop("named", "component")
            labelled = written(narrow.join(info, "doc").select("band", "part", "shared", text.alias("x")), "labelled")
            order = F.col("shared") if turn == 0 else F.xxhash64("x.doc", F.lit(turn)).bitwiseAND(F.lit((1 << 62) - 1))
            leader = labelled.groupBy("band").agg(
                F.max_by("x", F.struct(order, F.col("x.doc"))).alias("y"), F.min("part").alias("low"), F.max("part").alias("high"),
            ).where("low < high")
            near = (F.col("x.part") != F.col("y.part")) & alike("x", "y", similarity) & (unlike("x", "y", longs) <= most)
            if turn < ROUNDS:
                led = leader.select(F.col("band").alias("of"), "y")
                met = labelled.join(led, (F.col("band") == F.col("of")) & near)
                # The most alike of the texts that a text has met; the others have their turn.
                met = met.groupBy("x.doc").agg(F.min_by(F.struct("x", "y"), F.struct(unlike("x", "y", longs), F.col("y.doc"))).alias("p"))
                met = met.select("p.x", "p.y")
                met = written(met.select(F.col("x.doc").alias("a_doc"), F.col("y.doc").alias("b_doc"),
                                         F.col("x.node").alias("a"), F.col("y.node").alias("b")), "met")
                wanted = met.select(F.col("a_doc").alias("wanted")).union(met.select("b_doc")).distinct()
                links = verified(met, shingle_sets(docs, wanted, text_col, words), similarity)
            else:
                left = written(labelled.join(leader.select("band"), "band", "left_semi").select("band", "x"), "left")
                other = left.select(F.col("band").alias("of"), F.col("x").alias("y"))
                company = left.join(other, (F.col("band") == F.col("of")) & near, "left_semi")
                wanted = company.select(F.col("x.doc").alias("wanted")).distinct()
                links = last_links(left, shingle_sets(docs, wanted, text_col, words, LONG_PLACES), known, similarity)
            found, folder = stored(links, "links")
        passing(docs.sparkSession, folder)
        known = known.unionByName(found)
    return known


def alike(x: str, y: str, similarity: float) -> Column:
    """Whether the numbers of shingles allow for the similarity."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    return F.least(n, m) >= F.greatest(n, m) * F.lit(similarity) - F.lit(1e-9)


def unlike(x: str, y: str, longs: int) -> Column:
    """Places in which two signatures differ."""
    total = F.lit(0)
    for i in range(longs):
        apart = F.col(f"{x}.s{i}").bitwiseXOR(F.col(f"{y}.s{i}"))
        total = total + F.bit_count(apart.bitwiseOR(F.shiftrightunsigned(apart, 1)).bitwiseAND(F.lit(LOWER)))
    return total


def shingle_sets(docs: DataFrame, wanted: DataFrame, text_col: str, words: int, places: int = 0) -> DataFrame:
    """``doc``, ``set`` (hashes of its shingles) and ``sig`` (a signature of so many places) of the ``wanted`` texts, as a table."""

    def each(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            for at in range(0, len(batch), TEXTS):
                found = [shingle_hashes(t, words) for t in batch.iloc[at : at + TEXTS]]
                signs = [signature(least_values(x, places)) if places else np.zeros(0, np.int64) for x in found]
                yield pd.DataFrame({"set": [x.view(np.int64) for x in found], "sig": signs})

    wanted = written(wanted, "wanted")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    # Any of several equal texts will do.
    texts = docs.select(text_hash(text_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    held = texts.join(wanted, F.col("doc") == F.col("wanted"), "left_semi").select(
        "doc", F.pandas_udf(each, "set array<long>, sig array<long>")(F.col("t")).alias("s"))
    with short_batches(docs.sparkSession):
        return written(held.groupBy("doc").agg(F.first("s").alias("s")).select("doc", "s.set", "s.sig"), "sets")


def last_links(left: DataFrame, sets: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """Links ``a``, ``b`` between the texts ``x`` of ``left``, each of a ``band`` and a part: all that their parts need.

    Shingles have an order, the rarest among the texts first. Two similar texts share one of their first shingles, as many
    as they may lack and one more; where the first that they share is in few texts, they meet by it, in numbers that grow
    with the texts. Else all that they share is in many texts: they meet by band if so many of their shingles are. Of a
    band, these meet the one first that has most such shingles, and the others of what is still apart then.
    """
    longs = LONG_PLACES // PLACES
    shingles = sets.select("doc", F.explode("set").alias("shingle"))
    few = written(shingles.groupBy("shingle").agg(
        F.count("*").alias("times"), F.min("doc.h").alias("h"), F.min("doc.i").alias("i")).where(F.col("times") <= FEW), "few")
    alone = few.where("times = 1").groupBy("h", "i").agg(F.count("*").alias("alone")).select(F.struct("h", "i").alias("whose"), "alone")
    rare = written(shingles.join(few.where("times > 1").select("shingle", "times"), "shingle"), "rare")
    some = rare.groupBy(F.col("doc").alias("which")).agg(F.count("*").alias("some"))
    signs = [F.col("sig")[i].alias(f"s{i}") for i in range(longs)]
    able = sets.join(alone, F.col("doc") == F.col("whose"), "left").join(some, F.col("doc") == F.col("which"), "left").select(
        "doc", F.size("set").alias("n"), F.coalesce("alone", F.lit(0)).alias("alone"), F.coalesce("some", F.lit(0)).alias("some"), *signs)
    # A text whose shingles are too much its own is similar to none of the others.
    able = able.where(F.col("n") - F.col("alone") >= F.col("n") * F.lit(similarity) - F.lit(1e-9))
    owners = left.select("x.doc", "x.node", "x.part").distinct()
    able = written(able.join(owners, "doc").withColumn("many", F.col("n") - F.col("alone") - F.col("some")), "able")
    common = written(left.select("band", "x.doc").distinct().join(
        able.where(F.col("many") >= F.col("n") * F.lit(similarity) - F.lit(1e-9)).select("doc"), "doc"), "common")

    x = F.struct("doc", "node", "part", "n", "many", *[f"s{i}" for i in range(longs)]).alias("x")
    near = (F.col("x.part") != F.col("y.part")) & alike("x", "y", similarity) & (
        unlike("x", "y", longs) <= tolerance(similarity, LONG_PLACES))
    many = F.least("x.many", "y.many")
    allowed = near & (many >= (F.col("x.n") + F.col("y.n") - many) * F.lit(similarity) - F.lit(1e-9))
    once = F.col("x.doc") < F.col("y.doc")

    texts = written(common.join(able, "doc").select("band", x), "band-texts")
    middle = texts.groupBy(F.col("band").alias("of")).agg(F.max_by("x", F.struct("x.many", "x.doc")).alias("y"))
    met = written(pairs_of(texts.join(middle, (F.col("band") == F.col("of")) & allowed)), "met")
    linked = written(verified(met, sets, similarity), "linked")

    named = components(known.unionByName(linked)).withColumnRenamed("node", "named")
    able = written(able.join(named, F.col("node") == F.col("named"), "left").withColumn(
        "part", F.coalesce("component", "node")).drop("named", "component"), "able")
    first = Window.partitionBy("doc").orderBy("times", "shingle")
    most = F.col("n") - F.ceil(F.col("n") * F.lit(similarity) - F.lit(1e-9)) + 1 - F.col("alone")
    begins = rare.join(able.select("doc", "n", "alone"), "doc").withColumn("place", F.row_number().over(first)).where(
        F.col("place") <= most).select("doc", "shingle")
    begins = written(begins.join(able, "doc").select("shingle", x), "begins")
    other = begins.select(F.col("shingle").alias("of"), F.col("x").alias("y"))
    by_few = pairs_of(begins.join(other, (F.col("shingle") == F.col("of")) & once & near))
    texts = common.join(able, "doc").select("band", x)
    apart = texts.groupBy("band").agg(F.min("x.part").alias("low"), F.max("x.part").alias("high")).where("low < high")
    texts = written(texts.join(apart.select("band"), "band"), "band-texts")
    other = texts.select(F.col("band").alias("of"), F.col("x").alias("y"))
    by_many = pairs_of(texts.join(other, (F.col("band") == F.col("of")) & once & allowed))
    met = written(by_few.unionByName(by_many).distinct(), "met")
    return linked.unionByName(verified(met, sets, similarity))


def pairs_of(met: DataFrame) -> DataFrame:
    """The texts and nodes of each two ``x``, ``y`` that have met, once."""
    return met.select(F.col("x.doc").alias("a_doc"), F.col("y.doc").alias("b_doc"),
                      F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def verified(met: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``a``, ``b`` of the pairs ``met`` whose ``sets`` are similar."""
    left = sets.select(F.col("doc").alias("a_doc"), F.col("set").alias("a_set"))
    right = sets.select(F.col("doc").alias("b_doc"), F.col("set").alias("b_set"))
    both = met.join(left, "a_doc").join(right, "b_doc")
    shared = F.size(F.array_intersect("a_set", "b_set"))
    return both.where(shared >= (F.size("a_set") + F.size("b_set") - shared) * F.lit(similarity) - F.lit(1e-9)).select("a", "b")
