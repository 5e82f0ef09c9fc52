"""How sources of one language differ in their words.

Identical texts of a language are collapsed first, with the number of copies in each source; texts without copies stay
where they are. Each text is then cut into terms once; its terms count as often as it has copies. Counts add up in the tasks before they are shuffled. Terms that
enough documents of a language hold are kept, and sources are compared in integers.

A source lacks most terms, and all terms that it lacks have the same share. So the distance of two sources is summed
over the terms that both hold; what one of them lacks follows from how many of its terms have which count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import short_batches, written
from .workers import importable

#: Documents of a language that a kept term is in, parts of a whole, what is added to each count, and ranks of terms.
LEAST, PARTS, ADDED, RANKS = 30, 1_000_000_000, 5, 50
#: Sources of a text that are listed in one row, and sums that a task holds before it passes them on.
LISTED, HELD = 1 << 10, 1 << 19
#: Lower-cases A to Z; other bytes of ASCII but letters become blanks.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of letters and of characters beyond ASCII, only A to Z lower-cased."""
    return text.translate(TABLE).split()


def collapsed(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """Copies ``n`` by ``lang``, ``content`` and ``source``, and each ``text`` once by ``lang`` and ``content``.

    ``content`` is a SHA-256 of the text. Nulls are empty texts, languages and sources.
    """
    empty = F.lit("")
    rows = docs.select(
        F.coalesce(F.col(lang_col), empty).alias("lang"), F.coalesce(F.col(source_col), empty).alias("source"),
        F.coalesce(F.col(text_col), empty).alias("text"))
    rows = rows.withColumn("content", F.unhex(F.sha2("text", 256)))
    copies = written(rows.groupBy("lang", "content", "source").agg(F.count("*").alias("n")), "copies")
    texts = rows.select("lang", "content", F.col("text").cast("binary").alias("text")).dropDuplicates(["lang", "content"])
    return copies, texts


def plain(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang``, ``source``, ``text`` and ``name``, a 64-bit hash of language and text; nulls are empty."""
    rows = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    return rows.withColumn("name", F.xxhash64("lang", "text"))


def once_each(rows: DataFrame) -> DataFrame:
    """Texts by ``lang`` as bytes, with the lists ``source`` and ``n`` of their copies by source. ``rows`` come from :func:`plain`.

    A text that has its name for itself stays where it is; only those that may have copies are shuffled and collapsed. The names
    of these are written first, so that Spark knows their size. A text with more sources than ``LISTED`` comes once for
    each list of so many.
    """
    names = rows.groupBy("name").agg(F.count("*").alias("times")).where("times > 1").select(F.col("name").alias("several"))
    names = written(names, "names")
    met = F.col("name") == F.col("several")
    alone = rows.join(names, met, "left_anti").select(
        "lang", F.col("text").cast("binary").alias("text"), F.array("source").alias("source"),
        F.array(F.lit(1).cast("long")).alias("n"))
    alone = alone.sortWithinPartitions("lang", "source")  # sums of one source come together, and are passed on once
    copies, texts = collapsed(rows.join(names, met, "left_semi").select("lang", "source", "text"))
    within = Window.partitionBy("lang", "content").orderBy("source")
    lists = copies.withColumn("list", F.floor((F.row_number().over(within) - 1) / LISTED)).groupBy("lang", "content", "list").agg(
        F.collect_list(F.struct("source", "n")).alias("sources"))
    several = texts.join(lists, ["lang", "content"]).select("lang", "text", "sources.source", "sources.n")
    return alone.unionByName(several)


def weighted_sums(rows: DataFrame) -> DataFrame:
    """Parts of sums ``n`` by ``lang``, ``source`` and ``term``: occurrences, and documents where ``source`` is null.

    ``rows`` are those of :func:`once_each`.
    """
    importable(rows.sparkSession)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str | None], Counter] = {}
        size = 0
        for batch in batches:
            for lang, text, sources, copies in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                found = Counter(terms_of(text))
                for source, n in zip([*sources, None], [*copies, sum(copies)], strict=True):
                    into = held.setdefault((lang, source), Counter())
                    size -= len(into)
                    for term, times in found.items():
                        into[term] += times * n if source is not None else n
                    size += len(into)
                if size >= HELD:
                    yield from _flush(held)
                    held, size = {}, 0
        yield from _flush(held)

    return rows.mapInArrow(sums, "lang string, source string, term binary, n bigint")


def _flush(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), sums in held.items():
        size = len(sums)
        if size:
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
                 pa.array(list(sums), pa.binary()), pa.array(list(sums.values()), pa.int64())],
                ["lang", "source", "term", "n"])


def share(count: Column, total: Column, kept: Column) -> Column:
    """Parts of a whole that a term with ``count`` of ``total`` occurrences has, among ``kept`` terms; exact."""
    whole = F.lit(PARTS).cast("decimal(10,0)") * (count + ADDED).cast("decimal(20,0)")
    return F.call_function("div", whole, (total + kept * ADDED).cast("decimal(20,0)")) + 1


def distance(a: Column, b: Column) -> Column:
    return F.abs(a - b)


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          least: int = LEAST, ranks: int = RANKS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: how each source differs, and by which terms.

    Terms in at least ``least`` documents of a language are kept for it. A source gives each kept term a share, see
    :func:`share`, and so does the language as a whole. Part ``pair`` has the sum of differences to each other source of
    the language; part ``term`` the terms that a source has more of than its language, up to ``ranks`` of them.

    Nulls are empty texts, languages and sources. Repeated rows are documents of their own; ids and other columns are
    ignored. A source whose documents hold no terms has pairs, and no terms. An empty table gives no rows.
    """
    rows = plain(docs, text_col, lang_col, source_col)
    with short_batches(docs.sparkSession):
        parts = written(weighted_sums(once_each(rows)), "sums", "zstd")
    kept = parts.where("source IS NULL").groupBy("lang", "term").agg(F.sum("n").alias("documents")).where(
        F.col("documents") >= least).select("lang", "term")
    kept = written(kept, "terms")
    # Most terms are not kept: the few that are make a hash table in each task, and the many need not be sorted.
    counts = parts.where("source IS NOT NULL").join(kept.hint("shuffle_hash"), ["lang", "term"], "left_semi").groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"))
    counts = written(counts, "counts")

    size = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    per_source = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    zero = F.lit(0).cast("long")
    groups = rows.select("lang", "source").distinct().join(per_source, ["lang", "source"], "left").join(size, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "held", "kept")])
    # Without kept terms there is nothing to divide by, and no difference.
    none = F.when(F.col("kept") == 0, zero).otherwise(share(zero, F.col("total"), F.greatest("kept", F.lit(1))))
    groups = written(groups.withColumn("none", none), "groups")

    shares = counts.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))
    pairs = pair_distances(groups, shares)
    result = ranked(pairs, "pair").unionByName(ranked(prominent(counts, groups, shares), "term").where(F.col("rank") <= ranks))
    return result


def pair_distances(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item``, ``value`` of each two sources of a language, both ways.

    Were no term held by both, a source's terms would each differ from the other's share of a term that it lacks. Those
    sums come from the number of terms by count, then the terms that both hold are set right.
    """
    mine = groups.select("lang", F.col("source").alias("a"), F.col("none").alias("a_none"), F.col("held").alias("a_held"))
    other = groups.select("lang", F.col("source").alias("b"), F.col("none").alias("b_none"), F.col("held").alias("b_held"), "kept")
    both = mine.join(other, "lang").where("a <> b")
    # A source has few different counts; each weighs as many terms as have it.
    steps = shares.groupBy("lang", F.col("source").alias("a"), "p").agg(F.count("*").alias("terms"))
    apart = steps.join(other.select("lang", "b", "b_none"), "lang").where("a <> b").groupBy("lang", "a", "b").agg(
        F.sum(F.col("terms") * distance(F.col("p"), F.col("b_none"))).alias("apart"))
    left = shares.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("p"), F.col("none").alias("a_none"))
    right = shares.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("q"), F.col("none").alias("b_none"))
    p, q, u, v = (F.col(c) for c in ("p", "q", "a_none", "b_none"))
    change = distance(p, q) - distance(p, v) - distance(q, u) + distance(u, v)
    shared = left.join(right, ["lang", "term"]).where("a < b").groupBy("lang", "a", "b").agg(F.sum(change).alias("shared"))
    shared = shared.unionByName(shared.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "shared"))
    zero = F.lit(0).cast("long")
    back = apart.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("apart").alias("back"))
    found = both.join(apart, ["lang", "a", "b"], "left").join(back, ["lang", "a", "b"], "left").join(
        shared, ["lang", "a", "b"], "left")
    lacking = (F.col("kept") - F.col("a_held") - F.col("b_held")) * distance(F.col("a_none"), F.col("b_none"))
    value = F.coalesce("apart", zero) + F.coalesce("back", zero) + F.coalesce("shared", zero) + lacking
    return found.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), value.cast("long").alias("value"))


def prominent(counts: DataFrame, groups: DataFrame, shares: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item``, ``value`` of the terms that a source has a larger share of than its language."""
    langs = groups.groupBy("lang").agg(F.sum("total").alias("all"), F.max("kept").alias("all_kept"))
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("in_all")).join(langs, "lang").select(
        "lang", "term", share(F.col("in_all"), F.col("all"), F.col("all_kept")).alias("q"))
    return shares.join(whole, ["lang", "term"]).where("p > q").select(
        "lang", "source", F.col("term").cast("string").alias("item"), (F.col("p") - F.col("q")).alias("value"))


def ranked(found: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
