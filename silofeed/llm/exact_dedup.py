"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Three passes, each over what the one before could not tell apart. The first two move a few numbers per row;
only rows that share both length and prefix hash with another row have their text read in full and hashed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import free_name, passing, scratch, stored, written

#: White space that does not count when texts are compared.
WHITE_SPACE = r"[\x20\x09-\x0D]+"

#: Characters of the normalised text that the second pass hashes.
PREFIX_CHARS = 128

#: Tasks that the rows of one length are dealt to.
SALTS = 64


def normalised(text: Column) -> Column:
    """The text without white space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None
) -> DataFrame:
    """For each row its group of equal texts: id, ``keep_id``, ``group_size``, ``kept``.

    Texts are equal when :func:`normalised` makes them identical. Of a group the row with the most characters stays,
    then the smallest id. ``carry`` names further columns that are computed from a row while it is scanned.

    Null text equals the empty one. Null ids sort last. Rows that repeat both id and text are reported as often as
    they occur and count in ``group_size``; ``kept`` holds for each row whose id is the group's ``keep_id``. Other
    columns of the table are ignored. An empty table gives no rows.
    """
    carry = carry or {}
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("chars"),
        normalised(F.col(text_col)).alias("norm"),
        *[column.alias(name) for name, column in carry.items()],
    )
    rows = rows.withColumn("size", F.length("norm")).withColumn(
        "prefix", F.xxhash64(F.left("norm", F.lit(PREFIX_CHARS)))
    )
    # Written at each step, so that texts are read twice at most: for the numbers, and for what is still undecided.
    narrow = written(rows.select("id", "chars", "size", "prefix", *carry), "lengths")

    sizes = narrow.groupBy("size").count().where("count > 1").select("size")
    # There are few lengths, and a third of all rows may have the same: each length goes to several tasks.
    spread = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = narrow.select("id", "size", "prefix", F.pmod(F.xxhash64("id", "prefix"), F.lit(SALTS)).cast("int").alias("salt"))
    same_size = salted.join(spread, ["size", "salt"], "left_semi").drop("salt")
    prefixes = same_size.groupBy("size", "prefix").count().where("count > 1").select("size", "prefix")

    # Ids of the rows that are still undecided; the texts of these alone are hashed in full.
    undecided = written(same_size.join(prefixes, ["size", "prefix"], "left_semi").select("id").distinct(), "undecided")
    decided = narrow.join(undecided, narrow["id"].eqNullSafe(undecided["id"]), "left_anti")
    survivors = rows.join(undecided, rows["id"].eqNullSafe(undecided["id"]), "left_semi")
    hashed = written(survivors.select("id", "chars", *carry, F.sha2("norm", 256).alias("full")), "hashed")

    # min over a struct ranks by more characters, then the id; nulls last.
    rank = F.min(F.struct((-F.col("chars")).alias("fewer"), F.col("id").isNull().alias("no_id"), F.col("id")))
    groups = hashed.groupBy("full").agg(rank.alias("first"), F.count("*").alias("group_size"))
    members = hashed.join(groups, "full").select(
        "id", *carry, F.col("first.id").alias("keep_id"), "group_size"
    )
    alone = decided.select("id", *carry, F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    return members.unionByName(alone).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), *carry
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_duplicates` keeps, with all their columns.

    A row that repeats both id and text of another is the same document: one of them stays.
    """
    names = {n: free_name(docs, n) for n in ("gone_id", "gone_hash", "same_text")}
    text_hash = F.xxhash64(F.col(text_col))
    keys = [F.col(id_col).alias(names["gone_id"]), F.col(names["same_text"]).alias(names["gone_hash"])]
    same = F.col(id_col).eqNullSafe(F.col(names["gone_id"])) & (text_hash == F.col(names["gone_hash"]))
    with scratch():
        found = exact_duplicates(docs, id_col, text_col, {names["same_text"]: text_hash})
        gone, folder = stored(found.where(~F.col("kept")).select(keys).distinct(), "gone")
        repeated = found.where("kept").groupBy(keys).count().where("count > 1").select(names["gone_id"], names["gone_hash"])
        repeated, other = stored(repeated, "repeated")
    for made in (folder, other):
        passing(docs.sparkSession, made)
    kept = docs.join(gone, same, "left_anti")
    once = kept.join(repeated, same, "left_anti")
    more = kept.join(repeated, same, "left_semi").dropDuplicates([id_col, text_col])
    return once.unionByName(more)
