"""Secret scans with an incremental ledger of blobs.

Every version of every document is addressed by the hash of its content. A ledger holds which pairs of blob and rule
version have been scanned, and what was found. A scan reads the text of unseen pairs only, once for each blob however
many paths hold it, and joins the findings back to all paths.
"""

from __future__ import annotations

import hashlib
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..workspace import folder_exists
from .tables import free_name, passing, scratch, stored, written


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, the group whose length counts, and the least length of that group.

    Matches are leftmost and do not overlap; those that are too short are dropped afterwards. ``base`` rules are those
    whose spans are counted and digested.
    """

    kind: str
    pattern: str
    group: int
    least: int
    base: bool = True


def pem_block() -> str:
    """A private key in PEM, from its BEGIN line to the matching END line, before any other BEGIN or END.

    Where that is missing, the headers and base64 lines that follow, also with ``\\n`` written out. Repetition is of
    single characters or bounded, as Java's expressions recurse for every turn of a group.
    """
    gap = r"""(?:[\s"',+>#*|]|\\[nr])"""
    header = r"(?:(?:Proc-Type|DEK-Info):\s*\S+|(?:Version|Comment|Hash|Charset):[^\r\n]*)"
    line = r"""(?:[A-Za-z0-9+/]{24}|[A-Za-z0-9+/]{2,23}=|(?:[A-Za-z0-9+/]{4}){1,5}(?=["',]{0,2}(?:[\r\n]|\\[nr]|\z)))"""
    ended = r"(?>[\s\S]*?(?=-----(?:BEGIN|END) ))-----END \1PRIVATE KEY\2-----"
    open_end = rf"(?:{gap}{{0,40}}{header}){{0,6}}(?>[\s\S]*?(?![A-Za-z0-9+/=])(?!{gap}{{1,40}}{line}))"
    return rf"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY((?: BLOCK)?)-----(?:{ended}|{open_end})"


#: The base kinds in their order, then what this scan adds.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
    Rule("pem", pem_block(), 0, 1, base=False),
)

#: Runs of hex digits are everywhere in prose; only runs of this pattern can pass the length test.
FASTER = {r"[0-9a-f]+": r"(?<![0-9a-f])[0-9a-f]{24,}"}

SPAN = "struct<kind: string, rank: int, start: int, stop: int>"
LEDGER = f"blob string, rule_version string, spans array<{SPAN}>"


def blob_id(text: Column) -> Column:
    """Address of a text; null is the empty text."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of a rule in code points, end exclusive.

    The pieces between matches and the matches themselves come from the same left-to-right search, so a match starts
    where the pieces and matches before it end.
    """
    pattern = F.lit(FASTER.get(rule.pattern, rule.pattern))
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, FASTER.get(rule.pattern, rule.pattern), -1)
    lengths = F.transform(found, lambda m: F.length(m))
    starts = F.aggregate(
        F.zip_with(F.slice(F.transform(pieces, lambda p: F.length(p)), 1, F.size(found)), lengths,
                   lambda gap, n: F.struct(gap.alias("gap"), n.alias("n"))),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda state, x: F.struct(
            (state["at"] + x["gap"] + x["n"]).alias("at"),
            F.array_append(state["starts"], state["at"] + x["gap"]).alias("starts"),
        ),
        lambda state: state["starts"],
    )
    long_enough = F.transform(found, lambda m: F.length(F.regexp_extract(m, rule.pattern, rule.group)) >= rule.least)
    spans = F.filter(
        F.zip_with(F.arrays_zip(starts.alias("start"), lengths.alias("n")), long_enough,
                   lambda x, ok: F.struct(ok.alias("ok"), F.lit(rule.kind).alias("kind"), F.lit(rank).alias("rank"),
                                          x["start"].alias("start"), (x["start"] + x["n"]).alias("stop"))),
        lambda s: s["ok"],
    )
    some = F.transform(spans, lambda s: F.struct(s["kind"], s["rank"], s["start"], s["stop"])).cast(f"array<{SPAN}>")
    return F.when(F.regexp_like(text, pattern), some).otherwise(F.array().cast(f"array<{SPAN}>"))


def all_spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans of all rules, ordered by start, then by the order of the rules."""
    spans = F.concat(*[rule_spans(text, rule, rank) for rank, rule in enumerate(rules)])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["stop"], s["kind"])))
    return F.transform(ordered, lambda s: F.struct(s["kind"], s["rank"], s["start"], s["stop"])).cast(f"array<{SPAN}>")


def version_of(rules: tuple[Rule, ...]) -> str:
    """Version of a set of rules: any change of a rule, or of their order, gives another one."""
    return hashlib.sha256(repr([astuple(rule) for rule in rules]).encode()).hexdigest()[:16]


def empty_ledger(spark: SparkSession) -> DataFrame:
    empty = [F.lit(None).cast(field.dataType).alias(field.name) for field in StructType.fromDDL(LEDGER)]
    return spark.range(0).select(*empty)


def scan_blobs(
    docs: DataFrame, ledger: DataFrame, rule_version: str | None = None, rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Rows to add to the ledger: ``blob``, ``rule_version``, ``spans`` of each pair that it does not hold yet.

    The version of the rules is :func:`version_of` them, unless the caller names one of its own.

    One row that holds a blob is picked from ids and hashes alone; then the text of just these rows is read. Null text
    is the empty blob; ids may repeat and be null. No unseen pairs give no rows.
    """
    rule_version = rule_version or version_of(rules)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    blobs = texts.select("id", blob_id(F.col("text")).alias("blob"))
    seen = ledger.where(F.col("rule_version") == rule_version).select("blob")
    unseen = blobs.groupBy("blob").agg(F.min("id").alias("holder")).join(seen, "blob", "left_anti")
    held = texts.withColumn("blob", blob_id(F.col("text"))).join(
        unseen.withColumnRenamed("blob", "wanted"),
        (F.col("blob") == F.col("wanted")) & F.col("id").eqNullSafe(F.col("holder")), "left_semi",
    )
    scanned = held.select("blob", F.lit(rule_version).alias("rule_version"), all_spans(F.col("text"), rules).alias("spans"))
    return scanned.dropDuplicates(["blob"])


def findings(
    docs: DataFrame, ledger: DataFrame, rule_version: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Findings of the ledger at every row of ``docs``: id, ``blob``, ``spans``; unscanned blobs have null spans."""
    rule_version = rule_version or version_of(rules)
    paths = docs.select(F.col(id_col), blob_id(F.col(text_col)).alias("blob"))
    known = ledger.where(F.col("rule_version") == rule_version).select("blob", "spans")
    return paths.join(known, "blob", "left")


def scan(docs: DataFrame, ledger: DataFrame | None = None, rule_version: str | None = None,
         rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Scan what the ledger has not seen; the findings of every row, and the ledger with the new pairs."""
    rule_version = rule_version or version_of(rules)
    ledger = ledger if ledger is not None else empty_ledger(docs.sparkSession)
    new = written(scan_blobs(docs, ledger, rule_version, rules, id_col, text_col), "ledger")
    ledger = ledger.unionByName(new)
    return findings(docs, ledger, rule_version, id_col, text_col), ledger


def stored_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger kept at ``path``; empty where there is none yet. A pair that a repeated run has added twice comes once."""
    if not folder_exists(spark, path):
        return empty_ledger(spark)
    return spark.read.schema(LEDGER).parquet(path).dropDuplicates(["blob", "rule_version"])


def scan_with_store(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """The findings of every row, by the ledger kept at ``path``, to which what is scanned now is added.

    Only blobs that were never scanned with these rules are read again. A run that fails adds nothing.
    """
    spark = docs.sparkSession
    new = written(scan_blobs(docs, stored_ledger(spark, path), None, rules, id_col, text_col), "ledger")
    new.write.mode("append").parquet(path)
    return findings(docs, stored_ledger(spark, path), None, id_col, text_col, rules)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))


def base_spans(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    kinds = [rule.kind for rule in rules if rule.base]
    return F.filter(spans, lambda s: s["kind"].isin(kinds))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by ``[kind]`` of its first span."""
    state = F.struct(F.lit(1).alias("at"), F.lit("").alias("done"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, state,
        lambda st, s: F.when(s["stop"] < st["at"], st).otherwise(F.struct(
            (s["stop"] + 1).alias("at"),
            F.when(s["start"] + 1 >= st["at"],
                   F.concat(st["done"], F.substring(text, st["at"], s["start"] + 1 - st["at"]), F.lit("["), s["kind"], F.lit("]")),
            ).otherwise(st["done"]).alias("done"),
        )),
        lambda st: F.concat(st["done"], F.substr(text, st["at"])),
    ))


def redact(docs: DataFrame, ledger: DataFrame | None = None, rule_version: str | None = None, rules: tuple[Rule, ...] = RULES,
           id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """All rows of ``docs`` with their secrets :func:`redacted`; ``length_col``, if given, becomes the new text's length.

    Null text stays null. The blobs with findings are written first; few of them are broadcast and texts stay in place.
    """
    rule_version = rule_version or version_of(rules)
    blob, spans, new = (free_name(docs, name) for name in ("blob", "spans", "redacted"))
    with scratch():
        _, known = scan(docs, ledger, rule_version, rules, id_col, text_col)
        found = known.where((F.col("rule_version") == rule_version) & (F.size("spans") > 0))
        found = found.select(F.col("blob").alias(blob), F.col("spans").alias(spans)).dropDuplicates([blob])
        found, folder = stored(found, "findings")
    passing(docs.sparkSession, folder)
    joined = docs.join(found, blob_id(F.col(text_col)) == F.col(blob), "left")
    text = F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(redacted(F.col(text_col), F.col(spans)))
    columns = {c: F.col(c) for c in docs.columns} | {text_col: F.col(new)}
    if length_col:
        length = F.length(new).cast(docs.schema[length_col].dataType)
        columns[length_col] = F.when(F.col(spans).isNull(), F.col(length_col)).otherwise(length)
    return joined.withColumn(new, text).select(*[column.alias(name) for name, column in columns.items()])
