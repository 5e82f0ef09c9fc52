"""One query for each operator, over its whole table, with SQL where that can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    archives,
    bpe,
    divergence,
    exact_dedup,
    language_id,
    license_scan,
    packing,
    quality_rules,
    secret_scan,
    simhash,
    sketch,
    suffix_dedup,
    term_matrix,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` states its result where SQL can."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, whose source is their host, and all pages, with what their markup and addresses say."""
    documents, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = language_id.fit(documents)
    of_documents = language_id.identify(documents, model, declared=F.col("lang"), host=F.col("source"))
    evidence = language_id.page_evidence(F.col("url"), F.col("html"))
    bare = pages.select("page_id", *[column.alias(name) for name, column in evidence.items()])
    of_pages = language_id.identify(
        bare, model, "page_id", **{name: F.col(name) for name in evidence if name != "text"})
    return of_documents.unionByName(of_pages, allowMissingColumns=True)


@query("op2_arc_to_warc")
def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc = archives.write_arc(table(spark, sf_dir, "pages"))
    records = archives.resolved(archives.read_warc(spark, archives.convert(spark, arc), payloads=False))
    return records.select(
        "page_id", F.col("payload_length").alias("payload_bytes"), "payload_digest", F.col("type").alias("record_type"),
        "refers_to", "record_id", "date",
    )


@query("op3_license_scan")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query("op6_document_fingerprints")
def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.edits(table(spark, sf_dir, "documents"))


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept")


@query("op8_exact_dedup", """
    WITH rows AS (
        SELECT doc_id, length(coalesce(text, '')) AS chars,
               sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
        FROM documents),
    grouped AS (
        SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size
        FROM rows)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM grouped""")
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(exact_dedup.normalised(F.col("text")), 256)
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), carry={"text_sha256": digest})


@query("op9_secret_scan")
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secret_scan.scan(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[secret_scan.count_kind(spans, kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secret_scan.span_text(secret_scan.base_spans(spans)), 256).alias("base_sha256"),
        secret_scan.span_text(spans).alias("spans"),
    )


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


@query("op11_quality_rules", """
    WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    cut AS (
        SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
               list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
        FROM texts),
    places AS (SELECT r, unnest(range(1, len(words) - 1)) AS place, words FROM cut),
    triples AS (SELECT r, place, words[place] || ' ' || words[place + 1] || ' ' || words[place + 2] AS w FROM places),
    counted AS (SELECT r, place, count(*) OVER (PARTITION BY r, w) AS n FROM triples),
    covered AS (
        SELECT r, count(DISTINCT word) AS n_repeat_words
        FROM (SELECT r, unnest([place, place + 1, place + 2]) AS word FROM counted WHERE n > 1) GROUP BY r),
    most AS (
        SELECT r, max(n) AS top
        FROM (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(words) AS word FROM cut) GROUP BY r, word) GROUP BY r),
    measures AS (
        SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
               len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
               len(list_filter(words, lambda w: regexp_matches(w, '\\pL'))) AS letters, len(lines) AS n_lines, coalesce(top, 0) AS top
        FROM cut LEFT JOIN covered USING (r) LEFT JOIN most USING (r)),
    judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measures)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR n_symbols * 10 > n_words OR word_chars < n_words * 2 OR word_chars > n_words * 15
                OR letters * 10 < n_words * 7 OR n_dup_lines * 2 > n_lines OR 10 * top > 3 * n_words) AS kept
    FROM judged""")
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"))


@query("op12_filter_interaction", """
    WITH RECURSIVE orders AS (
        SELECT '' AS filter_order
        UNION ALL
        SELECT filter_order || f FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) WHERE NOT contains(filter_order, f)),
    texts AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
               list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
        FROM documents),
    marks AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
    failed AS (
        SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
               CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
               || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
               || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
               || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
               || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
        FROM texts LEFT JOIN marks USING (doc_id)),
    cells AS (SELECT part, good, toxic, fails, count(*) AS n FROM failed GROUP BY ALL),
    steps AS (
        SELECT filter_order, step, filter_order[step] AS own, filter_order[1:step - 1] AS before
        FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) WHERE length(filter_order) = 5),
    cases AS (
        SELECT c.*, s.*, contains(fails, own) AS fails_own, length(translate(fails, before, '')) < length(fails) AS earlier
        FROM cells c, steps s),
    sums AS (
        SELECT part, filter_order, step, own,
               sum(CASE WHEN NOT fails_own AND NOT earlier THEN n ELSE 0 END) AS kept,
               sum(CASE WHEN fails_own AND NOT earlier THEN n ELSE 0 END) AS removed,
               sum(CASE WHEN fails_own AND earlier THEN n ELSE 0 END) AS redundant,
               sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
               sum(CASE WHEN fails_own AND NOT earlier AND good THEN n ELSE 0 END) AS good_lost,
               sum(CASE WHEN fails_own AND NOT earlier AND toxic THEN n ELSE 0 END) AS toxic_lost
        FROM cases GROUP BY ALL)
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
           CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
           CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
    FROM sums""")
def op12_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_matrix.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_source_divergence", """
    WITH texts AS (
        SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents),
    terms AS (
        SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts),
    kept AS (SELECT lang, term FROM terms GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
    counts AS (SELECT lang, source, term, count(*) AS n FROM terms JOIN kept USING (lang, term) GROUP BY ALL),
    langs AS (
        SELECT lang, coalesce(v, 0) AS v, coalesce(total, 0) AS total
        FROM (SELECT DISTINCT lang FROM texts) LEFT JOIN (SELECT lang, count(*) AS v FROM kept GROUP BY lang) USING (lang)
            LEFT JOIN (SELECT lang, sum(n) AS total FROM counts GROUP BY lang) USING (lang)),
    sources AS (
        SELECT lang, source, coalesce(t.total, 0) AS total, v
        FROM (SELECT DISTINCT lang, source FROM texts)
            LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) t USING (lang, source) JOIN langs USING (lang)),
    shares AS (
        SELECT lang, source, term, coalesce(n, 0) AS n,
               1 + 1000000000 * (coalesce(n, 0) + 5)::HUGEINT // (s.total + 5 * s.v)::HUGEINT AS p
        FROM sources s JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
    whole AS (
        SELECT lang, term, 1 + 1000000000 * (sum(n) + 5)::HUGEINT // (any_value(total) + 5 * any_value(v))::HUGEINT AS q
        FROM counts JOIN langs USING (lang) GROUP BY lang, term),
    found AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
        FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN (
                SELECT a.lang, a.source, b.source AS other, sum(abs(a.p - b.p)) AS value
                FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) d
            ON d.lang = a.lang AND d.source = a.source AND d.other = b.source
        UNION ALL
        SELECT lang, source, 'term', term, p - q FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
    FROM ranked WHERE part = 'pair' OR rank <= 50""")
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))
