"""Language identification by Bayesian fusion of what the text, its markup, its address and its host say.

The text's likelihood is that of a model of byte trigrams, fitted on a bounded sample of labelled rows. What a text alone
suggests is then counted over all rows, by declared language, by address suffix, by host and by the host's parent: these
grouped counts give the likelihoods of a declaration and of a suffix under each language, and a prior for each host that
is smoothed towards its parent's, which is smoothed towards that of all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import free_name, short_batches, text_key, without, written
from .workers import importable

#: Labelled rows of each language that the text model is fitted on, as expected by hash; all, where there are fewer.
SAMPLE = 4000
#: Codes of byte trigrams, and bytes of text that are scored together.
CODES = 1 << 16
PIECE = 1 << 20
#: Trigrams overlap, so a text is worth a third of their evidence.
OVERLAP = 3.0
#: Weight of a parent's prior in rows, of a language that no label names, and least probability of a result.
PARENT_ROWS = 20.0
UNKNOWN_PRIOR = 1e-3
LEAST = 0.5
UNKNOWN = "und"

#: Letters as lower case, bytes of other scripts as such, anything else as a blank.
LETTERS = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class TextModel:
    """Log likelihood of each trigram code under each language; the last column is the unknown language."""

    languages: tuple[str, ...]
    table: np.ndarray


def codes_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes of texts laid end to end, and where the codes of each text start. Codes of blanks alone are 0."""
    parts = [b"  " + (t or "").encode("utf-8", "replace").translate(LETTERS) + b" " for t in texts]
    lengths = np.array([len(p) for p in parts], np.int64)
    data = np.frombuffer(b"".join([*parts, b"  "]), np.uint8).astype(np.uint32)
    joined = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    codes = ((joined * np.uint32(2654435761)) >> np.uint32(16)).astype(np.uint16)
    codes[(data[:-2] == 32) & (data[1:-1] == 32) & (data[2:] == 32)] = 0
    return codes, np.cumsum(lengths) - lengths


def fit(docs: DataFrame, text_col: str = "text", label_col: str = "lang", sample: int = SAMPLE) -> TextModel:
    """A model of the labels' languages from about ``sample`` rows of each, picked by a hash of the text.

    Every label is a language of the model, which has 256 kB for each; labels that differ in case or blanks around them
    are one. Rows without label or text are not used. Rows of one label count by the same hash wherever they lie, so the sample
    is the same in every run.
    """
    spark = docs.sparkSession
    importable(spark)
    labelled = docs.select(normal(F.col(label_col)).alias("label"), F.col(text_col).alias("text")).where(
        "label IS NOT NULL AND text IS NOT NULL")
    sizes = labelled.groupBy("label").count().orderBy("label").collect()
    languages = tuple(r["label"] for r in sizes)
    if not languages:
        return TextModel((), np.zeros((CODES, 1), np.float32))
    # An Arrow table, since rows of Python's would start workers of another kind, which then wait beside those of the functions.
    shares = spark.createDataFrame(pa.table({
        "label": pa.array(languages, pa.string()), "at": pa.array(range(len(languages)), pa.int32()),
        "share": [min(1.0, sample / r["count"]) for r in sizes]}))
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    picked = labelled.join(F.broadcast(shares), "label").where(draw < F.col("share")).select("at", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            totals: dict[int, np.ndarray] = {}
            for at, texts in batch.groupby("at")["text"]:
                for some in _pieces(texts.tolist()):
                    counts = np.bincount(codes_of(some)[0], minlength=CODES)
                    totals[at] = totals.get(at, 0) + counts
                code = np.flatnonzero(totals[at])
                yield pd.DataFrame({"at": at, "code": code, "n": totals.pop(at)[code]})

    counted = picked.mapInPandas(count, "at int, code int, n long").groupBy("at", "code").agg(F.sum("n").alias("n"))
    with short_batches(spark):
        rows = counted.toPandas()  # at most CODES rows for each language
    logs = np.zeros((CODES, len(languages) + 1), np.float32)
    of = dict(iter(rows.groupby("at")))
    for at in range(len(languages) + 1):  # one column at a time: only the model itself grows with the languages
        column = np.full(CODES, 0.1 if at < len(languages) else 1.0)
        if at in of:
            column[of[at]["code"]] += of[at]["n"]
        column[0] = 0
        logs[1:, at] = np.log(column[1:] / column.sum())
    return TextModel(languages, logs)


def normal(name: Column) -> Column:
    """Names of languages, hosts and so on, without regard to case and blanks around them; empty ones are null."""
    return F.nullif(F.lower(F.trim(name.cast("string"))), F.lit(""))


def _pieces(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Lists of texts of about a piece each, so that one batch needs bounded memory; a longer text is one list."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text or "")
        if size >= PIECE:
            yield some
            some, size = [], 0
    if some:
        yield some


def log_likelihoods(texts: list[str | None], model: TextModel) -> np.ndarray:
    """One row for each text, one column for each language and the unknown one."""
    out = []
    for some in _pieces(texts):
        codes, starts = codes_of(some)
        total = np.zeros((len(some), model.table.shape[1]))
        for column in range(model.table.shape[1]):
            total[:, column] = np.add.reduceat(model.table[:, column][codes], starts, dtype=np.float64)
        out.append(total)
    return np.concatenate(out) if out else np.zeros((0, model.table.shape[1]))


def counts_by(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """``votes``: for each key, how many rows have each language as their text's best."""
    each = rows.groupBy(*keys, "best").agg(F.count("*").cast("double").alias("n"))
    found = each.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("found"))
    votes = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.coalesce(F.element_at("found", i), F.lit(0.0)))
    return found.select(*keys, votes.alias("votes"))


def smoothed(votes: Column, parent: Column) -> Column:
    """Shares of the votes with the parent's shares added as ``PARENT_ROWS`` rows."""
    total = F.aggregate(votes, F.lit(0.0), lambda a, x: a + x) + F.lit(PARENT_ROWS)
    return F.zip_with(votes, parent, lambda v, p: (v + p * F.lit(PARENT_ROWS)) / total)


def identify(rows: DataFrame, model: TextModel, id_col: str = "doc_id", text_col: str = "text",
             declared: Column | None = None, suffix: Column | None = None, host: Column | None = None,
             parent: Column | None = None, least: float = LEAST) -> DataFrame:
    """Id, ``lang``, ``probability``, ``text_lang`` (of the text alone) and ``accepted`` of each row.

    ``declared`` is the language that the markup states, ``suffix`` the address's, ``host`` and ``parent`` (say, its
    domain) whence it comes; null, or a column that is not given, is no evidence. A row is accepted if its text has a
    letter and its language is a known one with the probability ``least``.

    Null text is the empty one: it says nothing, so the other evidence decides, and the row is not accepted. Repeated
    rows count, and are reported, as often as they occur. Without languages in the model all rows are ``und``.
    """
    spark = rows.sparkSession
    importable(spark)
    n = len(model.languages)
    shared = spark.sparkContext.broadcast(model)  # of bounded size: CODES by languages

    @F.pandas_udf("array<double>")
    def text_scores(texts: pd.Series) -> pd.Series:
        return pd.Series(list(log_likelihoods(texts.tolist(), shared.value) / OVERLAP), dtype=object)

    none = F.lit(None).cast("string")
    given = lambda c: none if c is None else normal(c)
    evidence = rows.select(
        F.col(id_col).alias("id"), text_scores(F.col(text_col)).alias("text"),
        F.regexp_like(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"\p{L}")).alias("letters"),
        given(declared).alias("declared"), given(suffix).alias("suffix"), given(host).alias("host"),
        given(parent).alias("parent"),
    )
    best = (F.array_position("text", F.array_max("text")) - 1).cast("int")
    with short_batches(spark):
        scored = written(evidence.withColumn("best", F.when(F.col("letters"), best)), "text-scores")

    voters = scored.where("best IS NOT NULL")
    prior = F.array(*[F.lit((1 - UNKNOWN_PRIOR) / max(n, 1)) for _ in range(n)], F.lit(UNKNOWN_PRIOR))
    overall = dict(voters.groupBy("best").count().collect())
    totals = [float(overall.get(i, 0)) for i in range(n + 1)]
    everywhere = smoothed(F.array(*[F.lit(x) for x in totals]), prior)
    of_parent = counts_by(voters.where("parent IS NOT NULL"), ["parent"], n + 1).withColumnRenamed("votes", "parent_votes")
    of_host = counts_by(voters.where("host IS NOT NULL"), ["host"], n + 1).withColumnRenamed("votes", "host_votes")

    def likelihood(kind: str) -> DataFrame:
        """Log of the share of a language's rows that have this value, one added to each value."""
        votes = counts_by(voters.where(f"{kind} IS NOT NULL"), [kind], n + 1)
        logs = F.zip_with("votes", F.array(*[F.lit(x + 100.0) for x in totals]), lambda v, t: F.log((v + 1) / t))
        return votes.select(F.col(kind).alias(f"{kind}_value"), logs.alias(f"{kind}_log"))

    joined = scored
    for kind in ("declared", "suffix"):
        table = likelihood(kind)
        joined = joined.join(table, F.col(kind) == F.col(f"{kind}_value"), "left")
    joined = joined.join(of_parent, "parent", "left").join(of_host, "host", "left")

    nothing = F.array(*[F.lit(0.0)] * (n + 1))
    from_parent = F.when(F.col("parent_votes").isNull(), everywhere).otherwise(smoothed(F.col("parent_votes"), everywhere))
    # A row's own vote is left out of its host's prior.
    others = F.transform(F.col("host_votes"), lambda v, i: v - F.when(i == F.col("best"), 1.0).otherwise(0.0))
    from_host = F.when(F.col("host_votes").isNull(), F.col("from_parent")).otherwise(smoothed(others, F.col("from_parent")))
    fused = joined.withColumn("from_parent", from_parent).withColumn("prior", from_host)
    score = F.transform(F.col("prior"), lambda p: F.log(F.greatest(p, F.lit(1e-12))))
    for part in (F.col("text"), F.coalesce("declared_log", nothing), F.coalesce("suffix_log", nothing)):
        score = F.zip_with(score, part, lambda a, b: a + b)
    top = F.array_max("score")
    mass = F.aggregate(F.col("score"), F.lit(0.0), lambda a, s: a + F.exp(s - top))
    names = F.array(*[F.lit(x) for x in (*model.languages, UNKNOWN)])
    result = fused.withColumn("score", score).select(
        F.col("id").alias(id_col), F.get(names, (F.array_position("score", top) - 1).cast("int")).alias("lang"),
        F.round(1 / mass, 6).alias("probability"), F.get(names, F.col("best")).alias("text_lang"), "letters")
    known = (F.col("lang") != UNKNOWN) & (F.col("probability") >= least) & F.col("letters")
    return result.select(id_col, "lang", "probability", "text_lang", known.alias("accepted"))


def drop_unknown(docs: DataFrame, model: TextModel, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST,
                 **evidence: Column) -> DataFrame:
    """The rows of ``docs`` that :func:`identify` accepts, with all their columns."""
    key = free_name(docs, "document")
    found = identify(docs.withColumn(key, text_key(id_col, text_col)), model, key, text_col, least=least, **evidence)
    return without(docs, found.where("NOT accepted").select(key), id_col, text_col)


def page_evidence(url: Column, html: Column) -> dict[str, Column]:
    """What a page's address and markup give: declared language, suffix, host, parent and bare text."""
    address = F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#:]*)", 1)
    folder = F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]*/([a-z]{2})(?:[/?#]|$)", 1)
    last = F.regexp_extract(address, r"\.([A-Za-z]+)$", 1)
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-z]+;", " ")
    return {
        "declared": F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]+)", 1),
        "suffix": F.concat_ws("/", last, folder), "host": address,
        "parent": F.regexp_extract(address, r"([^.]+\.[^.]+)$", 1), "text": bare,
    }
