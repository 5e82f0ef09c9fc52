"""Quality rules as a cascade that stops at the first rule a document fails.

A rule fails documents by measures of their text. What a rule costs and whom it rejects is estimated on a bounded sample;
the rules then run in the order of rejections per cost, each counted among the documents that the rules before it leave.
The order decides how much is computed, never which documents stay: a document stays when it fails no rule.

Everything is built of SQL functions, row by row and without a shuffle.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import free_name, written

#: White space between words, and what counts as a symbol.
SPACE, SYMBOL = r"[\x20\x09-\x0D]+", r"[#*$%&|<>]"
#: Words of a window that counts as repeated when the text holds it twice.
WINDOW = 3
#: Rows of the sample (as expected; it is drawn at random) that costs and rejections are estimated on.
SAMPLE = 1000
#: Seconds of a rule that compares columns only, or whose time cannot be told from that of reading.
LEAST_SECONDS = 1e-4


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words of a text; null and white space have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def lines_of(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))


def windows(words: Column, make: Callable[[list[Column], Column], Column]) -> Column:
    """``make`` of the words and the place of each window, in order."""
    places = F.sequence(F.lit(0), F.size(words) - WINDOW)
    return F.transform(places, lambda at: make([F.get(words, at + i) for i in range(WINDOW)], at))


def following(ranked: Column, same: Callable[[Column, Column], Column]) -> Column:
    """Whether each item and the next one are the same; the last has no next one."""
    return F.zip_with(ranked, F.slice(ranked, F.lit(2), F.size(ranked)), lambda a, b: F.coalesce(same(a, b), F.lit(False)))


def covered(ranked: Column, follows: Column) -> Column:
    """Words in the windows that are the same as their neighbour in ``ranked``."""
    repeats = let(follows, lambda next_: F.transform(ranked, lambda x, k: F.when(
        F.get(next_, k) | F.coalesce(F.get(next_, k - 1), F.lit(False)), x["at"])))
    # A window covers its own words up to the next one's first.
    return let(F.sort_array(F.filter(repeats, lambda at: at.isNotNull())), lambda places: F.aggregate(
        F.zip_with(places, F.slice(places, F.lit(2), F.size(places)),
                   lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
        F.lit(0), lambda sum_, n: sum_ + n))


def repeated_words(words: Column) -> Column:
    """Number of words in windows that occur twice or more.

    Windows are ranked by hash and those of one hash compared by their words. Where different windows share a hash, all
    are ranked by their words instead.
    """

    def by_hash(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(ranked, compared))

    def compared(ranked: Column) -> Column:
        def equal(a: Column, b: Column) -> Column:
            found = F.lit(True)
            for i in range(WINDOW):
                found = found & (F.get(words, a["at"] + i) == F.get(words, b["at"] + i))
            return found

        clash = F.exists(following(ranked, lambda a, b: (a["h"] == b["h"]) & ~equal(a, b)), lambda x: x)
        return F.when(clash, let(F.sort_array(named), by_words)).otherwise(
            covered(ranked, following(ranked, lambda a, b: a["h"] == b["h"])))

    def by_words(ranked: Column) -> Column:
        return covered(ranked, following(ranked, lambda a, b: a["w"] == b["w"]))

    named = windows(words, lambda w, at: F.struct(F.concat_ws(" ", *w).alias("w"), at.alias("at")))
    hashes = windows(words, lambda w, at: F.xxhash64(*w))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(let(hashes, by_hash))


def dominant(words: Column, share: tuple[int, int]) -> Column:
    """Whether one word makes up more than ``share`` (a numerator and a denominator) of the words.

    In sorted words it then stands at two places that are that share apart. Hashes tell where that cannot be.
    """
    apart = F.floor(F.size(words) * share[0] / share[1]).cast("int")

    def meets(ranked: Column) -> Column:
        later = F.slice(ranked, apart + 1, F.size(words))
        return F.exists(F.zip_with(ranked, later, lambda a, b: F.coalesce(a == b, F.lit(False))), lambda same: same)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(let(F.sort_array(hashes), meets), let(F.sort_array(words), meets)).otherwise(F.lit(False))


#: What rules are made of: longs of a text that is not null and of its words.
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, words: F.size(words),
    "word_chars": lambda text, words: F.length(F.array_join(words, "")),
    "n_symbols": lambda text, words: F.size(F.split(text, SYMBOL, -1)) - 1,
    "n_lines": lambda text, words: F.size(lines_of(text)),
    "n_dup_lines": lambda text, words: let(lines_of(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))),
    "n_repeat_words": lambda text, words: repeated_words(words),
    "n_letter_words": lambda text, words: F.size(F.filter(words, lambda w: F.regexp_like(w, F.lit(r"\p{L}")))),
    "has_dominant": lambda text, words: dominant(words, (3, 10)).cast("int"),
}


@dataclass(frozen=True)
class Rule:
    """A name, the measures it needs, and the condition of them under which a document fails."""

    name: str
    needs: tuple[str, ...]
    fails: Callable[..., Column]
    base: bool = False


#: The base rules, then what the cascade adds: limits that hold for prose in any language.
RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 50, base=True),
    Rule("repeated_windows", ("n_repeat_words", "n_words"), lambda r, n: r * 100 > n * 50, base=True),
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: s * 10 > n),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < n * 2) | (c > n * 15)),
    Rule("letters", ("n_letter_words", "n_words"), lambda a, n: a * 10 < n * 7),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda d, n: d * 2 > n),
    Rule("dominant_word", ("has_dominant",), lambda d: d > 0),
)


def with_words(docs: DataFrame, words_col: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the words of each text, as a column of its own so that they are cut once for all measures."""
    return docs.withColumn(words_col, words_of(F.col(text_col)))


def measure(name: str, words_col: str, text_col: str = "text") -> Column:
    # Bound here too: a filter that Spark moves below the column would cut the words again for each of them.
    text = F.coalesce(F.col(text_col), F.lit(""))
    return let(F.col(words_col), lambda words: MEASURES[name](text, words).cast("long"))


def failing(rule: Rule, words_col: str, text_col: str = "text", given: Sequence[str] = ()) -> Column:
    """Whether a document fails the rule; measures in ``given`` are columns, others are computed where needed."""
    return rule.fails(*[F.col(n) if n in given else measure(n, words_col, text_col) for n in rule.needs])


@dataclass(frozen=True)
class Estimate:
    """Seconds that each rule takes for the sample, and how many rows of it fail each set of rules."""

    seconds: dict[str, float]
    failed: dict[frozenset[str], int]


def drawn(docs: DataFrame, rows: int = SAMPLE, seed: int = 42) -> DataFrame:
    """About ``rows`` rows of ``docs``, drawn at random."""
    count = docs.count()
    return docs.sample(min(1.0, rows / count), seed) if count else docs


def estimate(sample: DataFrame, words_col: str, rules: Sequence[Rule] = RULES, text_col: str = "text",
             given: Sequence[str] = ()) -> Estimate:
    """Costs and rejections of the rules on the rows of ``sample``, which one task reads.

    A rule's cost is the time of a job that counts its rejections, less that of a job that only reads; each runs twice
    and the shorter time counts. The words, and the measures in ``given``, are columns of the sample.
    """
    sample = written(sample.select(text_col, words_col, *given).repartition(1), "sample")

    def seconds(column: Column) -> float:
        times = []
        for _ in range(2):
            start = time.perf_counter()
            sample.agg(F.sum(column)).collect()
            times.append(time.perf_counter() - start)
        return min(times)

    marks = {rule.name: failing(rule, words_col, text_col, given) for rule in rules}
    idle = seconds(F.length(text_col) + F.size(words_col))
    times = {rule.name: LEAST_SECONDS for rule in rules}
    for rule in rules:
        if not set(rule.needs) <= set(given):
            times[rule.name] = max(seconds(marks[rule.name].cast("int")) - idle, LEAST_SECONDS)
    sets = sample.groupBy(*[mark.alias(name) for name, mark in marks.items()]).count().collect()  # no more than the sample
    return Estimate(times, {frozenset(name for name in marks if r[name]): r["count"] for r in sets})


def ordered(rules: Sequence[Rule], found: Estimate) -> tuple[Rule, ...]:
    """The rules by rejections per second, among the rows that the rules before leave; ties as given.

    Rules that reject nothing more come last, the cheapest first.
    """
    left, rest, order = Counter(found.failed), list(rules), []
    while rest:

        def worth(rule: Rule, left: Counter = left) -> tuple[float, float]:
            rejected = sum(n for failed, n in left.items() if rule.name in failed)
            return rejected / found.seconds[rule.name], -found.seconds[rule.name]

        best = max(rest, key=worth)
        rest.remove(best)
        order.append(best)
        left = Counter({failed: n for failed, n in left.items() if best.name not in failed})
    return tuple(order)


def verdict(rules: Sequence[Rule], words_col: str, text_col: str = "text", given: Sequence[str] = ()) -> Column:
    """Name of the first of ``rules``, in their order, that a document fails; null where it fails none.

    A rule is only evaluated for documents that pass those before it.
    """
    first = F.lit(None).cast("string")
    for rule in reversed(rules):
        first = F.when(failing(rule, words_col, text_col, given), F.lit(rule.name)).otherwise(first)
    return first


def cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", output: str = "rejected_by") -> DataFrame:
    """``docs`` with ``output``, the :func:`verdict` of ``rules`` in the order that a sample of ``docs`` suggests.

    Whether it is null does not depend on the order, its name may. Null text is the empty one, which has no words.
    Repeated rows and ties get the same result each; other columns are left as they are, and an empty table gives no
    rows. ``output`` must not be a column of ``docs``.
    """
    if output.lower() in {name.lower() for name in docs.columns}:
        raise ValueError(f"the table has a column {output!r}")
    words = free_name(docs, "words_of_text")
    order = ordered(rules, estimate(with_words(drawn(docs), words, text_col), words, rules, text_col))
    return with_words(docs, words, text_col).withColumn(output, verdict(order, words, text_col)).drop(words)


def drop_failing(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that fail no rule."""
    output = free_name(docs, "rejected_by")
    return cascade(docs, rules, text_col, output).where(F.col(output).isNull()).drop(output)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Id, five base measures, ``base_failed`` and ``kept`` of each row, as :func:`cascade` treats them.

    The measures that are reported are given to the cascade; it computes others for documents that get so far.
    """
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def measured(rows: DataFrame) -> DataFrame:
        return with_words(rows, "words", "body").withColumns({name: measure(name, "words", "body") for name in base})

    bare = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    order = ordered(rules, estimate(measured(drawn(bare)), "words", rules, "body", base))
    failed = F.lit(False)
    for rule in rules:
        if rule.base:
            failed = failed | failing(rule, "words", "body", base)
    kept = verdict(order, "words", "body", base).isNull()
    return measured(bare).select(F.col("id").alias(id_col), *base, failed.alias("base_failed"), kept.alias("kept"))
