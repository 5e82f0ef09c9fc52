import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from silofeed.llm import quality_rules as q

from .conftest import TEXTS, documents

PROSE = " ".join(f"word{i} of{i % 7} text{i % 31}" for i in range(60))
JUNK = [
    (20, "Ea " * 80), (21, PROSE.replace(" of", " ## of&&")), (22, "\n".join(["one line of it"] * 40)), (23, " ".join("ab" * 20 for _ in range(60))),
    (24, " ".join(f"{i} {i * 7}" for i in range(90))), (25, PROSE), (26, "\n".join([PROSE] * 3)), (27, "x " + PROSE + " x" * 100),
]


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    triples = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if triples[w] > 1 for k in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_letter_words": sum(bool(re.search(r"[^\W\d_]", w)) for w in words),
        "has_dominant": int(10 * max(Counter(words).values(), default=0) > 3 * len(words)) if words else 0,
    }


def failed(m):
    n = m["n_words"]
    return {
        name for name, fails in {
            "few_words": n < 50, "repeated_windows": 100 * m["n_repeat_words"] > 50 * n, "symbols": 10 * m["n_symbols"] > n,
            "word_length": not 2 * n <= m["word_chars"] <= 15 * n, "letters": 10 * m["n_letter_words"] < 7 * n,
            "repeated_lines": 2 * m["n_dup_lines"] > m["n_lines"], "dominant_word": m["has_dominant"] > 0}.items() if fails}


def test_measures_and_rules_by_brute_force(spark):
    texts = TEXTS + JUNK
    docs = q.with_words(documents(spark, texts), "w")
    rules = [q.failing(rule, "w").alias(f"r_{rule.name}") for rule in q.RULES]
    found = docs.select("doc_id", "text", *[q.measure(name, "w").alias(name) for name in q.MEASURES], *rules).collect()
    assert len(found) == len(texts)
    for row in found:
        want = measures(row["text"] or "")
        assert {name: row[name] for name in want} == want, row["doc_id"]
        assert {r.name for r in q.RULES if row[f"r_{r.name}"]} == failed(want), row["doc_id"]


def test_report_on_messy_rows(spark):
    texts = TEXTS + JUNK
    found = q.report(documents(spark, texts)).collect()
    want = []
    for doc_id, text in texts:
        m = measures(text or "")
        bad = failed(m)
        base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        want.append((doc_id, *[m[b] for b in base], bool(bad & {"few_words", "repeated_windows"}), not bad))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_windows_that_share_a_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(q.F, "xxhash64", lambda *columns: F.lit(7).cast("long"))
    texts = [(i, t) for i, t in enumerate(["a b c d e f", "a b c x a b c y a b c", "a b c a b c a", "b b b b b", PROSE])]
    docs = q.with_words(documents(spark, texts), "w")
    found = {r["text"]: r["n"] for r in docs.select("text", q.measure("n_repeat_words", "w").alias("n")).collect()}
    assert found == {t: measures(t)["n_repeat_words"] for _, t in texts}


def test_order_by_rejections_per_cost():
    rules = {n: q.Rule(n, (), lambda: None) for n in "abcd"}
    found = q.Estimate({"a": 1.0, "b": 1.0, "c": 4.0, "d": 0.5}, {frozenset("ab"): 50, frozenset("bc"): 10, frozenset("c"): 30, frozenset(): 900})
    # a rejects nothing that b leaves, so c comes before it; d rejects nothing, but is cheaper than a.
    assert [r.name for r in q.ordered(list(rules.values()), found)] == ["b", "c", "d", "a"]


def test_estimate_counts_the_sample(spark):
    docs = q.with_words(documents(spark, TEXTS + JUNK), "w")
    found = q.estimate(docs, "w", q.RULES)
    want = Counter(frozenset(failed(measures(t or ""))) for _, t in TEXTS + JUNK)
    assert found.failed == dict(want) and set(found.seconds) == {r.name for r in q.RULES} and min(found.seconds.values()) > 0


def test_a_rule_runs_only_for_what_the_rules_before_it_leave(spark):
    boom = q.Rule("boom", ("n_words",), lambda n: F.raise_error(F.lit("evaluated")).cast("boolean"))
    docs = q.with_words(documents(spark, [(1, None), (2, "a few words")]), "w")
    row = docs.select(q.verdict((q.RULES[0], boom), "w").alias("v")).collect()
    assert [r["v"] for r in row] == ["few_words", "few_words"]


def test_order_does_not_change_what_stays(spark):
    docs = q.with_words(documents(spark, TEXTS + JUNK), "w")
    one, two = (docs.where(q.verdict(r, "w").isNull()).select("doc_id").collect() for r in (q.RULES, q.RULES[::-1]))
    assert sorted(one) == sorted(two)


def test_dropping_keeps_rows_as_they_are(spark):
    docs = documents(spark, TEXTS + JUNK)
    kept = q.drop_failing(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, t in TEXTS + JUNK if not failed(measures(t or "")))


def test_empty_table_and_taken_name(spark, nothing):
    assert q.report(nothing).count() == 0 and q.drop_failing(nothing).count() == 0
    with pytest.raises(ValueError):
        q.cascade(nothing, output="BLOB")


def test_no_shuffle_of_documents(spark, sf_dir):
    report = q.report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Pandas" not in plan
