import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from silofeed.llm import divergence as d

from .conftest import TEXTS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, least, ranks=50):
    """Rows of the audit; ``docs`` has text, lang and source."""
    docs = [(t or "", lang or "", s or "") for t, lang, s in docs]
    rows = []
    for lang in {x[1] for x in docs}:
        mine = [(Counter(terms(t)), s) for t, l, s in docs if l == lang]
        frequency = Counter(term for counts, _ in mine for term in counts)
        kept = sorted(t for t, n in frequency.items() if n >= least)
        count = defaultdict(Counter)
        for counts, s in mine:
            mine_of_source = count[s]
            for t in kept:
                mine_of_source[t] += counts[t]
        whole = sum(count.values(), Counter())

        def share(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: share(c) for s, c in count.items()} | {None: share(whole)}
        for s in count:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in count if o != s]
            more = [(p[s][t] - p[None][t], t) for t in kept if count[s][t] and p[s][t] > p[None][t]]
            for part, found, most in (("pair", pairs, None), ("term", more, ranks)):
                ordered = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                rows += [(lang, s, part, item, value, rank + 1) for rank, (value, item) in enumerate(ordered)]
    return sorted(rows)


def table(spark, rows):
    names = ("n", "term", "content", "a", "b", "p", "value")
    return spark.createDataFrame(rows, "text string, lang string, source string").withColumns({n: F.lit(n) for n in names}).repartition(3)


MESSY = [(t, lang, s) for i, (_, t) in enumerate(TEXTS) for lang, s in ((("en", "x"), (None, "y"), ("en", None))[i % 3], ("en", "z"))]
MESSY += [("Same TEXT, same", "fr", s) for s in ("a", "a", "b", None, "", "c")] + [(None, "de", "a"), ("", "de", "b"), ("9 - 7", "de", "b"), ("Ä ä É", "fr", "c")]


@pytest.mark.parametrize(("least", "listed", "held"), [(1, 1 << 10, 1 << 19), (2, 2, 10), (3, 1, 1)])
def test_audit_by_brute_force(spark, monkeypatch, least, listed, held):
    monkeypatch.setattr(d, "LISTED", listed)
    monkeypatch.setattr(d, "HELD", held)
    assert sorted(map(tuple, d.audit(table(spark, MESSY), least=least).collect())) == brute(MESSY, least)


def test_few_ranks(spark):
    assert sorted(map(tuple, d.audit(table(spark, MESSY), least=1, ranks=2).collect())) == brute(MESSY, 1, 2)


def test_no_kept_terms(spark):
    found = d.audit(table(spark, MESSY), least=1000).collect()
    assert sorted(map(tuple, found)) == brute(MESSY, 1000) and {(r["part"], r["value"]) for r in found} == {("pair", 0)}


def test_given_documents(docs):
    rows = [tuple(r) for r in docs.select("text", "lang", "source").collect()]
    assert sorted(map(tuple, d.audit(docs).collect())) == brute(rows, 30)


def test_terms():
    text = "Ab-cd É9ñ\x00x`Y{z\x7f中文 ŉ"
    assert [t.decode() for t in d.terms_of(text.encode())] == terms(text)


def test_large_counts_are_exact(spark):
    row = spark.range(1).select(d.share(F.lit(10**15), F.lit(3 * 10**15), F.lit(7)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (10**15 + 5) // (3 * 10**15 + 35)


def test_copies_are_cut_once(spark):
    copies, texts = d.collapsed(table(spark, [("hot text here", "en", f"s{i % 5}") for i in range(400)] + [("hot text here", "fr", "s")]))
    assert texts.count() == 2 and sorted(r["n"] for r in copies.collect()) == [1, 80, 80, 80, 80, 80]


def test_texts_without_copies_are_not_collapsed(spark, monkeypatch):
    rows = [(f"text {i % 90}", "en", f"s{i % 3}") for i in range(100)] + [("text 5", "fr", "s"), (None, "fr", "s"), ("", "fr", None)]
    seen, collapsed = [], d.collapsed
    monkeypatch.setattr(d, "collapsed", lambda docs, *names: seen.append(docs.count()) or collapsed(docs, *names))
    assert sorted(map(tuple, d.audit(table(spark, rows), least=1).collect())) == brute(rows, 1)
    assert seen == [22]


def test_empty_table(spark):
    assert d.audit(table(spark, [])).count() == 0
