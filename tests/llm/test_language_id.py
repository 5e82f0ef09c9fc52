import pytest
from pyspark.sql import functions as F

from silofeed.llm import language_id as L

from .conftest import TEXTS, documents


@pytest.fixture(scope="module")
def model(docs):
    return L.fit(docs.where("doc_id % 2 = 0"))


def test_held_out_accuracy(docs, model):
    assert model.languages == ("de", "en", "es", "fr")
    held_out = docs.where("doc_id % 2 = 1")
    found = L.identify(held_out, model).join(held_out.select("doc_id", F.col("lang").alias("truth")), "doc_id")
    right, rows = found.agg(F.avg((F.col("lang") == F.col("truth")).cast("int")), F.count("*")).first()
    assert rows == held_out.count() and right >= 0.98


def test_the_fit_is_the_same_whatever_the_partitions(docs, model):
    again = L.fit(docs.where("doc_id % 2 = 0").repartition(7))
    assert again.languages == model.languages and (again.table == model.table).all()


def test_scores_do_not_depend_on_the_batch(model):
    texts = ["der die und", None, "", "x" * (L.PIECE + 5), "the of and"]
    together = L.log_likelihoods(texts, model)
    assert all(abs(together[i] - L.log_likelihoods([t], model)[0]).max() < 1e-6 for i, t in enumerate(texts))


def test_messy_rows(messy, model):
    found = L.identify(messy, model, declared=F.col("lang"), host=F.col("source"), parent=F.col("source"), suffix=F.col("id"))
    rows = found.collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["probability"] <= 1 and r["lang"] for r in rows)
    assert not any(r["accepted"] for r in rows if r["doc_id"] in (1, 2, 3))


def test_other_evidence_decides_for_weak_texts(spark, model):
    rows = [(i, "Les des une pour dans " * 20, "fr.example") for i in range(40)] + [(100, "123 456", "fr.example"), (101, "123 456", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, host string")
    found = {r["doc_id"]: r for r in L.identify(df, model, host=F.col("host")).collect()}
    assert found[100]["lang"] == "fr" and found[100]["text_lang"] is None and not found[100]["accepted"]
    assert found[0]["accepted"]


def test_a_declaration_weighs_as_much_as_it_is_right(spark, docs, model):
    half = docs.where("doc_id % 2 = 1").withColumn("declared", F.col("lang"))
    odd = spark.createDataFrame([(10**6, "1 2 3", "de")], "doc_id long, text string, declared string")
    both = half.select("doc_id", "text", "declared").unionByName(odd)
    found = L.identify(both, model, declared=F.col("declared")).where("doc_id = 1000000").first()
    assert found["lang"] == "de"


def test_noise_is_unknown(spark, model):
    noise = "".join(chr(97 + (i * i * 7 + i * 13 + i // 5) % 26) for i in range(3000))
    assert L.identify(documents(spark, [(1, noise)]), model).first()["lang"] == L.UNKNOWN


def test_dropping_keeps_columns(messy, model):
    kept = L.drop_unknown(messy, model)
    assert kept.columns == messy.columns and not {1, 2, 3} & {r["doc_id"] for r in kept.collect()}


def test_empty_tables(nothing, model, docs):
    assert L.identify(nothing, model).count() == 0 and L.drop_unknown(nothing, model).count() == 0
    unlabelled = L.fit(nothing)
    assert unlabelled.languages == () and {r["lang"] for r in L.identify(docs.limit(3), unlabelled).collect()} == {L.UNKNOWN}


def test_page_evidence(spark):
    row = ("https://www.shop.example.de/fr/1?x=2#y", '<!DOCTYPE html><html lang="de-AT"><script>var x="<p>";</script><p>Guten <b>Tag</b>&amp;</p>')
    df = spark.createDataFrame([row, (None, None)], "url string, html string")
    found = df.select(*[c.alias(n) for n, c in L.page_evidence(F.col("url"), F.col("html")).items()]).collect()
    assert {k: v.strip() for k, v in found[0].asDict().items()} == {
        "declared": "de", "suffix": "de/fr", "host": "www.shop.example.de", "parent": "example.de", "text": "Guten  Tag"}
    assert found[1]["host"] is None and found[1]["text"] is None


def test_every_label_is_a_language(spark):
    """More labels than the 64 that were kept before, and spellings of one."""
    text = lambda i, k: " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}q{chr(97 + (k + j) % 5)}" for j in range(40))
    rows = [(i * 10 + k, text(i, k), f" L{i:02d} " if k % 2 else f"l{i:02d}") for i in range(90) for k in range(2 + i % 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(df)
    assert model.languages == tuple(f"l{i:02d}" for i in range(90))
    found = L.identify(df, model, declared=F.col("lang")).collect()
    assert {(r["doc_id"], r["lang"], r["accepted"]) for r in found} == {(i, x.strip().lower(), True) for i, _, x in rows}
    assert L.drop_unknown(df, model, declared=F.col("lang")).count() == len(rows)


def test_a_fit_needs_no_rows_of_python(spark, docs, model, monkeypatch):
    """These would start a daemon and workers of another kind beside those of the functions."""
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", None)
    again = L.fit(docs.where("doc_id % 2 = 0"))
    assert again.languages == model.languages and (again.table == model.table).all()
