import pytest
from conftest import rows
from pyspark.sql import functions as F

from silofeed.functions import (
    catalog_for,
    database_for,
    is_valid_tenant,
    spark_database,
    tenant_catalog,
    tenant_catalog_or_null,
)

# From the rule: a first character, further characters, and 63 of them at most; no line may follow.
FIRST, FURTHER = "az09", "az09-"
LEGAL = [*FIRST, *[f"k{c}" for c in FURTHER], "q-7-x", "m" * 63, "5" + "-" * 62]
WRONG = "AZ _.;/\\'\"\t\n\r\x00éß٣🙂"
ILLEGAL = [*WRONG, "-", "", *[f"k{c}k" for c in WRONG], "-k", "k\n", "\nk", "m" * 64, None]


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "tenant string")


def test_legal_ids_are_mapped(spark):
    df = ids(spark, LEGAL).select("tenant", tenant_catalog("tenant"), is_valid_tenant("tenant"))
    assert {tuple(r) for r in df.collect()} == {(v, "df_" + v, True) for v in LEGAL}
    assert [catalog_for(v) for v in LEGAL] == ["df_" + v for v in LEGAL]


def test_illegal_ids(spark):
    df = ids(spark, ILLEGAL).select("tenant", is_valid_tenant("tenant"), tenant_catalog_or_null("tenant"))
    assert {tuple(r) for r in df.collect()} == {(v, False, None) for v in ILLEGAL}
    for value in ILLEGAL:
        with pytest.raises(ValueError, match="illegal tenantId"):
            catalog_for(value)


@pytest.mark.parametrize("value", ["", "-", "k_k", "K", "k\n", None])
def test_illegal_ids_fail(spark, value):
    with pytest.raises(Exception, match="illegal tenantId"):
        ids(spark, [value]).select(tenant_catalog("tenant")).collect()


def test_lenient_form_lets_a_missing_tenant_pass_but_no_illegal_one(spark):
    df = ids(spark, [None, "acme"]).select(tenant_catalog("tenant", strict=False).alias("c"))
    assert rows(df) == [("df_acme",), (None,)]
    with pytest.raises(Exception, match="illegal tenantId: a_b"):
        ids(spark, ["a_b"]).select(tenant_catalog("tenant", strict=False)).collect()


def test_tenants_differ_in_catalog_and_database(spark):
    names = ["acme", "beta", "a-b", "ab", "a-b-", "ab-"]
    df = ids(spark, names).select(spark_database(tenant_catalog("tenant")).alias("d"))
    assert df.distinct().count() == len(names)
    assert df.filter(F.col("d").contains("-")).isEmpty()
    assert database_for("tenant-demo") == "df_tenant_demo"
