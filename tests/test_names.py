import pytest
from conftest import rows
from pyspark.sql import functions as F

from silofeed.functions import (
    dialect_for_url,
    dialect_name,
    not_blank,
    qualified_name,
    quote_identifier,
    quote_name,
)
from silofeed.sources import TableRef

URLS = {
    "jdbc:postgresql://db7.lan:6432/shop?ssl=true": "postgresql",
    "jdbc:mysql://10.0.0.8/stock": "mysql",
    "jdbc:dm://host:5236": "dm",
    "jdbc:kingbase8://host:54321/x": "kingbase",
    "jdbc:oceanbase://host:2881/x": "oceanbase",
    "jdbc:derby:memory:x;create=true": "ansi",
    "JDBC:MYSQL://host/x": "ansi",
    "": "ansi",
    None: "ansi",
}


def test_dialect_is_chosen_by_url(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string").select("url", dialect_for_url("url"))
    assert {tuple(r) for r in df.collect()} == set(URLS.items())
    assert {u: dialect_name(u) for u in URLS} == URLS


@pytest.mark.parametrize(
    "name, dialect, quoted",
    [
        ("orders", "postgresql", '"orders"'),
        ("orders", "mysql", "`orders`"),
        ("orders", "ansi", '"orders"'),
        ("orders", "oceanbase", '"orders"'),
        ('a"b', "dm", '"a""b"'),
        ("a`b", "dm", '"a`b"'),
        ("a`b", "mysql", "`a``b`"),
        ('a"b', "mysql", '`a"b`'),
    ],
)
def test_identifiers_are_quoted(spark, name, dialect, quoted):
    df = spark.createDataFrame([(name, dialect)], "name string, dialect string")
    assert df.select(quote_identifier("name", F.col("dialect"))).first()[0] == quoted
    assert df.select(quote_identifier("name", dialect)).first()[0] == quoted
    assert quote_name(name, dialect) == quoted


@pytest.mark.parametrize(
    "catalog, schema, shown",
    [
        ("df_acme", "public", "df_acme.public.orders"),
        (None, "df_acme", "df_acme.orders"),
        ("df_acme", None, "df_acme.orders"),
        (" ", "\t\n", "orders"),
        (None, None, "orders"),
        (" a", "b ", " a.b .orders"),
    ],
)
def test_qualified_name_leaves_blank_parts_out(spark, catalog, schema, shown):
    df = spark.createDataFrame([(catalog, schema, "orders")], "c string, s string, n string")
    assert df.select(qualified_name("c", "s", "n")).first()[0] == shown
    assert TableRef("orders", schema, catalog).qualified_name == shown


@pytest.mark.parametrize("name", ["", "  ", None])
def test_table_name_must_not_be_blank(spark, name):
    df = spark.createDataFrame([(name,)], "n string")
    with pytest.raises(Exception, match="table name must not be blank"):
        df.select(qualified_name(F.lit("c"), F.lit("s"), "n")).collect()
    with pytest.raises(ValueError, match="table name must not be blank"):
        TableRef(name)


def test_blank_follows_unicode_white_space(spark):
    values = {"": False, " \t\r\n": False, " ": False, " ": True, " ": True, "x": True, None: False}
    df = spark.createDataFrame([(v,) for v in values], "v string").select("v", not_blank("v"))
    assert rows(df) == sorted(values.items(), key=repr)
