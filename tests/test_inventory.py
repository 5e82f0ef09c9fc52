import pytest

from silofeed.functions import redact_sources, source_supported, validate_sources
from silofeed.sources import SourceConfig

INVENTORY = "type string, url string, username string, secret_ref string, options map<string, string>"


def inventory(spark, *sources):
    return spark.createDataFrame(list(sources), INVENTORY)


def test_jdbc_asks_for_type_and_url(spark):
    df = inventory(
        spark,
        ("jdbc", "jdbc:h2:mem:x", None, None, {}),
        ("jdbc", "http://x", None, None, {}),
        ("JDBC", "jdbc:h2:mem:x", None, None, {}),
        ("parquet", "/lake", None, None, {}),
        (None, None, None, None, {}),
    )
    shown = df.select("type", "url", source_supported("type", "url"), source_supported("type", "url", "parquet"))
    no = (False, False)
    assert [r[2:] for r in shown.collect()] == [(True, False), no, no, (False, True), no]
    assert SourceConfig("jdbc", "jdbc:h2:mem:x").supported()
    assert not SourceConfig("jdbc", "http://x").supported()
    assert SourceConfig("parquet", "/lake").supported("parquet")


def test_type_and_url_must_not_be_blank(spark):
    df = validate_sources(
        inventory(spark, (" ", "x", None, None, {}), ("jdbc", None, None, None, {}), ("jdbc", "x", None, None, {}))
    )
    assert [r["error"] for r in df.collect()] == ["type must not be blank", "url must not be blank", None]
    with pytest.raises(ValueError, match="type must not be blank"):
        SourceConfig(" ", "x")
    with pytest.raises(ValueError, match="url must not be blank"):
        SourceConfig("jdbc", "")


SECRETS = [
    "jdbc:postgresql://me:hush@db:5432/x",
    "jdbc:postgresql://me:hu@sh@db:5432/x",
    "jdbc:mysql://db/x?user=me&password=hush&useSSL=true",
    "jdbc:h2:mem:x;PASSWORD=hush;MODE=y",
    "jdbc:sqlserver://db;user=me;pwd=hush",
]


@pytest.mark.parametrize("url", SECRETS)
def test_nothing_secret_is_shown(spark, url):
    source = ("jdbc", url, "me", "DB_SECRET", {"b": "option-value", "a": "option-value"})
    df = redact_sources(inventory(spark, source))
    shown = df.first()
    assert shown["option_keys"] == ["a", "b"] and shown["type"] == "jdbc" and shown["username"] == "me"
    for text in (str(shown), repr(SourceConfig(*source))):
        assert not any(secret in text for secret in ("hush", "sh@db", "DB_SECRET", "option-value"))
        assert "db" in text or "mem" in text


def test_password_comes_from_the_environment(monkeypatch):
    source = SourceConfig("jdbc", "jdbc:h2:mem:x", "me", "SOME_DB_SECRET", {"sslmode": "require"})
    monkeypatch.delenv("SOME_DB_SECRET", raising=False)
    with pytest.raises(ValueError, match="SOME_DB_SECRET"):
        source.connection_options()
    monkeypatch.setenv("SOME_DB_SECRET", "hush")
    assert source.connection_options() == {"user": "me", "password": "hush", "sslmode": "require"}
    assert SourceConfig("jdbc", "jdbc:h2:mem:x", "me").connection_options() == {"user": "me"}
    overriding = SourceConfig("jdbc", "jdbc:h2:mem:x", "me", options={"user": "other"})
    assert overriding.connection_options() == {"user": "other"}


def test_options_are_copied():
    options = {"a": "1"}
    source = SourceConfig("jdbc", "jdbc:h2:mem:x", options=options)
    options["b"] = "2"
    assert source.options == {"a": "1"}
