"""Properties over generated values, many of them in one Spark job."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from silofeed.functions import is_valid_tenant, quote_identifier, quote_name, tenant_catalog_or_null
from silofeed.functions.tenancy import TENANT_ID

FEW = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)
TEXT = st.text(st.characters(exclude_categories=["Cs"]), max_size=8)
IDS = st.one_of(TEXT, st.from_regex("[a-z0-9-]{0,70}"), st.from_regex(TENANT_ID, fullmatch=True))


@FEW
@given(st.lists(IDS, min_size=50, max_size=300))
def test_tenant_ids(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for value, valid, catalog in df.select("v", is_valid_tenant("v"), tenant_catalog_or_null("v")).collect():
        expected = re.fullmatch(TENANT_ID, value) is not None
        assert valid == expected and catalog == ("df_" + value if expected else None)


@FEW
@given(st.lists(st.text(st.sampled_from("ab\"`' \\"), max_size=6), min_size=50, max_size=300))
def test_quoted_names_read_back(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for dialect, mark in (("ansi", '"'), ("mysql", "`")):
        for value, quoted in df.select("v", quote_identifier("v", dialect)).collect():
            assert quoted == quote_name(value, dialect)
            assert quoted[0] == quoted[-1] == mark and quoted[1:-1].replace(mark * 2, mark) == value
