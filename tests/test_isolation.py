import uuid

import pytest
from conftest import rows
from pyspark.errors import AnalysisException

from silofeed.functions import catalog_for, database_for
from silofeed.operators import NotYours, register_tenant, tenant_query, write_fan_out, write_tenant_table


@pytest.fixture
def two(spark):
    """Two tenants with a table each."""
    mine, other = (f"t-{uuid.uuid4().hex[:10]}" for _ in range(2))
    for tenant, x in ((mine, 1), (other, 2)):
        write_tenant_table(spark.createDataFrame([(x,)], "x int"), tenant, "things")
    return mine, other


def test_own_rows(spark, two):
    mine, _ = two
    before = spark.catalog.currentDatabase()
    for sql in ("SELECT x FROM things", f"SELECT x FROM {database_for(mine)}.things -- a comment", "SELECT 1 AS x",
                "WITH t AS (SELECT * FROM things) SELECT x FROM t WHERE x IN (SELECT x FROM things)", "SELECT CAST(id AS INT) AS x FROM range(1, 2)"):
        assert rows(tenant_query(spark, mine, sql)) == [(1,)]
    assert spark.catalog.currentDatabase() == before


@pytest.mark.parametrize("sql", [
    "SELECT * FROM {other}.things", "SELECT x FROM things UNION ALL SELECT x FROM {other}.things",
    "SELECT x FROM things WHERE x IN (SELECT x FROM {other}.things)", "SELECT (SELECT max(x) FROM {other}.things) AS x",
    "WITH t AS (SELECT x FROM {other}.things) SELECT x FROM t", "WITH t AS (SELECT x FROM {other}.things) SELECT x FROM things",
    "SELECT * FROM parquet.`{folder}`", "SELECT * FROM leak", "SELECT * FROM passing", "SELECT x FROM things WHERE EXISTS (SELECT 1 FROM {other}.things)",
    "SELECT * FROM things JOIN LATERAL (SELECT x AS y FROM {other}.things)",
])
def test_what_is_of_others_is_refused(spark, two, tmp_path, sql):
    mine, other = two
    spark.range(1).write.parquet(f"{tmp_path}/files")
    spark.sql(f"CREATE VIEW {database_for(mine)}.leak AS SELECT * FROM {database_for(other)}.things")
    spark.range(3).createOrReplaceTempView("passing")
    with pytest.raises(NotYours):
        tenant_query(spark, mine, sql.format(other=database_for(other), folder=f"{tmp_path}/files"))


@pytest.mark.parametrize("sql", ["DROP TABLE things", "INSERT INTO things VALUES (3)", "SELECT 1); DROP TABLE things; SELECT (1"])
def test_statements_are_no_queries(spark, two, sql):
    mine, _ = two
    with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR|PARSE"):
        tenant_query(spark, mine, sql)
    assert rows(tenant_query(spark, mine, "SELECT x FROM things")) == [(1,)]


def test_folders(spark, two, tmp_path):
    mine, other = two
    path = str(tmp_path / "lake")
    for tenant, x in ((mine, 5), (other, 6)):
        write_fan_out(spark.sql(f"SELECT {x} AS x, '{catalog_for(tenant)}' AS tenant_catalog"), path, tenant)
    own = f"{path}/tenant_catalog={catalog_for(mine)}"
    assert rows(tenant_query(spark, mine, f"SELECT x FROM parquet.`{own}`", [own])) == [(5,)]
    register_tenant(spark, path, mine, "fanned")
    assert rows(tenant_query(spark, mine, "SELECT x FROM fanned", [own])) == [(5,)]
    for sql in (f"SELECT x FROM parquet.`{path}`", f"SELECT x FROM parquet.`{own}/../tenant_catalog={catalog_for(other)}`",
                f"SELECT x FROM parquet.`{path}/tenant_catalog=*`"):
        with pytest.raises((NotYours, AnalysisException)):
            tenant_query(spark, mine, sql, [own])
    with pytest.raises(NotYours):
        tenant_query(spark, mine, "SELECT x FROM fanned")
