import os
import sys
import uuid

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from silofeed.sources import JDBC, SourceConfig  # noqa: E402
from silofeed.sources.jdbc import run_statements  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(root / "shared"))
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.driver.extraJavaOptions", "-Dderby.stream.error.file=/dev/null")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def tenant():
    """A tenant id of which no other test has tables."""
    return f"t-{uuid.uuid4().hex[:12]}"


@pytest.fixture
def database(spark):
    """A new embedded database; the returned function also runs statements in it."""

    def create(*statements):
        source = SourceConfig(JDBC, f"jdbc:derby:memory:{uuid.uuid4().hex};create=true")
        run_statements(spark, source, *statements)
        return source

    return create


def rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
