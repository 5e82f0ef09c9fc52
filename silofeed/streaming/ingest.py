"""Streams of files into tenant tables and change logs."""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.tenancy import tenant_catalog_or_null
from ..operators.quota import count_by_tenant
from ..operators.routing import TENANT_CATALOG
from ..operators.sinks import RUN_ID, write_run
from ..plans.jobs import require_admitted, save_verdicts, tenant_verdicts
from ..workspace import folder_exists

# Size of a micro-batch, and so of the work that is done again after a failure.
MICRO_BATCH_BYTES = 2**40


def read_stream(
    spark: SparkSession, path: str, schema: StructType, max_bytes_per_trigger: int = MICRO_BATCH_BYTES
) -> DataFrame:
    """Parquet files as a stream. ``max_bytes_per_trigger`` bounds the size of a micro-batch.

    ``path`` is a folder, or a pattern that matches folders or files.
    """
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(path)


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *partition_by: str,
    before: Callable[[DataFrame], None] | None = None,
    writers: int | None = None,
) -> StreamingQuery:
    """Run a stream over all files that are there now, into parquet files below ``path``.

    A micro-batch is a run of its own (``run_id``), named after the stream and the batch's number. One that is run
    again after a failure replaces its own files. The stream's name is kept in its checkpoint: streams from other
    sources into the same folder do not touch each other's runs, and a stream that has lost its checkpoint is a new
    one, whose rows come again rather than not at all. ``before`` sees each batch before it is written, and may
    stop the stream by an error.
    """
    named, failed = threading.Event(), []

    def write(batch: DataFrame, number: int) -> None:
        named.wait()
        try:
            if before is not None:
                before(batch)
            write_run(batch, path, f"{query.id}-{number}", *partition_by, writers=writers)
        except Exception as error:
            failed.append(error)
            raise

    query = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    named.set()
    try:
        query.awaitTermination()
    except Exception as error:
        # The caller gets the error itself, not the stream's report of it.
        raise failed[0] if failed else error
    return query


def read_landed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What streams have written to a folder, also when nothing has arrived yet."""
    if not folder_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).drop(RUN_ID)


def ingest_stream(
    spark: SparkSession,
    source_path: str,
    schema: StructType,
    tenant: Column | str,
    path: str,
    checkpoint: str,
    quotas: DataFrame | None = None,
    parallelism: int | None = None,
) -> DataFrame:
    """Bounded run over the files that have arrived since the last one: admit every tenant, then route the rows.

    Returns the verdicts. Quotas are per run, so the run is one micro-batch over a list of files that is fixed when it
    starts: exactly these rows are counted, before any of them is written, and then moved. Files that arrive meanwhile
    wait for the next run. A batch that an earlier run has left unfinished comes first and counts too. Rows without a
    legal tenant stop the run like any refused tenant; files of a stopped run are seen again by the next one.
    """
    counts: list[DataFrame] = []

    def admit(batch: DataFrame) -> None:
        counts.append(save_verdicts(count_by_tenant(batch, tenant)))
        require_admitted(verdicts_so_far())

    def verdicts_so_far() -> DataFrame:
        counted = reduce(DataFrame.unionByName, counts or [spark.createDataFrame([], "tenant string, planned long")])
        planned = counted.groupBy("tenant").agg(F.sum("planned").alias("planned"))
        return tenant_verdicts(planned, quotas, parallelism)

    rows = spark.readStream.schema(schema).parquet(source_path)
    routed = rows.withColumn(TENANT_CATALOG, tenant_catalog_or_null(tenant))
    write_stream(routed, path, checkpoint, TENANT_CATALOG, before=admit, writers=parallelism)
    return save_verdicts(verdicts_so_far())


def land_changes(
    spark: SparkSession,
    source_path: str,
    schema: StructType,
    path: str,
    checkpoint: str,
    max_bytes_per_trigger: int = MICRO_BATCH_BYTES,
) -> DataFrame:
    """Collect a stream of changes in a log, to be applied to a snapshot, and return the log so far.

    Several streams may fill one log. Changes may come late or twice: the last change of a key is chosen by its
    sequence, not by arrival.
    """
    rows = read_stream(spark, source_path, schema, max_bytes_per_trigger)
    write_stream(rows, path, checkpoint)
    return read_landed(spark, path, schema)
