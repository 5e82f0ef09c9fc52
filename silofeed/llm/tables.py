"""Intermediate results in the shared folder, so that a lost executor costs a task and not the lineage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import new_folder, remove_folder

#: Setting of Spark, and rows of texts that a Python worker gets at once where it treats each on its own.
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000

#: Folders of the innermost scope, to be removed at its end; none outside of all scopes.
_folders: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("folders", default=None)


@contextmanager
def scratch() -> Iterator[None]:
    """A scope whose tables (:func:`written`) are removed at its end, also after a failure.

    What is wanted later has to be :func:`stored` inside. Without a scope tables stay.
    """
    made: list[tuple[SparkSession, str]] = []
    outer = _folders.set(made)
    try:
        yield
    finally:
        _folders.reset(outer)
        for spark, folder in made:
            remove_folder(spark, folder)


def passing(spark: SparkSession, folder: str) -> None:
    """Let the innermost scope, if there is one, remove the folder."""
    made = _folders.get()
    if made is not None:
        made.append((spark, folder))


@contextmanager
def short_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Python workers get at most so many rows at once from what is run inside.

    An executor and its worker each hold a batch of texts, and copies of it, and keep the space for the next one.
    """
    before = spark.conf.get(BATCH_SETTING, None)
    if before is None or not 0 < int(before) <= rows:
        spark.conf.set(BATCH_SETTING, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_SETTING)
        else:
            spark.conf.set(BATCH_SETTING, before)


def written(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """The rows as a table in the shared folder, read back; it lasts as long as the scope."""
    table, folder = stored(df, purpose, compression)
    passing(df.sparkSession, folder)
    return table


def stored(df: DataFrame, purpose: str, compression: str | None = None) -> tuple[DataFrame, str]:
    """The rows as a table in the shared folder that outlives the scope, read back; and the folder."""
    folder = new_folder(df.sparkSession, purpose)
    df.write.parquet(folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not have; names that differ in case count as equal."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted = f"{wanted}_"
    return wanted


def text_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Names a document by its id, nulls last, and a hash of its text."""
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text"))


def without(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose :func:`text_key` is not in the one column of ``gone``.

    ``gone`` is written first, so Spark knows its size: a small one is broadcast and the texts stay where they are.
    """
    name = free_name(docs, "gone")
    keys = written(gone.toDF(name).distinct(), "gone")
    return docs.join(keys, text_key(id_col, text_col) == F.col(name), "left_anti")
