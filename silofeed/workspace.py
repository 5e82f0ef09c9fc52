"""Folders for written intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, purpose: str) -> str:
    """Name of a fresh folder that every executor can reach.

    It lies below ``spark.checkpoint.dir``. Only a local session may go without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="silofeed-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def qualified(spark: SparkSession, folder: str) -> str:
    """Full name of a folder, as plans show it."""
    files, path = _file_system(spark, folder)
    return files.makeQualified(path).toString()


def folder_exists(spark: SparkSession, folder: str) -> bool:
    files, path = _file_system(spark, folder)
    return files.exists(path)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that :func:`new_folder` named."""
    files, path = _file_system(spark, folder)
    files.delete(path, True)


def list_names(spark: SparkSession, pattern: str) -> list[str]:
    """Names, without their folders, of the files and folders that match a pattern."""
    files, path = _file_system(spark, pattern)
    return [status.getPath().getName() for status in files.globStatus(path) or []]


def publish_text(spark: SparkSession, name: str, text: str) -> bool:
    """Write a small file that is there as a whole or not at all; false where a file of that name is there already."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    files, path = _file_system(spark, name)
    draft = jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.getParent().toUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, path, options)
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
            return False
        raise
    return True


def read_text(spark: SparkSession, name: str) -> str:
    files, path = _file_system(spark, name)
    stream = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def match_files(spark: SparkSession, pattern: str) -> list[str]:
    """Full names of the files that match a pattern; nothing is opened."""
    files, path = _file_system(spark, pattern)
    return [status.getPath().toString() for status in files.globStatus(path) or [] if status.isFile()]


def match_entries(spark: SparkSession, pattern: str) -> list[tuple[str, str | None, bool]]:
    """Names that match a pattern; of folders also the first name inside and whether that is a file.

    Names that begin with ``_`` or ``.`` and empty folders are left out. Nothing is opened, and a folder is listed only
    up to its first entry.
    """
    files, path = _file_system(spark, pattern)
    found = []
    for status in files.globStatus(path) or []:
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if status.isFile():
            found.append((name, None, False))
            continue
        inside = files.listStatusIterator(status.getPath())
        while inside.hasNext():
            entry = inside.next()
            if not entry.getPath().getName().startswith(("_", ".")):
                found.append((name, entry.getPath().getName(), entry.isFile()))
                break
    return found
