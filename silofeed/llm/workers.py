"""What the Python workers of a job need."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package at the driver's path; elsewhere it is installed or sent with the job."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file; the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)
