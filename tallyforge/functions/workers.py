"""Python workers."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, unless a path is set already."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
