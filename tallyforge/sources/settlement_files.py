"""Settlement files: curated and raw CSV, which file to read, and curated or quarantined output."""

from __future__ import annotations

import re
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from ..schemas import SETTLEMENT, STAGING

DELIMITERS = ",;\t|"


def _paths(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, modification time) of files that match a glob, through Spark's file systems."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    return [(s.getPath().toString(), s.getModificationTime()) for s in found]


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """Curated rows with the declared schema; a path may be a glob."""
    return spark.read.schema(SETTLEMENT).option("header", True).csv(path)


def resolve(spark: SparkSession, folder: str, batch_date: str | None = None, allow_unvalidated: bool = False) -> str:
    """The settlement source of a date: its curated file; the raw one only where that is allowed. Without a date: all curated files, else all raw ones."""
    if batch_date is None:
        curated = f"{folder}/curated_settlement_*.csv"
        return curated if _paths(spark, curated) else f"{folder}/settlement_*.csv"
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", batch_date):
        raise ValueError(f"not a date: {batch_date!r}")
    day = batch_date.replace("-", "")
    if _paths(spark, f"{folder}/curated_settlement_{day}.csv"):
        return f"{folder}/curated_settlement_{day}.csv"
    if allow_unvalidated and _paths(spark, f"{folder}/settlement_{day}.csv"):
        return f"{folder}/settlement_{day}.csv"
    raise FileNotFoundError(f"no curated settlement of {batch_date} in {folder}")


def date_in_name(name: str) -> str | None:
    """The date of the first eight digits in a file name."""
    m = re.search(r"\d{8}", PurePosixPath(name).name)
    return f"{m[0][:4]}-{m[0][4:6]}-{m[0][6:]}" if m else None


def batch_date(explicit: str | None, file_name: str | None) -> str:
    found = explicit or (file_name and date_in_name(file_name))
    if not found:
        raise ValueError("a batch needs a date, given or in its file's name")
    return found


def latest(spark: SparkSession, pattern: str) -> str:
    """The file with the latest date in its name, then the latest modification."""
    found = _paths(spark, pattern)
    if not found:
        raise FileNotFoundError(pattern)
    return max(found, key=lambda f: (date_in_name(f[0]) or "", f[1]))[0]


def sniff(spark: SparkSession, path: str) -> str:
    """The delimiter that the header line holds most often; a comma when it holds none."""
    line = spark.read.text(path).first()
    header = line["value"].lstrip("﻿") if line else ""
    return max(DELIMITERS, key=header.count) if any(d in header for d in DELIMITERS) else ","


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """A provider's file as it is: all text, blank cells and the markers of nothing as null. Large files are split by Spark."""
    raw = spark.read.option("header", True).option("sep", sniff(spark, path)).option("nullValue", None).csv(path)
    raw = raw.toDF(*(c.lstrip("﻿") for c in raw.columns))
    return raw.select(*(blank_to_null(F.col(f"`{c}`")).alias(c) for c in raw.columns))


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STAGING).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Rows as CSV with a header; Spark's committer shows the output only when it is whole."""
    flat = [F.concat_ws("|", c).alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def content_hash(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file's bytes."""
    return spark.read.format("binaryFile").load(path).select(F.sha2("content", 256)).first()[0]
