"""Small tables held by the driver."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows as a local relation. Its size is known to the optimizer, which broadcasts it while it is small and shuffles nothing."""
    fields = StructType.fromDDL(schema).fields
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    table = pa.table([pa.array(c, kinds[f.dataType.simpleString()]) for f, c in zip(fields, columns)], names=[f.name for f in fields])
    return spark.createDataFrame(table)
