"""What the operators of this subpackage share: reading, checkpoints, sizing, packed rows."""

from __future__ import annotations

import ctypes
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.workers import find_package

# Arrow's own pools keep what they once held; a Python worker beside others should give it back.
pa.set_memory_pool(pa.system_memory_pool())
try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None

#: Rows of an Arrow batch; whole texts can be long, so batches stay small.
ARROW_ROWS = "1000"


def small_batches(df: DataFrame) -> DataFrame:
    """df; whole texts go to Python in batches of ARROW_ROWS rows from now on."""
    find_package(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder, read by Spark alone (any file system)."""
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Return freed memory to the system, between the groups of a task."""
    if _trim is not None:
        _trim(0)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the cluster names; only a local master (tests) gets one of its own, any other must name one."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir names no folder that the driver and the executors share")
    sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoints-"))


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the reliable checkpoint folder; its lineage is cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def hash_sample(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """About `rows` rows chosen by a hash of the columns `by` alone: for fitting models only.

    Rows are counted (from file footers where Spark can) and filtered where they lie; nothing is shuffled
    but the sample, and the same rows are chosen however the tasks run. Rows that are equal in `by` count
    as one, so that copies under one id do not fill the sample.
    """
    every = max(1, df.count() // rows)
    return df.where(F.pmod(F.xxhash64(*by), F.lit(every)) == 0).dropDuplicates(list(by))


def slices(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """Runs of consecutive items whose sizes sum to at most `most`; a larger item is a run of its own."""
    out, lo, room = [], 0, 0
    for i, n in enumerate(sizes):
        if i > lo and room + n > most:
            out.append((lo, i))
            lo, room = i, 0
        room += n
    return out + ([(lo, len(sizes))] if len(sizes) > lo else [])


def text_bytes(docs: DataFrame, col: str = "text") -> int:
    """Total UTF-8 bytes of a text column (one aggregate over all rows)."""
    return int(docs.agg(F.sum(F.octet_length(F.col(col)))).first()[0] or 0)


def blocks_for(n_bytes: int, each: int = 16 << 20, least: int = 24) -> int:
    """A number of blocks so that each holds about `each` bytes of text; small inputs get `least` all the same."""
    return max(least, -(-n_bytes // each))


def batch_texts(batch: pa.RecordBatch, col: str = "text") -> list[bytes]:
    """A string column as UTF-8 bytes; nulls become empty."""
    return [x or b"" for x in batch.column(col).cast(pa.binary()).to_pylist()]


def u64(payloads) -> np.ndarray:
    """The uint64 values of several packed binary cells, in order."""
    return np.frombuffer(b"".join(payloads), np.uint64)


def split_by_bucket(keys: np.ndarray, n_buckets: int, *arrays: np.ndarray):
    """(bucket, keys, arrays...) for each bucket that has keys: keys are dealt by their value, sorted by bucket."""
    bucket = (keys % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    for b in np.nonzero(np.diff(edges))[0]:
        at = order[edges[b] : edges[b + 1]]
        yield int(b), keys[at], *(a[at] for a in arrays)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (public splitmix constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def bucketed(df: DataFrame, name: str, parts: int, *key: str) -> DataFrame:
    """df written below the shared checkpoint folder in `parts` buckets of the key, each one sorted file, and read again.

    Frames that are derived from it row by row, and keep the key, meet each other without a shuffle or a sort.
    """
    import uuid

    ensure_checkpoint_dir(df.sparkSession)
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().get()}/{table}"
    df.repartition(parts, *key).write.format("parquet").option("path", path).bucketBy(parts, *key).sortBy(*key).saveAsTable(table)
    out = df.sparkSession.table(table)
    out.schema  # resolved: the catalog is not needed any more, the files stay
    df.sparkSession.sql(f"DROP TABLE {table}")
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet below the shared checkpoint folder, and read again."""
    import uuid

    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
