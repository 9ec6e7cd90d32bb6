"""Gateway events on the wire: frame checks in built-in functions, Avro decoding in Arrow batches, and stream sources."""

from __future__ import annotations

import json
import logging
import time
import urllib.parse
import urllib.request
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.workers import find_package
from ..schemas import EVENT, EVENT_AVRO

log = logging.getLogger(__name__)

HEADER = 5


def frame(value: Column) -> dict[str, Column]:
    """decodable (magic byte 0 and more than a header), schema_id (text of the four bytes) and the payload, null when not decodable."""
    ok = F.coalesce((F.octet_length(value) > HEADER) & (F.hex(F.substring(value, 1, 1)) == "00"), F.lit(False))
    return {
        "decodable": ok,
        "schema_id": F.when(ok, F.conv(F.hex(F.substring(value, 2, 4)), 16, 10)),
        "payload": F.when(ok, F.substring(value, HEADER + 1, 0x7FFFFFF0)),
    }


def _number(b: bytes, at: int) -> tuple[int, int]:
    """A zigzag variable-length integer and where it ends."""
    n = shift = 0
    while True:
        byte = b[at]
        at += 1
        n |= (byte & 0x7F) << shift
        if byte < 0x80:
            return (n >> 1) ^ -(n & 1), at
        shift += 7
        if shift > 63:
            raise ValueError("number too long")


def decode_event(payload: bytes | None) -> tuple | None:
    """The fields of one event record; None for anything else."""
    if payload is None:
        return None
    try:
        at, out = 0, []
        for i, f in enumerate(EVENT.fields):
            if i >= 5:  # optional: the branch first
                branch, at = _number(payload, at)
                if branch == 0:
                    out.append(None)
                    continue
                if branch != 1:
                    return None
            n, at = _number(payload, at)
            if f.name == "amount_paise":
                if not -(1 << 63) <= n < 1 << 63:
                    return None
                out.append(n)
                continue
            if n < 0 or at + n > len(payload):
                return None
            out.append(payload[at : at + n].decode("utf-8"))
            at += n
        return tuple(out)
    except (IndexError, ValueError, UnicodeDecodeError):
        return None


def encode_event(event: dict, schema_id: int = 1) -> bytes:
    """The frame of one event (for producers and tests)."""

    def number(n: int) -> bytes:
        z, out = (n << 1) ^ (n >> 63), bytearray()
        while z > 0x7F:
            out.append(z & 0x7F | 0x80)
            z >>= 7
        return bytes(out) + bytes([z])

    out = b"\0" + schema_id.to_bytes(4, "big")
    for i, f in enumerate(EVENT.fields):
        v = event.get(f.name)
        if i >= 5:
            out += number(0 if v is None else 1)
            if v is None:
                continue
        if f.name == "amount_paise":
            out += number(v)
        else:
            raw = v.encode()
            out += number(len(raw)) + raw
    return out


class _Cursor:
    """A position in each row's record, moved over all rows of a batch at once. Rows that cannot be read on drop out of `ok`."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, ok: np.ndarray):
        self.data, self.at, self.ends, self.ok = data if len(data) else np.zeros(1, np.uint8), starts.copy(), ends, ok.copy()

    def number(self, rows: np.ndarray) -> np.ndarray:
        """The zigzag number at the position of `rows` (a mask); 0 elsewhere."""
        n, open_ = np.zeros(len(self.at), np.uint64), rows & self.ok
        for shift in range(0, 70, 7):
            short = open_ & (self.at >= self.ends)
            self.ok &= ~short
            open_ = open_ & ~short
            if not open_.any():
                break
            byte = self.data[np.minimum(self.at, len(self.data) - 1)].astype(np.uint64)
            if shift == 63:  # the tenth byte holds one bit
                self.ok &= ~(open_ & (byte > 1))
                open_ = open_ & (byte <= 1)
            n = np.where(open_, n | ((byte & np.uint64(0x7F)) << np.uint64(shift)), n)
            self.at = self.at + open_
            open_ = open_ & (byte >= 0x80)
        return ((n >> np.uint64(1)) ^ (np.uint64(0) - (n & np.uint64(1)))).astype(np.int64)

    def text(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of the text at the position of `rows`."""
        size = self.number(rows)
        rows = rows & self.ok
        bad = rows & ((size < 0) | (size > self.ends - self.at))
        self.ok &= ~bad
        size = np.where(rows & ~bad, size, 0)
        start = self.at.copy()
        self.at = self.at + size
        return start, size


def _texts(data: np.ndarray, start: np.ndarray, size: np.ndarray, there: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The texts of the rows in `there`, and which of them are not UTF-8."""
    size = np.where(there, size, 0)
    ends = np.cumsum(size)
    flat = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    raw = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data[flat].tobytes())])
    broken = np.zeros(len(size), bool)
    try:
        out = raw.cast(pa.string())
    except pa.ArrowInvalid:  # rare: look at each
        for i, b in enumerate(raw.to_pylist()):
            try:
                b.decode("utf-8")
            except UnicodeDecodeError:
                broken[i] = True
        out = pa.array([None if bad else b.decode("utf-8") for b, bad in zip(raw.to_pylist(), broken)], pa.string())
    return out, broken


def decode_columns(payload: pa.Array) -> list[pa.Array]:
    """The event columns of a batch of Avro records, all rows at once; rows that are no such record are null in every column."""
    payload = payload.cast(pa.binary())
    n = len(payload)
    ok = ~np.asarray(payload.is_null())
    offsets = np.frombuffer(payload.buffers()[1], np.int32)[payload.offset : payload.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    data = np.frombuffer(payload.buffers()[2], np.uint8) if n and payload.buffers()[2] is not None else np.zeros(0, np.uint8)
    c, found = _Cursor(data, offsets[:-1], offsets[1:], ok), []
    for i, f in enumerate(EVENT.fields):
        here = c.ok.copy()
        if i >= 5:  # optional: the branch first
            branch = c.number(here)
            c.ok &= ~(here & c.ok & (branch != 0) & (branch != 1))
            here = here & c.ok & (branch == 1)
        found.append((f.name, here, c.number(here) if f.name == "amount_paise" else c.text(here)))
    columns, ok = [], c.ok
    for name, here, value in found:
        if name != "amount_paise":
            value, broken = _texts(c.data, *value, here & ok)
            ok = ok & ~broken
        columns.append((here, value))
    out = []
    for here, value in columns:
        missing = pa.array(~(here & ok))
        out.append(pa.array(value, mask=~(here & ok)) if isinstance(value, np.ndarray) else pc.if_else(missing, None, value))
    return out


def has_from_avro(spark: SparkSession) -> bool:
    """Whether Spark's own Avro functions can be loaded in this session."""
    try:
        spark._jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass("org.apache.spark.sql.avro.AvroDataToCatalyst")
    except Exception:  # noqa: BLE001 - py4j wraps ClassNotFoundException
        return False
    return True


def decode(df: DataFrame, value: str = "value", builtin: bool | None = None) -> DataFrame:
    """df's frames as decodable, schema_id and the event columns; a payload that cannot be read leaves the columns null.

    Spark's from_avro does the work where its module is loaded (builtin: force one way); else batches are decoded column by column.
    """
    framed = df.select(*(c.alias(n) for n, c in frame(F.col(value)).items()))
    if builtin if builtin is not None else has_from_avro(df.sparkSession):
        from pyspark.sql.avro.functions import from_avro

        event = from_avro(F.col("payload"), json.dumps(EVENT_AVRO), {"mode": "PERMISSIVE"})
        return framed.select("decodable", "schema_id", event.alias("e")).select("decodable", "schema_id", *(F.col("e")[f.name].alias(f.name) for f in EVENT.fields))
    find_package(df.sparkSession)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("decodable"), b.column("schema_id"), *decode_columns(b.column("payload"))], names=["decodable", "schema_id", *(f.name for f in EVENT.fields)])

    return framed.mapInArrow(run, "decodable boolean, schema_id string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT.fields))


class RegistryError(RuntimeError):
    """A schema registry that had to answer and did not."""


class SchemaRegistry:
    """The newest schema id of a topic's values, asked over HTTP and remembered for `seconds`.

    required: no answer is an error; else it is logged and None is returned, so that the stream runs without the check. The last answer is
    used while the registry is away. fetch(url) returns the body, for other transports and for tests.
    """

    def __init__(self, url: str, required: bool = False, seconds: float = 300, fetch: Callable[[str], str | bytes] | None = None, clock: Callable[[], float] = time.monotonic):
        self.url, self.required, self.seconds, self.clock = url.rstrip("/"), required, seconds, clock
        self.fetch = fetch or self._get
        self.known: dict[str, tuple[float, str]] = {}

    @staticmethod
    def _get(url: str) -> bytes:
        if not url.startswith(("http://", "https://")):
            raise ValueError(f"not a registry address: {url}")
        with urllib.request.urlopen(url, timeout=10) as answer:  # noqa: S310 - the scheme is checked above
            return answer.read()

    def latest_id(self, topic: str) -> str | None:
        at, now = self.known.get(topic), self.clock()
        if at and now - at[0] < self.seconds:
            return at[1]
        try:
            found = str(int(json.loads(self.fetch(f"{self.url}/subjects/{urllib.parse.quote(topic, safe='')}-value/versions/latest"))["id"]))
        except Exception as e:  # noqa: BLE001 - any failure of the registry is one case
            if at:
                log.warning("schema registry does not answer (%s), the last id holds", e)
                return at[1]
            if self.required:
                raise RegistryError(f"no schema id for {topic}: {e}") from e
            log.warning("no schema id for %s, events are not checked against it: %s", topic, e)
            return None
        self.known[topic] = (now, found)
        return found


def from_json(df: DataFrame, value: str = "value") -> DataFrame:
    """Events that come as JSON text."""
    return df.select(F.from_json(F.col(value).cast("string"), EVENT).alias("e")).select("e.*").where(F.col("transaction_id").isNotNull())


def kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", most_per_trigger: int = 200_000, sasl: dict[str, str] | None = None, require_sasl: bool = False) -> DataFrame:
    """A Kafka stream; needs Spark's Kafka connector. An unprotected connection is refused where protection is required."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting, most_per_trigger, sasl, require_sasl)).load()


def kafka_options(servers: str, topic: str, starting: str = "earliest", most_per_trigger: int = 200_000, sasl: dict[str, str] | None = None, require_sasl: bool = False) -> dict[str, str]:
    if require_sasl and not sasl:
        raise ValueError("an unprotected Kafka connection is not allowed")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "maxOffsetsPerTrigger": str(most_per_trigger)}
    if sasl:
        login = f'org.apache.kafka.common.security.scram.ScramLoginModule required username="{sasl["username"]}" password="{sasl["password"]}";'
        options |= {"kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "SCRAM-SHA-512", "kafka.sasl.jaas.config": login}
    return options


def files(spark: SparkSession, path: str) -> DataFrame:
    """A stream of Parquet files with a binary value column."""
    return spark.readStream.schema("value binary").parquet(path)
