"""Versions of the reporting mart: ordered steps that are recorded in the store as they are applied.

A step is a query over the ledger, from a file V<number>__<name>.sql (with __SOURCE_TABLE__ for the ledger) or a function. The newest
one defines the mart. Steps run in the order of their numbers, each is recorded after its commit, and a run that failed goes on
where it stopped. A recorded step whose text has changed is refused.
"""

from __future__ import annotations

import hashlib
import logging
import re
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .ledger_store import LedgerStore
from .mart import fact_reconciliation

log = logging.getLogger(__name__)
FILE = re.compile(r"^V(\d+)__(\w+)\.sql$")
RECORD = T.StructType([T.StructField("mart", T.StringType()), T.StructField("version", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("step", T.StringType())])


class MigrationError(RuntimeError):
    """A step that must not be applied."""


@dataclass(frozen=True)
class Migration:
    version: int
    name: str
    build: Callable[[DataFrame], DataFrame]
    digest: str = ""


def of_sql(version: int, name: str, sql: str) -> Migration:
    """A step from a SELECT over __SOURCE_TABLE__."""

    def build(ledger: DataFrame) -> DataFrame:
        return ledger.sparkSession.sql(sql.replace("__SOURCE_TABLE__", "{ledger}"), ledger=ledger)

    return Migration(version, name, build, hashlib.sha256(sql.strip().encode()).hexdigest())


def load(folder: str | Path) -> list[Migration]:
    """The steps of a folder by number (V10 comes after V2); two of one number are refused. No files: the built-in step."""
    found = sorted(((int(m[1]), m[2], p) for p in Path(folder).glob("V*.sql") if (m := FILE.match(p.name))), key=lambda x: x[:2])
    numbers = [v for v, _, _ in found]
    if len(set(numbers)) < len(numbers):
        raise MigrationError(f"two steps of one number in {folder}")
    return [of_sql(v, n, p.read_text(encoding="utf-8")) for v, n, p in found] or [Migration(0, "inline", fact_reconciliation)]


def applied(store: LedgerStore, mart: str, record: str = "mart_migrations") -> dict[int, str]:
    """The digests of a mart's recorded steps by version."""
    store.create(record, RECORD, key="step", buckets=1)
    return {r["version"]: r["digest"] for r in store.read(record).where(f"mart = '{mart}'").collect()}


def migrate(store: LedgerStore, ledger: DataFrame, steps: list[Migration], mart: str = "fact_reconciliation", record: str = "mart_migrations") -> list[int]:
    """Apply the steps that are not recorded yet, in order; the versions applied now. Columns of earlier steps stay in the schema."""
    done, now = applied(store, mart, record), []
    for m in sorted(steps, key=lambda m: m.version):
        if m.version in done:
            if done[m.version] != m.digest:
                raise MigrationError(f"step {m.version} of {mart} was applied with another text")
            continue
        if done and m.version < max(done):
            raise MigrationError(f"step {m.version} of {mart} comes after {max(done)} was applied")
        rows = m.build(ledger)
        store.create(mart, rows.schema)
        store.transact(mart, lambda v, rows=rows: v.replace(rows))
        row = store.spark.createDataFrame([(mart, m.version, m.name, m.digest, f"{mart}:{m.version}")], RECORD)
        store.transact(record, lambda v, row=row: v.apply(row))
        done[m.version] = m.digest
        now.append(m.version)
        log.info("mart %s is at V%s %s", mart, m.version, m.name)
    return now


def refresh(store: LedgerStore, ledger: DataFrame, steps: list[Migration], mart: str = "fact_reconciliation", strict: bool = True) -> str | None:
    """Bring the mart to its newest version and its rows up to date; the version's name. Not strict: a failure is logged and None."""
    try:
        if not migrate(store, ledger, steps, mart):
            newest = max(steps, key=lambda m: m.version)
            store.transact(mart, lambda v: v.replace(newest.build(ledger)))
        return f"V{max(m.version for m in steps)}"
    except Exception as e:
        if strict:
            raise
        log.warning("the mart %s was not refreshed: %s", mart, e)
        return None
