"""Command lines: `python -m tallyforge.plans.cli validate|daily|replay|maintain ...`. Results are one JSON line."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from .. import control
from ..operators.ledger_store import LedgerStore
from ..sources import settlement_files
from . import daily


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tallyforge")
    p.add_argument("--store", required=True, help="root folder of the tables")
    sub = p.add_subparsers(dest="command", required=True)
    v = sub.add_parser("validate", help="a provider's file to curated and quarantined rows")
    v.add_argument("file")
    v.add_argument("--out", required=True)
    v.add_argument("--date")
    v.add_argument("--provider")
    v.add_argument("--rows-before", type=int)
    v.add_argument("--registry")
    v.add_argument("--quarantine-max-pct", type=float, default=0.0)
    d = sub.add_parser("daily", help="one batch from curated file to published ledger and mart")
    d.add_argument("folder")
    d.add_argument("--date", help="YYYY-MM-DD; default: from the newest file's name")
    d.add_argument("--statements")
    d.add_argument("--metrics")
    d.add_argument("--slo", type=float, default=0.95)
    d.add_argument("--lenient", action="store_true", help="log a missed rate, a failed residual leg and a stale mart instead of failing")
    d.add_argument("--allow-unvalidated", action="store_true")
    d.add_argument("--legs", default="bank,residual,late")
    r = sub.add_parser("replay", help="dead letters into the ledger")
    r.add_argument("--delete", action="store_true")
    r.add_argument("--reason", default="")
    r.add_argument("--approved-by", default="")
    r.add_argument("--journal")
    m = sub.add_parser("maintain", help="compact, expire and clean tables")
    m.add_argument("tables", nargs="+", help="name or name=snapshots to retain")
    return p


def run(spark: SparkSession, argv: list[str], now: str | None = None) -> dict:
    """The result of a command; what it refuses is an exception."""
    a = parser().parse_args(argv)
    now = now or f"{datetime.now(timezone.utc):%Y-%m-%d %H:%M:%S}"
    store = LedgerStore(spark, a.store)
    if a.command == "validate":
        day = settlement_files.batch_date(a.date, a.file)
        o = daily.Options(as_of=day, quarantine_max_pct=a.quarantine_max_pct)
        return daily.validate_file(spark, a.file, a.out, day, o, a.rows_before, control.FileRegistry(a.registry) if a.registry else None, a.provider)
    if a.command == "daily":
        day = a.date or settlement_files.batch_date(None, settlement_files.latest(spark, f"{a.folder}/*settlement_*.csv"))
        o = daily.Options(as_of=now[:10], match_rate_slo=a.slo, strict_slo=not a.lenient, allow_unvalidated=a.allow_unvalidated, legs=tuple(x for x in a.legs.split(",") if x))
        return daily.run_daily(spark, store, a.folder, day, o, a.statements, a.metrics)
    if a.command == "replay":
        return daily.replay_dead_letters(store, now, a.delete, a.reason, a.approved_by, a.journal)
    return store.maintain({t.partition("=")[0]: int(t.partition("=")[2] or 10) for t in a.tables})


def main() -> None:
    spark = SparkSession.builder.appName("tallyforge").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        print(json.dumps(run(spark, sys.argv[1:]), default=str))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
