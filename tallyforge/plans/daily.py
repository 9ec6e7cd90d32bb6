"""The daily batch: validate a settlement file, reconcile it on a branch, gate it, publish it."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import control
from .. import schemas as S
from ..functions.rates import Providers, RateBook
from ..operators import adapters, bank, fold, migrations, reconcile, residual, validate
from ..operators.ledger_store import LedgerStore, Version
from ..sources import mt940, settlement_files
from ..streaming import ingest

log = logging.getLogger(__name__)


@dataclass
class Options:
    """Everything a run depends on; the defaults refuse whatever is doubtful."""

    as_of: str
    book: RateBook = field(default_factory=RateBook.load)
    providers: Providers = field(default_factory=Providers.load)
    match_rate_slo: float = 0.95
    strict_slo: bool = True
    strict_rates: bool = False
    strict_volume: bool = True
    quarantine_max_pct: float = 0.0
    late_sla_days: int | None = None
    allow_unvalidated: bool = False
    legs: tuple[str, ...] = ("bank", "residual", "late")
    retain: int = 10
    mart_folder: str = str(Path(__file__).resolve().parent.parent / "config" / "mart")


def validate_file(spark: SparkSession, path: str, out: str, batch_date: str, o: Options, rows_before: int | None = None, registry: control.FileRegistry | None = None, hint: str | None = None) -> dict:
    """A provider's file to <out>/curated_settlement_<date>.csv; broken rows to <out>/quarantine_<date>.csv.

    Card numbers, too many broken rows or an unlikely number of rows refuse the file; nothing is curated then.
    """
    canonical = adapters.normalise(settlement_files.read_raw(spark, path), hint).persist()
    try:
        validate.refuse_pans(canonical)
        good, bad = validate.split(canonical)
        rows, quarantined = validate.quarantine_rate(canonical)
        day = batch_date.replace("-", "")
        if quarantined:
            settlement_files.write_csv(bad, f"{out}/quarantine_{day}.csv")
        usual = validate.check_volume(rows - quarantined, rows_before, o.strict_volume)
        validate.check_quarantine(rows, quarantined, o.quarantine_max_pct)
        settlement_files.write_csv(good, f"{out}/curated_settlement_{day}.csv")
    finally:
        canonical.unpersist()
    if registry is not None:
        registry.record(settlement_files.content_hash(spark, path), Path(path).name, batch_date)
    return {"rows": rows, "quarantined": quarantined, "usual_volume": usual}


def reconcile_batch(store: LedgerStore, settlements: DataFrame, o: Options, branch: str, statements: DataFrame | None = None, table: str = "webhooks") -> dict:
    """Merge a batch into a branch, leg by leg; counters of what happened. Each leg commits one snapshot."""
    folded = fold.fold(settlements).persist()
    counts: dict = {}
    try:
        census = {r["reason"]: r["n"] for r in reconcile.fallback_census(folded, o.book).collect()}
        counts |= {f"fee_{k}_rows": v for k, v in census.items()}
        if o.strict_rates and any(census.values()):
            raise reconcile.GateError(f"rows without a proper rate: {census}")
        counts |= reconcile.batch_counters(settlements).first().asDict()
        store.transact(table, lambda v: v.apply(reconcile.settlement_changes(v.rows, folded, o.book)), branch)
        if statements is not None and "bank" in o.legs:
            lag = int(o.providers.spec(None)["lag_days"])
            rows = bank.with_tolerance(folded, o.book).select("transaction_id", "settled_amount_paise", "settlement_date", "tolerance")
            numbered = statements if "statement_id" in statements.columns else statements.withColumn("statement_id", F.monotonically_increasing_id())
            numbered = numbered.persist()
            at = store.open(table, branch)
            unproven = bank.missing(rows, numbered, lag).persist()
            counts |= {f"bank_{r['counter']}": r["n"] for r in bank.leg_counters(at.rows, unproven, bank.orphans(numbered, rows, lag)).collect()}
            at.apply(bank.demotions(at.rows, unproven))
            numbered.unpersist()
            unproven.unpersist()
        if "late" in o.legs:
            days = o.late_sla_days if o.late_sla_days is not None else int(o.providers.spec(None)["late_sla_days"])
            store.transact(table, lambda v: v.apply(reconcile.late_changes(v.rows, o.as_of, days)), branch)
        at = store.open(table, branch)
        ledger = at.rows
        counts["missing_within_lag"] = reconcile.missing_within_lag(ledger, folded, o.providers).count()
        tile = reconcile.status_tile(ledger, folded).collect()
        counts["table"] = {r["status"]: r["n"] for r in tile if r["scope"] == "table"}
        counts["batch"] = {r["status"]: r["n"] for r in tile if r["scope"] == "batch"}
        counts["duplicate_mutations"] = next(r["n"] for r in tile if r["scope"] == "duplicates")
        counts["match_rate"] = reconcile.match_rate(counts["batch"].get(S.MATCHED, 0), counts["evaluated"], counts["missing_within_lag"])
        if o.strict_slo:
            reconcile.check_slo(counts["match_rate"], o.match_rate_slo)
        if "residual" in o.legs:
            try:
                _residual(at, folded, o, counts)
            except reconcile.GateError:
                raise
            except Exception as e:
                if o.strict_slo:
                    raise RuntimeError(f"the residual leg failed: {e}") from e
                log.warning("the residual leg failed, the batch goes on without it: %s", e)
    finally:
        folded.unpersist()
    return counts


def _residual(at: Version, folded: DataFrame, o: Options, counts: dict) -> None:
    """Demote suspicious matches of a version that was just read, and correct the counts."""
    scores = residual.scored(at.rows, folded, o.book).persist()
    try:
        demoted = scores.where(F.col("score") >= residual.TAU).count()
        if demoted:
            at.apply(residual.demotions(at.rows, scores))
            counts["batch"] = reconcile.fold_residual(counts["batch"], demoted)
            counts["match_rate"] = reconcile.match_rate(counts["batch"].get(S.MATCHED, 0), counts["evaluated"], counts["missing_within_lag"])
        counts["residual_demoted"] = demoted
    finally:
        scores.unpersist()


def run_daily(spark: SparkSession, store: LedgerStore, folder: str, batch_date: str, o: Options, statement_path: str | None = None, metrics: str | None = None) -> dict:
    """One batch from curated file to published ledger, mart and metrics. A failed gate leaves main as it was."""
    source = settlement_files.resolve(spark, folder, batch_date, o.allow_unvalidated)
    settlements = settlement_files.read_curated(spark, source)
    statements = mt940.read(spark, statement_path) if statement_path else None
    ingest.create_tables(store)
    branch = f"ingest_{batch_date}"
    store.branch("webhooks", branch)
    try:
        counts = reconcile_batch(store, settlements, o, branch, statements)
        reconcile.check_drift(counts["batch"], counts.get("evaluated"), counts.get("deduped_rows"))
        if o.strict_slo:
            reconcile.check_slo(counts["match_rate"], o.match_rate_slo)
        store.publish("webhooks", branch, validated=True)
        counts["mart_version"] = migrations.refresh(store, store.read("webhooks"), migrations.load(o.mart_folder), strict=o.strict_slo)
    finally:
        store.drop("webhooks", branch)
    counts["dlq_depth"] = store.read("webhooks_dlq").count()
    if metrics:
        control.batch_metrics(metrics, batch_date, counts)
    counts["maintenance"] = store.maintain({"webhooks": o.retain, "fact_reconciliation": 1})
    return counts


def replay_dead_letters(store: LedgerStore, now: str, delete: bool = False, reason: str = "", approved_by: str = "", journal_folder: str | None = None) -> dict:
    """Insert replayable dead letters into the ledger; delete them only with a reason and an approver, both journalled."""
    from ..operators import dlq

    at, kept = store.open("webhooks"), store.open("webhooks_dlq")
    ledger, letters = at.rows, kept.rows
    counts = dlq.replay_counts(ledger, letters).first().asDict()
    if not counts["replayable"]:
        return {"replayable": 0, "inserted": 0, "reversal_stranded": counts["stranded"]}
    validate.refuse_pans(letters.where(dlq.replayable()).drop("payload_hash"))
    if delete and not (reason.strip() and approved_by.strip()):
        raise ValueError("deleting dead letters needs a reason and an approver")
    fresh = dlq.replay_rows(ledger, letters, now).persist()
    try:
        inserted = fresh.count()
        at.apply(fresh)  # refused if the ledger has moved since it was read
    finally:
        fresh.unpersist()
    if delete:
        kept.apply(dlq.replayed(letters).withColumn("_deleted", F.lit(True)))
        control.journal(journal_folder or ".", "dlq_purge", reason, approved_by, {"rows": counts["replayable"]})
    return {"replayable": counts["replayable"], "inserted": inserted, "deleted": delete, "reversal_stranded": counts["stranded"]}
