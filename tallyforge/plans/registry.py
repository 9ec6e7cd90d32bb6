"""The registered queries of the reconciliation engine and their DuckDB twins.

The twins are written from the rules, not from the Spark plans: rates as CASE, evidence as NOT EXISTS.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import dates, money, text
from ..functions.rates import Providers, RateBook
from ..functions.workers import find_package
from ..operators import adapters, bank, dlq, fold, mart, migrations, reconcile, residual, seed, validate
from ..operators.ledger_store import LedgerStore
from ..sources import mt940, wire
from ..streaming import ingest, windows
from . import derived as D

Query = Callable[[SparkSession, str], DataFrame]
MART_FOLDER = Path(__file__).resolve().parent.parent / "config" / "mart"


def _book() -> RateBook:
    return RateBook.load()


def _folded(spark: SparkSession, sf: str) -> DataFrame:
    return fold.fold(D.settlements(spark, sf))


def _merged(spark: SparkSession, sf: str, folded: DataFrame | None = None) -> DataFrame:
    return reconcile.settlement_merge(D.webhooks(spark, sf), _folded(spark, sf) if folded is None else folded, _book())


def _bank(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The folded settlements with their tolerance, the statements, and the folded settlements for the merge.

    The bank leg looks at each side several times, so the rows and both sides are derived once and written; what is asked of them reads files.
    """
    rows = _written(D.settlements(spark, sf), "settlements")
    folded = _written(bank.with_tolerance(fold.fold(rows), _book()), "folded")
    return folded.select("transaction_id", "settled_amount_paise", "settlement_date", "tolerance"), _written(D.statements(spark, sf, rows), "statements"), folded.drop("tolerance")


def settlement_decision(spark, sf):
    decided = reconcile.decide(reconcile.merge_source(_folded(spark, sf)), D.webhooks(spark, sf), _book())
    return decided.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("settled_amount_paise").alias("settled_paise"))


def settlement_fold(spark, sf):
    return _folded(spark, sf)


def partial_settlements(spark, sf):
    return _folded(spark, sf).where("instalments > 1").select("transaction_id", "instalments", "settled_amount_paise")


def redelivery_collapse(spark, sf):
    return fold.collapse_redeliveries(fold.one_partitioning(D.settlements(spark, sf))).select("transaction_id", "settled_amount_paise", "settlement_date", "bank_ref_id", "settlement_id")


def fee_net(spark, sf):
    rows = _book().with_net(D.settlements(spark, sf), "gross_amount_paise", "instrument_type", "merchant_id", "settlement_date")
    return rows.select("settlement_id", F.col("rate_fee").alias("fee"), F.col("rate_fee_gst").alias("gst"), F.col("rate_net").alias("net"))


def rate_card_asof(spark, sf):
    v = _book().card_version(F.col("settlement_date"))
    return D.settlements(spark, sf).groupBy(v.alias("version"), "instrument_type").agg(F.count(F.lit(1)).alias("n"))


def fee_fallback_census(spark, sf):
    return reconcile.fallback_census(_folded(spark, sf), _book())


def settlement_merge(spark, sf):
    return _merged(spark, sf).select("transaction_id", "amount_paise", "gateway_status", "timestamp_utc", "merchant_id", "reconciliation_status", "bank_ref_id", "instrument_type", "currency")


def status_counts(spark, sf):
    return reconcile.status_tile(_merged(spark, sf), _folded(spark, sf))


def batch_counters(spark, sf):
    return reconcile.batch_counters(D.settlements(spark, sf))


def match_rate(spark, sf):
    counts = reconcile.rate_counts(reconcile.late_sweep(_merged(spark, sf), D.AS_OF, D.LATE_DAYS), _folded(spark, sf), Providers.load())
    base = F.greatest(F.col("evaluated") - F.col("within_lag"), F.lit(0))
    return counts.select("*", F.when(base > 0, F.col("matched").cast("double") / base).alias("rate"))


def late_sweep(spark, sf):
    return reconcile.late_sweep(_merged(spark, sf), D.AS_OF, D.LATE_DAYS).groupBy("reconciliation_status").agg(F.count(F.lit(1)).alias("n"))


def missing_within_lag(spark, sf):
    return reconcile.missing_within_lag(_merged(spark, sf), _folded(spark, sf), Providers.load())


def depth_gauges(spark, sf):
    return reconcile.depth_gauges(reconcile.late_sweep(_merged(spark, sf), D.AS_OF, D.LATE_DAYS), D.dead_letters(spark, sf))


def provider_batches(spark, sf):
    return reconcile.provider_batches(D.settlements(spark, sf))


def mismatch_spread(spark, sf):
    rows = reconcile.priced(reconcile.merge_source(_folded(spark, sf)), D.webhooks(spark, sf), _book(), "inner")
    gap = F.abs(F.col("rate_net") - F.col("settled_amount_paise"))
    return reconcile.mismatch_spread(rows.where(gap > F.col("rate_tol")).select(gap.alias("difference")))


def bank_missing(spark, sf):
    s, b, _ = _bank(spark, sf)
    return bank.missing(s, b, D.LAG_DAYS).select("transaction_id", "settled_amount_paise", "settlement_date")


def bank_orphans(spark, sf):
    s, b, _ = _bank(spark, sf)
    return bank.orphans(b, s, D.LAG_DAYS).select("statement_id", "amount_paise", "value_date", "link_tx")


def bank_demote(spark, sf):
    s, b, folded = _bank(spark, sf)
    return bank.demote(_merged(spark, sf, folded), bank.missing(s, b, D.LAG_DAYS)).groupBy("reconciliation_status").agg(F.count(F.lit(1)).alias("n"))


def bank_counters(spark, sf):
    s, b, folded = _bank(spark, sf)
    return bank.leg_counters(_merged(spark, sf, folded), bank.missing(s, b, D.LAG_DAYS), bank.orphans(b, s, D.LAG_DAYS))


def residual_score(spark, sf):
    return residual.scored(_merged(spark, sf), _folded(spark, sf), _book()).select("transaction_id", F.round("score", 9).alias("score"))


def residual_demote(spark, sf):
    ledger = _merged(spark, sf)
    return residual.demote(ledger, residual.scored(ledger, _folded(spark, sf), _book())).groupBy("reconciliation_status").agg(F.count(F.lit(1)).alias("n"))


def dlq_split(spark, sf):
    kind = F.when(dlq.forward(), "forward").when(dlq.reversal(), "reversal").otherwise("rejected")
    return D.arrivals(spark, sf).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def reversal_split(spark, sf):
    return D.arrivals(spark, sf).where(dlq.reversal()).select("transaction_id", "amount_paise", dlq.ingest_status().alias("status"))


def ingest_upsert(spark, sf):
    after = ingest.upsert(D.webhooks(spark, sf), ingest.newest(D.arrivals(spark, sf)), D.NOW)
    return after.select("transaction_id", "amount_paise", "gateway_status", "timestamp_utc", "processing_run_id", "reconciliation_status", "currency", "duplicate_mutation_count")


def duplicate_mutation(spark, sf):
    return ingest_upsert(spark, sf).groupBy("reconciliation_status").agg(F.sum("duplicate_mutation_count").alias("duplicates"))


def dlq_content_hash(spark, sf):
    return D.dead_letters(spark, sf).select("payload_hash", "transaction_id", "amount_paise")


def dlq_replayable(spark, sf):
    return dlq.replay_counts(D.webhooks(spark, sf), D.dead_letters(spark, sf))


def dlq_replay(spark, sf):
    after = dlq.replay(D.webhooks(spark, sf), D.dead_letters(spark, sf), D.NOW)
    return after.groupBy("reconciliation_status", "processing_run_id").agg(F.count(F.lit(1)).alias("n"))


def dlq_purge(spark, sf):
    return dlq.purge(D.dead_letters(spark, sf)).select("payload_hash")


def ingest_gauges(spark, sf):
    g = ingest.gauges(D.arrivals(spark, sf), ingest.Settings(now=D.NOW))
    keys = ["rows", "late", "unreadable_time", "pan", "reversals", "rejected"]
    return spark.createDataFrame([tuple(g[k] for k in keys)], ", ".join(f"{k} long" for k in keys))


def schema_ids(spark, sf):
    return D.arrivals(spark, sf).where("decodable").select("schema_id").distinct()


def _mart(name: str) -> Query:
    return lambda spark, sf: getattr(mart, name)(_merged(spark, sf))


def q_dlq_depth(spark, sf):
    return mart.dlq_depth(D.dead_letters(spark, sf))


def validation_violations(spark, sf):
    rows = adapters.normalise(D.provider_file(spark, sf, "cashfree"))
    return rows.select(F.explode(validate.violations()).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def quarantine_split(spark, sf):
    rows = D.settlements(spark, sf)
    good, bad = validate.split(rows)
    return good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("valid").alias("part"), "n").unionByName(bad.agg(F.count(F.lit(1)).alias("n")).select(F.lit("quarantined").alias("part"), "n"))


def calendar_mask(spark, sf):
    made = F.concat(F.substring("settlement_date", 1, 8), F.lpad((F.length("settlement_id") * 7 % 40).cast("string"), 2, "0"))
    rows = D.settlements(spark, sf).select("settlement_id", made.alias("day"))
    return rows.where(dates.impossible_date(F.col("day")))


def _normalise(provider: str) -> Query:
    return lambda spark, sf: adapters.normalise(D.provider_file(spark, sf, provider))


def instrument_alias(spark, sf):
    """Every order with one of the known spellings, in rotation."""
    raw = F.element_at(F.array(*[F.lit(x) for x in D.SPELLINGS]), (D.h("spell") % len(D.SPELLINGS)).cast("int") + 1)
    rows = D.base(spark, sf).select(raw.alias("raw"))
    return rows.groupBy("raw", text.instrument(F.col("raw")).alias("instrument")).agg(F.count(F.lit(1)).alias("orders"))


def inr_to_paise(spark, sf):
    rows = D.provider_file(spark, sf, "cashfree")
    return rows.select("order_id", money.minor_units(F.col("amount")).alias("paise"))


def iso_date(spark, sf):
    rows = D.provider_file(spark, sf, "cashfree")
    return rows.select("order_id", dates.iso_text(F.col("settlement_date")).alias("day"))


def provider_lag(spark, sf):
    p = Providers.load()
    return D.settlements(spark, sf).groupBy("provider", p.lag(F.col("provider")).alias("lag")).agg(F.count(F.lit(1)).alias("n"))


def fault_bucket(spark, sf):
    return D.base(spark, sf).groupBy(D.h("fault").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def pan_scan(spark, sf):
    rows = D.base(spark, sf).select(F.col("transaction_id"), F.when(D.h("pan") < 5, F.concat(F.lit("card 4111 1111 1111 1111 of "), F.col("k").cast("string"))).otherwise(F.concat(F.lit("411111111111"), F.col("k").cast("string"))).alias("note"))
    return validate.pan_counts(rows)


def _frames(spark: SparkSession, sf: str) -> DataFrame:
    """Events of the arrivals as wire frames, some of them broken; an event without an id has no place in the format."""
    find_package(spark)
    fields = [f.name for f in S.EVENT.fields]

    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = b.to_pylist()
            made = [wire.encode_event({f: r[f] if r[f] is not None else ("" if i < 5 and f != "amount_paise" else None) for i, f in enumerate(fields)}) if r["decodable"] else b"{}" for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["value"])

    return D.arrivals(spark, sf).where("transaction_id IS NOT NULL").mapInArrow(run, "value binary")


def avro_decode(spark, sf):
    return wire.decode(_frames(spark, sf)).select("decodable", "schema_id", "transaction_id", "amount_paise", "timestamp_utc", "currency")


def mt940_roundtrip(spark, sf):
    lines = mt940.lines(_folded(spark, sf))
    files = lines.select(F.lit("made").alias("path"), F.col("line").alias("value"))
    return mt940.parse(files).select("bank_ref", "amount_paise", "value_date", "direction", "link_tx")


def stream_ingest(spark, sf):
    """A whole stream run: frames from files, one pass over what is there, the ledger that it leaves."""
    root = _shared(spark)
    _frames(spark, sf).write.parquet(f"{root}/frames")
    store = LedgerStore(spark, f"{root}/store")
    q = ingest.start(wire.files(spark, f"{root}/frames"), store, f"{root}/checkpoint", ingest.Settings(now=D.NOW), {"availableNow": True})
    q.awaitTermination()
    return store.read("webhooks").groupBy("reconciliation_status").agg(F.count(F.lit(1)).alias("n"))


def branch_publish(spark, sf):
    """A batch merged on a branch, seen on main only when published; both are read before and after."""
    store = LedgerStore(spark, f"{_shared(spark)}/store")
    store.create("webhooks", S.LEDGER, key="transaction_id")
    store.open("webhooks").replace(D.webhooks(spark, sf))
    store.branch("webhooks", "ingest_2027-01-01")
    store.transact("webhooks", lambda v: v.apply(reconcile.settlement_changes(v.rows, _folded(spark, sf), _book())), "ingest_2027-01-01")
    tally = lambda df, when: df.groupBy("reconciliation_status").agg(F.count(F.lit(1)).alias("n")).select(F.lit(when).alias("seen"), "reconciliation_status", "n")
    before = tally(store.read("webhooks"), "before")
    store.publish("webhooks", "ingest_2027-01-01", validated=True)
    store.compact("webhooks")
    return before.unionByName(tally(store.read("webhooks"), "after"))


def ledger_seed(spark, sf):
    """All orders staged anew."""
    staged = D.base(spark, sf).select("transaction_id", F.col("gross").alias("amount_paise"), F.date_format("od", "yyyy-MM-dd").alias("day"), "merchant_id")
    after = seed.seed(D.webhooks(spark, sf), staged, allow=True)
    return after.groupBy("reconciliation_status").agg(F.count(F.lit(1)).alias("n"), F.sum("amount_paise").alias("paise"))


def benchmark_slice(spark, sf):
    """A merge input of the first 500 transactions, as a benchmark takes it."""
    return seed.slice_of(D.webhooks(spark, sf), D.settlements(spark, sf).select("transaction_id", "settlement_date"), 500)


def json_decode(spark, sf):
    """JSON event properties decoded and summed."""
    e = spark.read.parquet(f"{sf}/events.parquet").select("event_type", F.from_json("props", "k long").alias("p"))
    return e.groupBy("event_type").agg(F.count("p.k").alias("n"), F.sum("p.k").alias("total"))


def events_windows(spark, sf):
    """An extension: tumbling windows of the events table, as a stream would form them."""
    e = spark.read.parquet(f"{sf}/events.parquet")
    w = e.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("w.start").cast("date").alias("day"), "event_type", "n")


def click_windows(spark, sf):
    """Hourly windows of the clicks as a stream forms them that is started anew for each month's deliveries; rows that come too late are counted."""
    clicks = spark.read.parquet(f"{sf}/clicks.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    month = F.coalesce(F.month("arrived_at"), F.lit(13))
    lots = [clicks.where(month == r[0]) for r in clicks.select(month.alias("m")).distinct().orderBy("m").collect()]  # 13 at most
    shape = lambda df: windows.tumbling(df, "ts", "1 hour", "1 hour", ["kind"], [F.count(F.lit(1)).alias("n"), F.max("value").alias("most")])
    run = windows.over_deliveries(lots, shape, _shared(spark), "ts")
    by_day = run.windows.groupBy(F.col("start").cast("date").alias("day"), "kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("hours"), F.max("most").alias("most"))
    late = spark.range(1).select(F.lit(None).cast("date").alias("day"), F.lit("too late").alias("kind"), F.lit(run.late).cast("long").alias("n"), F.lit(0).cast("long").alias("hours"), F.lit(None).cast("double").alias("most"))
    return by_day.unionByName(late)


def click_sessions(spark, sf):
    """Sessions of clients with pauses of half an hour at most, as a stream with state forms them."""
    clicks = spark.read.parquet(f"{sf}/clicks.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    shape = lambda df: windows.sessions(df, "ts", "30 minutes", "1 hour", ["client_id"], [F.count(F.lit(1)).alias("n")])
    run = windows.over_deliveries([clicks], shape, _shared(spark), "ts")
    return run.windows.groupBy("client_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("n").alias("n"), F.max("n").alias("longest"))


def mart_versions(spark, sf):
    """The mart brought through all its versions in a store, and read from there."""
    store = LedgerStore(spark, f"{_shared(spark)}/store")
    migrations.refresh(store, _merged(spark, sf), migrations.load(MART_FOLDER))
    return store.read("fact_reconciliation").groupBy("status", F.col("transacted_at").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum("matched_amount_paise").alias("matched_paise"))


def _shared(spark: SparkSession) -> str:
    """A new folder that driver and executors share, below the checkpoint folder; only a local master may name none."""
    import uuid

    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir names no folder that the driver and the executors share")
    shared = shared or tempfile.mkdtemp(prefix="tallyforge-")
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def _written(rows: DataFrame, name: str) -> DataFrame:
    """rows, written once to the shared folder, and read from there."""
    path = f"{_shared(rows.sparkSession)}/{name}"
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


MART = ["kpi_match_rate", "kpi_volume_rupees", "kpi_at_risk_rupees", "match_rate", "daily_match_rate", "daily_trend", "volume_by_instrument", "mismatch_by_instrument", "exceptions_by_merchant", "top_mismatches"]


def queries() -> dict[str, Query]:
    plain = [
        settlement_decision, settlement_fold, partial_settlements, redelivery_collapse, fee_net, rate_card_asof, fee_fallback_census, settlement_merge, status_counts, batch_counters,
        match_rate, late_sweep, missing_within_lag, depth_gauges, provider_batches, mismatch_spread, bank_missing, bank_orphans, bank_demote, bank_counters, residual_score, residual_demote,
        dlq_split, reversal_split, ingest_upsert, duplicate_mutation, dlq_content_hash, dlq_replayable, dlq_replay, dlq_purge, ingest_gauges, schema_ids, q_dlq_depth, validation_violations,
        quarantine_split, calendar_mask, instrument_alias, inr_to_paise, iso_date, provider_lag, fault_bucket, pan_scan, avro_decode, mt940_roundtrip, stream_ingest, branch_publish, click_windows, click_sessions, mart_versions, ledger_seed, benchmark_slice, json_decode, events_windows,
    ]
    out = {f.__name__: f for f in plain}
    out |= {f"q_{n}": _mart(n) for n in MART} | {"mart": _mart("fact_reconciliation")}
    return out | {f"normalize_{p}": _normalise(p) for p in ("razorpay", "cashfree", "payu", "generic")}


def oracle_sql() -> dict[str, str]:
    from .oracles import SQL

    return dict(SQL)
