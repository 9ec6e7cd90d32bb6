"""Files, statements, wire frames, streams, branches, dead letters, the daily batch and the controls."""

import json

import pytest
from pyspark.sql import functions as F

from tallyforge import control
from tallyforge import schemas as S
from tallyforge.operators import dlq
from tallyforge.operators.ledger_store import BranchError, ConflictError, LedgerStore
from tallyforge.plans import daily
from tallyforge.sources import mt940, settlement_files, wire
from tallyforge.streaming import ingest

EVENT = {"transaction_id": "tx_1", "amount_paise": 100, "gateway_status": "CAPTURED", "timestamp_utc": "2026-06-10T09:00:00Z", "merchant_id": "m", "processing_run_id": None, "currency": "INR"}


def test_frames(spark):
    good = wire.encode_event(EVENT)
    frames = [good, b"\x01" + good[1:], good[:5], good[:3], None, good[:9], b"\0\0\0\0\1" + b'{"a": 1}']
    rows = wire.decode(spark.createDataFrame([(bytearray(f) if f is not None else None,) for f in frames], "value binary")).collect()
    assert [r.decodable for r in rows] == [True, False, False, False, False, True, True]
    assert rows[0].asDict() == {"decodable": True, "schema_id": "1"} | EVENT
    assert rows[5].transaction_id is None and rows[6].transaction_id is None
    big = EVENT | {"amount_paise": -(2**62), "merchant_id": "é" * 200}
    assert wire.decode_event(wire.encode_event(big)[5:]) == tuple(big.values())


def test_mt940(spark, tmp_path):
    body = ":20:X\n:25:1\n:60F:C000101INR0,00\n:61:1604020402C9764,00NTRFREF1//B1\n:86:pay TXN000000001\nmore\n:61:160402D45,5NTRFREF2\n:86:ReconRef 123456\n:61:160402RC1,00NTRFR3\n:61:160402rd2,NTRFR4\n:61:160402d3,00NTRFR5\n:62F:C000101INR0,00\n-"
    (tmp_path / "a.sta").write_text(body)
    rows = mt940.read(spark, str(tmp_path / "a.sta")).collect()
    assert [(r.amount_paise, r.direction) for r in rows] == [(976400, "CREDIT"), (-4550, "DEBIT"), (-100, "DEBIT"), (200, "CREDIT"), (-300, "DEBIT")]
    assert rows[0].asDict() == {"bank_ref": "REF1", "amount_paise": 976400, "value_date": "2016-04-02", "direction": "CREDIT", "link_tx": "TXN000000001", "narration": "pay TXN000000001 more"}
    assert rows[1].link_tx == "123456"
    for bad in ("garbage", ":61:169902C1,00NTRFX\n", ":61:160402C1,00NTRFX\n:86:card 4111111111111111\n"):
        (tmp_path / "b.sta").write_text(bad)
        with pytest.raises(ValueError if "card" not in bad else RuntimeError):
            mt940.read(spark, str(tmp_path / "b.sta"))


def test_mt940_written_file_reads_back(spark, tmp_path):
    s = spark.createDataFrame([("tx_000000000001", 9764, "2025-06-11", "br_1"), ("tx_2", 0, "2025-06-11", "br_2")], "transaction_id string, settled_amount_paise long, settlement_date string, bank_ref_id string")
    mt940.write(s, str(tmp_path / "out"))
    rows = mt940.read(spark, str(tmp_path / "out")).collect()
    assert [(r.bank_ref, r.amount_paise, r.link_tx) for r in rows] == [("br_1", 9764, "000000000001")]


def test_settlement_files(spark, tmp_path):
    (tmp_path / "settlement_20250611.csv").write_text("transaction_id;bank_ref_id;settled_amount_paise;settlement_date;instrument_type\ntx_1;b1;100;2025-06-11;UPI\ntx_2; ;NA;2025-06-11;UPI\n")
    raw = settlement_files.read_raw(spark, str(tmp_path / "settlement_20250611.csv"))
    assert raw.collect()[1]["bank_ref_id"] is None and raw.collect()[1]["settled_amount_paise"] is None
    with pytest.raises(FileNotFoundError):
        settlement_files.resolve(spark, str(tmp_path), "2025-06-11")
    assert settlement_files.resolve(spark, str(tmp_path), "2025-06-11", allow_unvalidated=True).endswith("settlement_20250611.csv")
    with pytest.raises(ValueError):
        settlement_files.resolve(spark, str(tmp_path), "11/06/2025")
    assert settlement_files.batch_date(None, "x_20250611.csv") == "2025-06-11"
    assert settlement_files.latest(spark, f"{tmp_path}/*.csv").endswith("settlement_20250611.csv")


def test_stream_equals_batch_and_replays_once(spark, tmp_path):
    events = [EVENT, EVENT | {"transaction_id": "tx_2", "amount_paise": -5, "gateway_status": " refund "}, EVENT | {"transaction_id": "tx_3", "amount_paise": 0}, EVENT | {"timestamp_utc": "2026-06-11T09:00:00Z", "amount_paise": 200}]
    spark.createDataFrame([(bytearray(wire.encode_event(e)),) for e in events] + [(bytearray(b"xx"),)], "value binary").coalesce(1).write.parquet(str(tmp_path / "in"))
    store = LedgerStore(spark, str(tmp_path / "store"))
    s = ingest.Settings(now="2026-06-12 00:00:00", expected_schema=None)
    ingest.start(wire.files(spark, str(tmp_path / "in")), store, str(tmp_path / "cp"), s, {"availableNow": True}).awaitTermination()
    rows = {r.transaction_id: r for r in store.read("webhooks").collect()}
    assert {k: (r.amount_paise, r.reconciliation_status) for k, r in rows.items()} == {"tx_1": (200, S.PENDING), "tx_2": (-5, S.REVERSAL)}
    assert store.read("webhooks_dlq").count() == 2  # the zero amount and the broken frame
    batch = ingest.events(spark.read.parquet(str(tmp_path / "in")))
    again = ingest.write_batch(store, s, stream=ingest.stream_name(spark, str(tmp_path / "cp")))
    again(batch, 0)  # the same batch again changes nothing
    assert store.read("webhooks").agg(F.sum("duplicate_mutation_count")).first()[0] == 0
    again(batch, 1)
    after = {r.transaction_id: r for r in store.read("webhooks").collect()}
    assert after["tx_2"].duplicate_mutation_count == 1 and after["tx_1"].duplicate_mutation_count == 0  # tx_1 still waits


def test_stream_stops_for_drift_and_pans(spark):
    batch = wire.decode(spark.createDataFrame([(bytearray(wire.encode_event(EVENT | {"merchant_id": "4111111111111111"}, 7)),)], "value binary"))
    with pytest.raises(ingest.PermanentError):
        ingest.check(ingest.gauges(batch, ingest.Settings()), ingest.Settings())
    with pytest.raises(ingest.PermanentError):
        ingest.check(ingest.gauges(batch, ingest.Settings()), ingest.Settings(expected_schema="1", refuse_pan=False))
    with pytest.raises(ValueError):
        ingest.events(batch, "soon")


def test_supervisor():
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("again")

    ingest.supervise(flaky, sleep=waits.append)
    assert len(calls) == 3 and waits == [10, 20]
    with pytest.raises(RuntimeError):
        ingest.supervise(lambda: 1 / 0 if False else (_ for _ in ()).throw(RuntimeError("x")), most=2, sleep=waits.append)
    with pytest.raises(ingest.PermanentError):
        ingest.supervise(lambda: (_ for _ in ()).throw(ingest.PermanentError("x")), sleep=waits.append)


def test_store_branches_and_upkeep(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path))
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    store.create("t", a.schema)
    store.open("t").replace(a)
    store.branch("t", "b")
    store.open("t", "b").replace(a.unionByName(spark.createDataFrame([(2, "y")], a.schema)))
    assert store.read("t").count() == 1 and store.read("t", "b").count() == 2
    with pytest.raises(BranchError):
        store.publish("t", "b", validated=False)
    store.open("t").replace(a)  # main moves on
    with pytest.raises(ConflictError):
        store.publish("t", "b", validated=True)
    store.drop("t", "b")
    store.create("t", spark.createDataFrame([], "k int, v string, w long").schema)
    assert store.read("t").first().w is None
    assert store.maintain({"t": 1, "missing": 1})["missing"].startswith("failed") and len(store.snapshots("t")) == 1
    assert store.read("t").count() == 1 and store.files("t").count() >= 1
    with pytest.raises(ValueError):
        store.open("t").apply(a)  # no key


KV = "k string, v int"


def test_row_changes_are_laid_over_and_folded(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path))
    rows = spark.range(20_000).selectExpr("concat('k', id) AS k", "cast(id AS int) AS v")
    store.create("t", rows.schema, key="k", buckets=4)
    first = store.open("t").replace(rows)
    size = lambda at: store._fs().getContentSummary(store._path("t", "data", at)).getLength()
    d = store.open("t").apply(spark.createDataFrame([("k1", -1, False), ("new", 7, False), ("k2", None, True)], f"{KV}, _deleted boolean"))
    assert size(d) < size(first) / 10  # what is written grows with the batch
    d2 = store.open("t").apply(spark.createDataFrame([("k1", -2)], KV))
    now = lambda: {r.k: r.v for r in store.read("t").where("v < 5 OR k = 'new'").collect()}
    assert now() == {"k0": 0, "k1": -2, "k3": 3, "k4": 4, "new": 7} and store.read("t").count() == 20_000
    assert {r.k: r.v for r in store.open("t").of_keys(spark.createDataFrame([("k1", 0), ("k2", 0), ("k9", 0)], KV)).collect()} == {"k1": -2, "k9": 9}
    before = store.open("t").manifest
    touched = store.compact("t")
    after = store.open("t").manifest
    assert set(touched) == {b for x in before["deltas"] for b in x["buckets"]} and after["deltas"] == [] and 0 < len(touched) < 4
    assert all(after["base"][b] == before["base"][b] for b in before["base"] if b not in touched)  # untouched buckets are not rewritten
    assert now() == {"k0": 0, "k1": -2, "k3": 3, "k4": 4, "new": 7} and store.read("t").count() == 20_000
    assert store.read("t", snapshot=first).count() == 20_000 and store.read("t", snapshot=d2).where("k = 'k2'").count() == 0
    store.expire("t", 1)
    assert store.snapshots("t") == [store.head("t")] and now()["k1"] == -2 and d not in store._names("t", "data")
    assert store.compact("t") == []


def test_two_writers_lose_nothing(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path))
    row = lambda k, v: spark.createDataFrame([(k, v)], KV)
    store.create("t", row("a", 1).schema, key="k", buckets=2)
    one, two = store.open("t"), store.open("t")
    one.replace(one.rows.unionByName(row("a", 1)))
    with pytest.raises(ConflictError):
        two.replace(two.rows.unionByName(row("b", 2)))
    tries = []

    def slow(v):
        tries.append(v.pointer)
        if len(tries) == 1:  # another stream commits between the reading and the writing
            store.transact("t", lambda w: w.apply(row("c", 3), notes={"A": 3}))
        v.apply(row("d", 4), notes={"B": 7})

    store.transact("t", slow)
    assert len(tries) == 2 and store.note("t") == {"A": 3, "B": 7}
    assert {r.k: r.v for r in store.read("t").collect()} == {"a": 1, "c": 3, "d": 4}
    with pytest.raises(ConflictError):
        store.transact("t", lambda v: (store.open("t").apply(row("e", 5)), v.apply(row("f", 6))), tries=2)


def test_threads_of_writers_lose_nothing(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    store = LedgerStore(spark, str(tmp_path))
    store.create("t", spark.createDataFrame([], KV).schema, key="k", buckets=2)
    add = lambda i: LedgerStore(spark, str(tmp_path)).transact("t", lambda v: v.apply(spark.createDataFrame([(f"k{i}", i)], KV), notes={f"s{i}": i}), tries=30)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(add, range(6)))
    assert sorted(r.v for r in store.read("t").collect()) == list(range(6)) and store.note("t") == {f"s{i}": i for i in range(6)}


def test_orphans_of_failed_writers_go(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path))
    row = spark.createDataFrame([("a", 1)], KV)
    store.create("t", row.schema, key="k", buckets=2)
    kept = store.open("t").apply(row)
    lost, _ = store._put("t", store._meta("t"), row)  # written, never named
    assert store.remove_orphans("t") == []  # too young
    assert store.remove_orphans("t", older_than_hours=1, now=__import__("time").time() + 7200) == [lost]
    assert store._names("t", "data") == [kept] and store.read("t").count() == 1


def test_replay_is_refused_when_the_ledger_moves(spark, tmp_path, monkeypatch):
    store = LedgerStore(spark, str(tmp_path))
    ingest.create_tables(store)
    letter = ("tx_1", 5, "CAPTURED", "2026-06-10T09:00:00Z", "m", "r", "hash")
    store.open("webhooks_dlq").apply(spark.createDataFrame([letter], S.DLQ))
    event = lambda i: ingest.events(spark.createDataFrame([(bytearray(wire.encode_event(EVENT | {"transaction_id": i})),)], "value binary"))
    rows = dlq.replay_rows

    def meanwhile(*a):
        ingest.write_batch(store, ingest.Settings(now="2026-06-12 00:00:00"), stream="s")(event("tx_9"), 0)
        return rows(*a)

    monkeypatch.setattr(dlq, "replay_rows", meanwhile)
    with pytest.raises(ConflictError):
        daily.replay_dead_letters(store, "2026-06-12 00:00:00")
    monkeypatch.setattr(dlq, "replay_rows", rows)
    done = daily.replay_dead_letters(store, "2026-06-12 00:00:00", delete=True, reason="why", approved_by="who", journal_folder=str(tmp_path))
    assert done["inserted"] == 1 and {r.transaction_id for r in store.read("webhooks").collect()} == {"tx_1", "tx_9"} and store.read("webhooks_dlq").count() == 0


def test_dead_letters(spark):
    rows = [("a", 5, "CAPTURED"), ("b", -5, "refund"), ("c", -5, None), ("d", -5, "CAPTURED"), (None, 5, "X"), ("a", 6, "CAPTURED")]
    df = spark.createDataFrame([(i, a, s, "t", "m", "r") for i, a, s in rows], "transaction_id string, amount_paise long, gateway_status string, timestamp_utc string, merchant_id string, processing_run_id string")
    letters = dlq.dead_letters(df.unionByName(df))
    assert letters.count() == 6
    ledger = spark.createDataFrame([], S.LEDGER)
    assert {r.transaction_id for r in dlq.replay(ledger, letters, "2026-01-01").collect()} == {"a", "d"} and dlq.replay(ledger, letters, "2026-01-01").count() == 2
    assert dlq.replay_counts(ledger, letters).first().asDict() == {"replayable": 3, "already": 0, "stranded": 1}
    assert {r.transaction_id for r in dlq.purge(letters).collect()} == {"b", "c", None}


def test_daily(spark, tmp_path):
    head = "transaction_id,bank_ref_id,settled_amount_paise,settlement_date,instrument_type\n"
    (tmp_path / "settlement_20250611.csv").write_text(head + "".join(f"tx_{i:06d},b{i},100000,2025-06-11,UPI\n" for i in range(20)))
    o = daily.Options(as_of="2025-06-12")
    got = daily.validate_file(spark, str(tmp_path / "settlement_20250611.csv"), str(tmp_path), "2025-06-11", o, registry=control.FileRegistry(tmp_path / "files.json"))
    assert got == {"rows": 20, "quarantined": 0, "usual_volume": True} and len(control.FileRegistry(tmp_path / "files.json").load()) == 1
    store = LedgerStore(spark, str(tmp_path / "store"))
    ingest.create_tables(store)
    hooks = spark.createDataFrame([tuple({"transaction_id": f"tx_{i:06d}", "amount_paise": 100000, "timestamp_utc": "2025-06-10T00:00:00Z", "reconciliation_status": S.PENDING, "currency": "INR"}.get(f.name) for f in S.LEDGER.fields) for i in range(20)], S.LEDGER)
    store.open("webhooks").replace(hooks)
    c = daily.run_daily(spark, store, str(tmp_path), "2025-06-11", o, metrics=str(tmp_path / "metrics.json"))
    assert c["match_rate"] == 1.0 and store.read("fact_reconciliation").where("status = 'MATCHED'").count() == 20
    assert json.loads((tmp_path / "metrics.json").read_text())["counts"]["evaluated"] == 20
    # a failed gate leaves main as it was
    (tmp_path / "settlement_20250612.csv").write_text(head + "".join(f"tx_{i:06d},c{i},5,2025-06-12,UPI\n" for i in range(20)))
    daily.validate_file(spark, str(tmp_path / "settlement_20250612.csv"), str(tmp_path), "2025-06-12", o)
    store.open("webhooks").replace(hooks)
    before = store.head("webhooks")
    with pytest.raises(daily.reconcile.GateError):
        daily.run_daily(spark, store, str(tmp_path), "2025-06-12", o)
    assert store.head("webhooks") == before and store.branches("webhooks") == ["main"]
    (tmp_path / "settlement_20250613.csv").write_text(head + "tx_000001,b,-1,2025-06-13,UPI\n")
    with pytest.raises(daily.validate.ValidationError):
        daily.validate_file(spark, str(tmp_path / "settlement_20250613.csv"), str(tmp_path), "2025-06-13", o)


def test_streams_and_crashes_lose_nothing(spark, tmp_path, monkeypatch):
    """A second stream, a renewed checkpoint and a crash after each write: every event is applied once."""
    frame = lambda i: (bytearray(wire.encode_event(EVENT | {"transaction_id": f"tx_{i}"})),)
    batch = lambda i: ingest.events(spark.createDataFrame([frame(i), (bytearray(b"xx"),)], "value binary"))
    settings = ingest.Settings(now="2025-06-10 12:00:00")
    rows = lambda store: sorted((r.transaction_id, r.duplicate_mutation_count) for r in store.read("webhooks").collect())
    store = LedgerStore(spark, str(tmp_path / "a"))
    ingest.write_batch(store, settings, stream="one")(batch(1), 0)
    ingest.write_batch(store, settings, stream="two")(batch(2), 0)
    ingest.write_batch(store, settings, stream="one")(batch(3), 1)
    ingest.write_batch(store, settings, stream="one")(batch(3), 1)
    assert rows(store) == [("tx_1", 0), ("tx_2", 0), ("tx_3", 0)] and store.note("webhooks") == {"one": 1, "two": 0} and store.read("webhooks_dlq").count() == 1
    a, b = ingest.stream_name(spark, str(tmp_path / "c1")), ingest.stream_name(spark, str(tmp_path / "c2"))
    assert a != b and a == ingest.stream_name(spark, str(tmp_path / "c1"))
    whole, calls = LedgerStore._write, []
    for crash in (1, 2, 4, 5, 6):  # after pointer writes: schema, first snapshot, both tables made, dead letters, ledger

        def write(self, value, *parts, **how):
            whole(self, value, *parts, **how)
            calls.append(parts)
            if len(calls) == crash:
                raise OSError("lost")

        store = LedgerStore(spark, str(tmp_path / f"crash{crash}"))
        calls.clear()
        monkeypatch.setattr(LedgerStore, "_write", write)
        try:
            ingest.write_batch(store, settings, stream="one")(batch(1), 0)
        except OSError:
            pass
        monkeypatch.setattr(LedgerStore, "_write", whole)
        ingest.write_batch(store, settings, stream="one")(batch(1), 0)
        assert rows(store) == [("tx_1", 0)] and store.read("webhooks_dlq").count() == 1
    # a writer that comes second writes nothing
    names = store._versions("webhooks", "branches", "main.json")
    with pytest.raises(BranchError):
        store._write({"snapshot": "x"}, "webhooks", "branches", "main.json", after=names[0] if len(names) > 1 else None)
    assert rows(store) == [("tx_1", 0)]


def test_signing():
    v, secret = control.Verdict, "s"
    head = control.sign(secret, 1000, b"body")
    recent = control.RecentIds()
    check = lambda **k: control.verify(**({"secret": secret, "header": head, "body": "body", "delivery": "d", "now": 1000} | k))
    assert check() is v.VALID and check(secret=None) is v.NOT_CONFIGURED and check(header="") is v.MISSING_HEADER and check(delivery=None) is v.MISSING_DELIVERY_ID
    assert check(header="nonsense") is v.MALFORMED_HEADER and check(header="t=1000,v2=00") is v.UNKNOWN_VERSION and check(header="t=1000,v1=zz") is v.MALFORMED_HEADER
    assert {check(header=h) for h in ("t=1000", "t=x,v1=00", "v1=00", "t=1000,,v1=00", "t=1000,v1", "=,", b"\xff\xfe")} == {v.MALFORMED_HEADER} and len(v) == 9
    assert check(header=head.encode()) is v.VALID and check(header=f" {head} , v0=zz") is v.VALID and check(now=1300) is v.VALID
    assert check(now=1301) is v.EXPIRED and check(body="other") is v.BAD_SIGNATURE
    assert check(recent=recent) is v.VALID and check(recent=recent) is v.REPLAYED
    small = control.RecentIds(most=2, seconds=10)
    for i in range(3):
        small.add(str(i), now=i)
    assert not small.seen("0", now=2) and small.seen("2", now=2) and not small.seen("2", now=13)


def test_journal(tmp_path):
    with pytest.raises(ValueError):
        control.journal(tmp_path, "x", " ", "me")
    control.journal(tmp_path, "x", "why", "who")
    assert json.loads((tmp_path / "corrections.jsonl").read_text())["reason"] == "why"
    (tmp_path / "files.json").write_text("broken")
    assert control.FileRegistry(tmp_path / "files.json").load() == {}


def test_a_cluster_must_name_a_shared_folder():
    from types import SimpleNamespace

    from tallyforge.plans import registry

    on = lambda master, folder: SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=SimpleNamespace(get=lambda key, other=None: folder))
    assert registry._shared(on("spark://host:7077", "/shared/")).startswith("/shared/")
    assert registry._shared(on("local[2]", None))
    try:
        registry._shared(on("spark://host:7077", None))
    except RuntimeError:
        return
    raise AssertionError("a cluster without a shared folder was accepted")
