"""Windows with state, columnar Avro, the schema registry, MT940 at size, mart versions, gates and command lines."""

import json
import random
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyforge import control
from tallyforge import schemas as S
from tallyforge.operators import migrations, reconcile
from tallyforge.operators.ledger_store import LedgerStore
from tallyforge.plans import cli, daily
from tallyforge.sources import mt940, wire
from tallyforge.streaming import ingest, windows

EVENT = {"transaction_id": "tx_1", "amount_paise": 100, "gateway_status": "CAPTURED", "timestamp_utc": "2026-06-10T09:00:00Z", "merchant_id": "m", "processing_run_id": None, "currency": "INR"}
T0 = datetime(2024, 3, 1)
at = lambda minutes: T0 + timedelta(minutes=minutes)
ROWS = "ts timestamp, who string"


def test_tumbling_windows_drop_and_count_late_rows(spark, tmp_path):
    lots = [[(at(5), "a"), (at(70), "a"), (at(200), "b"), (None, "a")], [(at(10), "a"), (at(150), "b"), (at(199), "b"), (at(400), None)], [(at(399), None), (at(100), "a")]]
    frames = [spark.createDataFrame(x, ROWS) for x in lots]
    shape = lambda df: windows.tumbling(df, "ts", "1 hour", "30 minutes", ["who"], [F.count(F.lit(1)).alias("n")])
    run = windows.over_deliveries(frames, shape, str(tmp_path), "ts")
    want, seen = {}, None
    for lot in lots:  # the rule in plain Python
        for ts, who in lot:
            if ts:
                start = ts.replace(minute=0)
                if seen is None or start + timedelta(hours=1) > seen - timedelta(minutes=30):
                    want[start, who] = want.get((start, who), 0) + 1
        seen = max([seen or T0, *(ts for ts, _ in lot if ts)])
    assert {(r.start, r.who): r.n for r in run.windows.collect()} == want
    assert (run.given, run.untimed, run.late) == (10, 1, 9 - sum(want.values())) and run.late == 2


def test_sessions_go_on_across_deliveries(spark, tmp_path):
    lots = [[(at(0), "a"), (at(20), "a"), (at(100), "b")], [(at(110), "b"), (at(125), "b"), (at(300), "a")]]
    shape = lambda df: windows.sessions(df, "ts", "30 minutes", "1 hour", ["who"], [F.count(F.lit(1)).alias("n")])
    run = windows.over_deliveries([spark.createDataFrame(x, ROWS) for x in lots], shape, str(tmp_path), "ts")
    assert {(r.who, r.start, r.end, r.n) for r in run.windows.collect()} == {("a", at(0), at(50), 2), ("b", at(100), at(155), 3), ("a", at(300), at(330), 1)} and run.late == 0


def test_no_deliveries_with_a_time(spark, tmp_path):
    shape = lambda df: windows.tumbling(df, "ts", "1 hour", "1 hour", ["who"], [F.count(F.lit(1)).alias("n")])
    run = windows.over_deliveries([spark.createDataFrame([], ROWS), spark.createDataFrame([(None, "a")], ROWS)], shape, str(tmp_path), "ts")
    assert (run.given, run.untimed, run.late, run.windows.count()) == (1, 1, 0, 0)


def test_append_dedup_and_progress(spark, tmp_path, caplog):
    frames = [bytearray(wire.encode_event(EVENT)), bytearray(wire.encode_event(EVENT | {"amount_paise": 7})), bytearray(wire.encode_event(EVENT | {"transaction_id": "tx_2"})), bytearray(b"xx")]
    spark.createDataFrame([(f,) for f in frames], "value binary").coalesce(1).write.parquet(str(tmp_path / "in"))
    ingest.append_stream(wire.files(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "c1"), {"availableNow": True}).awaitTermination()
    assert sorted(r.transaction_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["tx_1", "tx_1", "tx_2"]
    listener = ingest.Progress()
    spark.streams.addListener(listener)
    try:
        with caplog.at_level("INFO", logger=ingest.__name__):
            once = ingest.dedup_within_watermark(ingest.events(wire.files(spark, str(tmp_path / "in"))).where("decodable"))
            q = once.writeStream.format("parquet").option("path", str(tmp_path / "once")).option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
            q.awaitTermination()
            for _ in range(50):
                if "ended" in caplog.text:
                    break
                __import__("time").sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert sorted(r.transaction_id for r in spark.read.parquet(str(tmp_path / "once")).collect()) == ["tx_1", "tx_2"]
    assert "started" in caplog.text and "4 rows" in caplog.text and "ended" in caplog.text


def test_columnar_avro_equals_record_by_record(spark):
    r = random.Random(3)
    word = lambda: None if r.random() < 0.2 else "".join(r.choice("aé日🙂 x") for _ in range(r.choice([0, 1, 5, 200])))
    good = [wire.encode_event({f.name: r.choice([0, 1, -1, 63, 64, -(2**63), 2**63 - 1, r.randrange(-(2**62), 2**62)]) if f.name == "amount_paise" else word() if i >= 5 else word() or "" for i, f in enumerate(S.EVENT.fields)})[5:] for _ in range(400)]
    bad = []
    for p in good:
        p = bytearray(p)
        for _ in range(r.randrange(1, 4)):
            k = r.randrange(4)
            if k == 0:
                p = p[: r.randrange(len(p) + 1)]
            elif k == 1 and p:
                p[r.randrange(len(p))] = r.randrange(256)
            elif k == 2:
                p += bytes(r.randrange(256) for _ in range(3))
            else:
                p = bytearray(r.randrange(256) for _ in range(r.randrange(30))) + p
        bad.append(bytes(p))
    every = [None, b"", b"\x80" * 12, b"\xff" * 9 + b"\x01", *good, *bad]
    for rows in (every, every[3:9], [None], []):
        got = list(zip(*[c.to_pylist() for c in wire.decode_columns(pa.array(rows, pa.binary()))])) if rows else []
        assert got == [wire.decode_event(p) or (None,) * len(S.EVENT.fields) for p in rows]
    sliced = pa.array(every, pa.binary()).slice(5, 50)
    assert list(zip(*[c.to_pylist() for c in wire.decode_columns(sliced)])) == [wire.decode_event(p) or (None,) * len(S.EVENT.fields) for p in every[5:55]]
    assert all(len(c) == 0 for c in wire.decode_columns(pa.array([], pa.binary())))
    assert wire.has_from_avro(spark) in (True, False)


def test_builtin_avro_equals_columnar(spark):
    if not wire.has_from_avro(spark):
        pytest.skip("Spark's Avro module is not loaded here")
    df = spark.createDataFrame([(bytearray(wire.encode_event(EVENT)),), (bytearray(b"\0\0\0\0\1xx"),), (None,)], "value binary")
    assert wire.decode(df, builtin=True).collect() == wire.decode(df, builtin=False).collect()


def test_schema_registry(caplog):
    asked, clock, answer = [], [0.0], ['{"id": 7, "version": 2}']

    def fetch(url):
        asked.append(url)
        if answer[0] is None:
            raise OSError("away")
        return answer[0]

    reg = wire.SchemaRegistry("http://registry:8081/", fetch=fetch, seconds=10, clock=lambda: clock[0])
    assert reg.latest_id("gateway/events") == "7" and reg.latest_id("gateway/events") == "7" and asked == ["http://registry:8081/subjects/gateway%2Fevents-value/versions/latest"]
    clock[0], answer[0] = 11, None
    assert reg.latest_id("gateway/events") == "7" and "last id holds" in caplog.text  # away: the last answer
    assert reg.latest_id("other") is None and "not checked" in caplog.text  # fail-open
    with pytest.raises(wire.RegistryError):
        wire.SchemaRegistry("http://r", required=True, fetch=fetch).latest_id("t")
    answer[0] = '{"no": 1}'
    with pytest.raises(wire.RegistryError):
        wire.SchemaRegistry("http://r", required=True, fetch=fetch).latest_id("t")
    with pytest.raises(wire.RegistryError):
        wire.SchemaRegistry("file:///etc", required=True).latest_id("t")


def test_kafka_options():
    plain = wire.kafka_options("a:1", "t")
    assert plain["subscribe"] == "t" and plain["maxOffsetsPerTrigger"] == "200000" and "kafka.security.protocol" not in plain
    safe = wire.kafka_options("a:1", "t", sasl={"username": "u", "password": "p"}, require_sasl=True)
    assert safe["kafka.security.protocol"] == "SASL_SSL" and 'username="u" password="p"' in safe["kafka.sasl.jaas.config"]
    with pytest.raises(ValueError):
        wire.kafka_options("a:1", "t", require_sasl=True)


def test_large_statement_file_is_read_by_many_tasks(spark, tmp_path):
    n = 30_000
    s = spark.range(n).selectExpr("concat('tx_', lpad(id, 12, '0')) AS transaction_id", "id + 1 AS settled_amount_paise", "'2025-06-11' AS settlement_date", "concat('br_', id) AS bank_ref_id")
    mt940.write(s, str(tmp_path / "one"))
    files = [p for p in (tmp_path / "one").iterdir() if p.name.startswith("part-")]
    assert len(files) == 1 and files[0].read_text().startswith(":20:STATEMENT\n:25:TALLYFORGE\n:28C:1/1\n:60F:C000101INR0,00\n:61:")
    assert files[0].read_text().rstrip("\n").endswith(f":62F:C000101INR{n * (n + 1) // 2 // 100},{n * (n + 1) // 2 % 100:02d}")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        rows = mt940.read(spark, str(tmp_path / "one"))
        assert rows.rdd.getNumPartitions() > 5
        assert rows.agg(F.count(F.lit(1)), F.sum("amount_paise"), F.count_distinct("link_tx")).first()[:] == (n, n * (n + 1) // 2, n)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    mt940.write(s, str(tmp_path / "many"), files=4)
    parts = [p.read_text().split("\n") for p in (tmp_path / "many").iterdir() if p.name.startswith("part-")]
    assert len(parts) == 4 and sum(sum(x.startswith(":61:") for x in p) for p in parts) == n
    assert all(p == p[:4] + [x for pair in sorted(zip(p[4:-2:2], p[5:-2:2]), key=lambda q: q[1]) for x in pair] + p[-2:] for p in parts)  # each file in order
    assert mt940.read(spark, str(tmp_path / "many")).count() == n


def test_statement_files_that_are_refused(spark, tmp_path):
    good = ":20:X\r\n:61:160402C1,00NTRFA\r\n:86:one\r\n:61:160402D2,00NTRFB\r\n:62F:C1\r\n-}"
    (tmp_path / "a.sta").write_text(good)
    (tmp_path / "b.sta").write_text("{1:F01}{4:\n:20:X\n:61:160403C3,00NTRFC\n:86:two\nlines\n-}")
    assert sorted((r.amount_paise, r.narration) for r in mt940.read(spark, str(tmp_path)).collect()) == [(-200, ""), (100, "one"), (300, "two lines")]
    for bad in ("", ":20:X\n:62F:C1\n", good + "\n:61:junk\n"):
        (tmp_path / "c.sta").write_text(bad)
        with pytest.raises(mt940.StatementError):
            mt940.read(spark, str(tmp_path))


def test_mart_versions(spark, tmp_path):
    folder, store = tmp_path / "sql", LedgerStore(spark, str(tmp_path / "store"))
    folder.mkdir()
    ledger = spark.createDataFrame([("a", 5), ("b", None)], "transaction_id string, amount_paise long")
    assert [m.version for m in migrations.load(folder)] == [0] and migrations.load(folder)[0].name == "inline"
    for n, col in ((10, "ten"), (2, "two"), (1, "one")):
        (folder / f"V{n}__{col}.sql").write_text(f"SELECT transaction_id, '{col}' AS {col} FROM __SOURCE_TABLE__")
    steps = migrations.load(folder)
    assert [m.version for m in steps] == [1, 2, 10]  # by number
    assert migrations.migrate(store, ledger, steps[:2], "m") == [1, 2]
    broken = migrations.Migration(10, "ten", lambda df: 1 / 0, steps[2].digest)
    with pytest.raises(ZeroDivisionError):
        migrations.migrate(store, ledger, [*steps[:2], broken], "m")
    assert sorted(migrations.applied(store, "m")) == [1, 2] and store.read("m").first()["two"] == "two"
    assert migrations.migrate(store, ledger, steps, "m") == [10]  # goes on where it stopped
    assert store.read("m").columns == ["transaction_id", "one", "two", "ten"] and store.read("m").first()["ten"] == "ten"
    assert migrations.refresh(store, ledger.where("transaction_id = 'a'"), steps, "m") == "V10" and store.read("m").count() == 1
    (folder / "V2__two.sql").write_text("SELECT 1 AS x FROM __SOURCE_TABLE__")
    with pytest.raises(migrations.MigrationError):
        migrations.migrate(store, ledger, migrations.load(folder), "m")
    (folder / "V3__late.sql").write_text("SELECT 1 AS x FROM __SOURCE_TABLE__")
    with pytest.raises(migrations.MigrationError):
        migrations.migrate(store, ledger, [m for m in migrations.load(folder) if m.version != 2] + steps[1:2], "m")
    (folder / "V3__twin.sql").write_text("SELECT 2 AS x FROM __SOURCE_TABLE__")
    with pytest.raises(migrations.MigrationError):
        migrations.load(folder)
    assert migrations.refresh(store, ledger, [broken, *steps[:2]], "other", strict=False) is None  # logged only


def test_drift_of_empty_and_uncounted_batches(caplog):
    assert reconcile.check_drift({S.MATCHED: 0}, 0) is False and "nothing was evaluated" in caplog.text
    assert reconcile.check_drift({S.MATCHED: 0}, 0, 9805) is False  # a real zero stays zero
    assert reconcile.check_drift({S.MATCHED: 1, S.MISSING_WEBHOOK: 1}, None, 2) is True
    assert reconcile.check_drift({S.MATCHED: 3}, None, None) is False
    with pytest.raises(reconcile.GateError):
        reconcile.check_drift({S.MATCHED: 6, S.MISSING_WEBHOOK: 3}, 10, 10)


def test_ranks_by_refinement(spark):
    r = random.Random(5)
    for values in ([0], [7] * 9, [r.randrange(2**40) for _ in range(300)], [r.choice([1, 1023, 1024, 2**20, 2**62]) for _ in range(100)]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "difference long")
        s, n = sorted(values), len(values)
        assert reconcile.mismatch_spread(df).first()[:] == (s[n // 2], s[max(n * 9 // 10, 1) - 1], s[-1])
    assert reconcile.mismatch_spread(spark.createDataFrame([], "difference long")).first()[:] == (0, 0, 0)


def test_counters_look_at_the_ledger_once(spark, sf):
    from tallyforge.plans import registry

    for query, merges in ((registry.status_counts, 1), (registry.match_rate, 1)):
        plan = query(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join FullOuter") == merges


def test_signing_is_linear_and_ascii():
    import time

    for header in ("t=1,v1=" + " " * 64_000, " " * 64_000, "=" * 64_000, "," * 64_000, "t=" + "9" * 64_000 + ",v1=00", "t=1," + "a " * 32_000):
        began = time.perf_counter()
        assert control.verify("s", header, "b", "d", now=1) is not control.Verdict.VALID
        assert time.perf_counter() - began < 0.1
    good = control.sign("s", 1, "b")
    assert control.verify("s", b"v2=\xff," + good.encode(), "b", "d", now=1) is control.Verdict.MALFORMED_HEADER
    assert control.verify("s", "v2=é," + good, "b", "d", now=1) is control.Verdict.MALFORMED_HEADER
    assert control.verify("s", "t=1,v1=", "b", "d", now=1) is control.Verdict.BAD_SIGNATURE and control.verify("s", good, "b", "d", now=1) is control.Verdict.VALID


def test_lenient_run_and_command_lines(spark, tmp_path, monkeypatch, caplog):
    rows = "".join(f"tx_{i:06d},b{i},100000,2025-06-11,UPI\n" for i in range(10))
    (tmp_path / "settlement_20250611.csv").write_text("transaction_id,bank_ref_id,settled_amount_paise,settlement_date,instrument_type\n" + rows)
    store = str(tmp_path / "store")
    run = lambda *argv: cli.run(spark, ["--store", store, *argv], now="2025-06-12 00:00:00")
    assert run("validate", str(tmp_path / "settlement_20250611.csv"), "--out", str(tmp_path))["rows"] == 10
    ingest.create_tables(LedgerStore(spark, store))
    hook = {"transaction_id": "tx_000000", "amount_paise": 5, "timestamp_utc": "2025-06-10T00:00:00Z", "reconciliation_status": S.PENDING}
    LedgerStore(spark, store).open("webhooks").apply(spark.createDataFrame([tuple(hook.get(f.name) for f in S.LEDGER.fields)], S.LEDGER))
    with pytest.raises(reconcile.GateError):
        run("daily", str(tmp_path), "--date", "2025-06-11", "--metrics", str(tmp_path / "m.json"))  # the one known payment differs: the rate is missed
    assert LedgerStore(spark, store).read("webhooks").count() == 1
    monkeypatch.setattr(daily.residual, "scored", lambda *a: 1 / 0)
    monkeypatch.setattr(daily.migrations, "migrate", lambda *a: 1 / 0)
    out = run("daily", str(tmp_path), "--lenient", "--metrics", str(tmp_path / "m.json"))
    assert out["batch"] == {S.MISSING_WEBHOOK: 9, S.FEE_MISMATCH: 1} and out["mart_version"] is None and "residual leg failed" in caplog.text and "was not refreshed" in caplog.text
    assert json.loads((tmp_path / "m.json").read_text())["batch_date"] == "2025-06-11" and LedgerStore(spark, store).read("webhooks").count() == 10
    assert run("replay") == {"replayable": 0, "inserted": 0, "reversal_stranded": 0}
    assert run("maintain", "webhooks=1", "nothing")["nothing"].startswith("failed")
    monkeypatch.undo()
    with pytest.raises(SystemExit):
        cli.run(spark, ["--store", store])
