"""Incremental ingest (U1) and incremental latest-per-key silver."""

import os
import shutil

from pyspark.sql import functions as F

from tests.conftest import SAMPLES
from tests.exportfiles import INCIDENT_HEADER, headers, incident_rows, transactions_rows, write_export
from trackyard.plans import bronze, silver, tracking
from trackyard.schemas import SOURCES
from trackyard.streaming import incremental as U


def test_stream_ingest_exactly_once(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    os.makedirs(inbox)
    shutil.copy(os.path.join(SAMPLES, "ETCS-Call-tracing_2026-05-13_16-44-29.csv"), inbox)
    broot, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    U.start_export_stream(spark, inbox, broot, ckpt).awaitTermination()
    assert bronze.read_bronze(spark, broot, "exp_etcs_call").count() == 57
    # second run: nothing new
    U.start_export_stream(spark, inbox, broot, ckpt).awaitTermination()
    assert bronze.read_bronze(spark, broot, "exp_etcs_call").count() == 57
    # a new file and a renamed copy of a seen one
    shutil.copy(os.path.join(SAMPLES, "Subscriber-Matrix_2026-05-13_16-44-41.csv"), inbox)
    shutil.copy(os.path.join(SAMPLES, "ETCS-Call-tracing_2026-05-13_16-44-29.csv"),
                os.path.join(inbox, "ETCS-Call-tracing_copy.csv"))
    U.start_export_stream(spark, inbox, broot, ckpt).awaitTermination()
    assert bronze.read_bronze(spark, broot, "exp_subscriber_matrix").count() == 35
    assert bronze.read_bronze(spark, broot, "exp_etcs_call").count() == 57  # copy skipped by content hash
    statuses = sorted(r["status"] for r in tracking.read_log(spark, broot, tracking.FILE_LOG).collect())
    assert statuses == ["SKIPPED", "SUCCESS", "SUCCESS"]


def test_silver_stream_latest_wins(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    broot, sroot = str(tmp_path / "bronze"), str(tmp_path / "silver")
    write_export(inbox, "Transaction-tracing_1.csv", headers("exp_transaction_tracing"), transactions_rows())
    U.start_export_stream(spark, inbox, broot, str(tmp_path / "c1")).awaitTermination()
    U.start_silver_stream(spark, broot, sroot, "exp_transaction_tracing", str(tmp_path / "c2")).awaitTermination()
    first = U.current_table(spark, sroot, "exp_transaction_tracing")
    assert first.count() == 4
    # a late re-export changes one call: the newer ingest wins whatever its event time
    rows = transactions_rows()
    rows[0][4] = "9min"
    write_export(inbox, "Transaction-tracing_2.csv", headers("exp_transaction_tracing"), rows[:1])
    U.start_export_stream(spark, inbox, broot, str(tmp_path / "c1")).awaitTermination()
    U.start_silver_stream(spark, broot, sroot, "exp_transaction_tracing", str(tmp_path / "c2")).awaitTermination()
    merged = U.current_table(spark, sroot, "exp_transaction_tracing")
    assert merged.count() == 4
    changed = merged.filter(F.col("start_time") == F.lit("2026-05-13 10:00:00").cast("timestamp_ntz")).first()
    assert changed["transaction_duration"] == 540000
    # a batch on another day leaves the existing day's version untouched
    before = {r["_part"]: r["version"] for r in U.current_versions(spark, sroot, "exp_transaction_tracing").collect()}
    assert set(before) == {"2026-05-13"}
    other = transactions_rows()[:1]
    other[0][0] = "2026-05-20 08:00:00.000"
    write_export(inbox, "Transaction-tracing_3.csv", headers("exp_transaction_tracing"), other)
    U.start_export_stream(spark, inbox, broot, str(tmp_path / "c1")).awaitTermination()
    U.start_silver_stream(spark, broot, sroot, "exp_transaction_tracing", str(tmp_path / "c2")).awaitTermination()
    final = U.current_table(spark, sroot, "exp_transaction_tracing")
    assert final.count() == 5
    after = {r["_part"]: r["version"] for r in U.current_versions(spark, sroot, "exp_transaction_tracing").collect()}
    assert set(after) == {"2026-05-13", "2026-05-20"} and after["2026-05-13"] == before["2026-05-13"]
    rows = sorted(map(repr, final.collect()))
    U.drop_old_versions(spark, sroot, "exp_transaction_tracing")
    assert sorted(map(repr, U.current_table(spark, sroot, "exp_transaction_tracing").collect())) == rows
    data = os.path.join(sroot, "incremental", "exp_transaction_tracing", "data")
    assert len([d for d in os.listdir(data) if d.startswith("version=")]) == 2


def test_lost_before_publish_changes_nothing(spark, tmp_path, monkeypatch):
    """A job lost after its data is written, before the version is published, leaves the old state; its repetition is whole."""
    table, broot, sroot = "exp_transaction_tracing", str(tmp_path / "bronze"), str(tmp_path / "silver")
    inbox = str(tmp_path / "inbox")
    write_export(inbox, "Transaction-tracing_1.csv", headers(table), transactions_rows())
    bronze.ingest_folder(spark, inbox, broot, "b1")
    U.merge_epoch(spark, bronze.read_bronze(spark, broot, table), sroot, table, "e1")
    old = sorted(map(repr, U.current_table(spark, sroot, table).collect()))
    rows = transactions_rows()
    rows[0][4] = "9min"
    write_export(inbox, "Transaction-tracing_2.csv", headers(table), rows)
    bronze.ingest_folder(spark, inbox, broot, "b2")
    batch = bronze.read_bronze(spark, broot, table).filter("_batch_id = 'b2'")
    real = tracking.now
    calls = []

    def lost():  # the second stamp of an epoch is its publication's
        calls.append(1)
        if len(calls) == 2:
            raise OSError("driver lost")
        return real()

    monkeypatch.setattr(tracking, "now", lost)
    try:
        U.merge_epoch(spark, batch, sroot, table, "e2")
        raise AssertionError("not lost")
    except OSError:
        pass
    monkeypatch.setattr(tracking, "now", real)
    assert sorted(map(repr, U.current_table(spark, sroot, table).collect())) == old
    for _ in range(2):  # a repeated epoch comes to the same rows
        U.merge_epoch(spark, batch, sroot, table, "e2")
        merged = U.current_table(spark, sroot, table)
        assert merged.count() == 4 and merged.filter("transaction_duration = 540000").count() == 1


def test_repaired_files_load_with_the_next_trigger(spark, tmp_path):
    """Both sources; a file that failed is offered again, and loaded once it has been repaired in place."""
    exports, incidents = str(tmp_path / "exports"), str(tmp_path / "incidents")
    broot = str(tmp_path / "bronze")
    broken = transactions_rows()
    broken[1][13] = "no number"
    write_export(exports, "Transaction-tracing_1.csv", headers("exp_transaction_tracing"), broken)
    write_export(incidents, "sheet.csv", INCIDENT_HEADER + ["Surprise"], [r + ["x"] for r in incident_rows()], sep_line=False, bom=False)

    def trigger():
        U.start_export_stream(spark, exports, broot, str(tmp_path / "c1")).awaitTermination()
        U.start_incident_stream(spark, incidents, broot, str(tmp_path / "c2")).awaitTermination()
        return [bronze.read_bronze(spark, broot, t).count() for t in ("exp_transaction_tracing", "sp_ertms_disconnects")]

    assert trigger() == [0, 0] and trigger() == [0, 0]
    write_export(exports, "Transaction-tracing_1.csv", headers("exp_transaction_tracing"), transactions_rows())
    write_export(incidents, "sheet.csv", INCIDENT_HEADER, incident_rows(), sep_line=False, bom=False)
    assert trigger() == [5, 4] and trigger() == [5, 4]


def test_stream_special_names(spark, tmp_path):
    inbox = str(tmp_path / "in box")
    write_export(inbox, "Transaction-tracing [1] #a.csv", headers("exp_transaction_tracing"), transactions_rows())
    broot = str(tmp_path / "bronze")
    U.start_export_stream(spark, inbox, broot, str(tmp_path / "ckpt")).awaitTermination()
    assert bronze.read_bronze(spark, broot, "exp_transaction_tracing").count() == 5


def test_gold_follows_changed_subscribers(spark, tmp_path):
    """Three incremental runs over all sources equal a full rebuild of the same files; untouched ranges keep their files."""
    from trackyard.plans import gold_incremental as GI
    from trackyard.plans import orchestrate

    inbox, sheets = str(tmp_path / "in"), str(tmp_path / "sheets")
    os.makedirs(inbox)
    rows = transactions_rows()
    far = [list(rows[0])]
    far[0][13] = "999000000000001"  # a subscriber of another range

    def exports(step):
        if step == 0:
            for f in os.listdir(SAMPLES):
                shutil.copy(os.path.join(SAMPLES, f), inbox)
            write_export(inbox, "Transaction-tracing_0.csv", headers("exp_transaction_tracing"), far)
            write_export(sheets, "sheet.csv", INCIDENT_HEADER, incident_rows(), sep_line=False, bom=False)
        elif step == 1:
            write_export(inbox, "Transaction-tracing_1.csv", headers("exp_transaction_tracing"), rows)
        else:  # a call again, now of another subscriber's number; and a subscriber below all others
            changed = [list(rows[0]), list(rows[4])]
            changed[0][14], changed[1][13] = "00212700000001", "604070000000007"
            write_export(inbox, "Transaction-tracing_2.csv", headers("exp_transaction_tracing"), changed)

    wh = str(tmp_path / "wh")
    versions = []
    for step in range(3):
        exports(step)
        gold = orchestrate.run_incremental(spark, wh, inbox, sheets)
        current, _ = GI._current(spark, wh + "/gold")
        versions.append({r["range"]: r["version"] for r in GI._ranges(spark, wh + "/gold", current).collect()})
    far_range = 999000000000001 // GI.SPAN
    assert versions[0][far_range] == versions[2][far_range] and len(set(versions[2].values())) > 1
    full = str(tmp_path / "full")
    orchestrate.run_all(spark, full, inbox, sheets)
    whole = orchestrate.read_gold(spark, full + "/gold", register=False)
    for name in gold:
        a, b = (sorted(map(repr, x[name].collect())) for x in (gold, whole))
        assert a == b, name
    assert GI.refresh_dim(spark, wh + "/silver", wh + "/gold") == 0


def test_many_ranges_share_few_files(spark, tmp_path, monkeypatch):
    """A range a subscriber: files and folders follow the rows; versions that are mostly replaced are written anew."""
    from trackyard.plans import gold_incremental as GI
    from trackyard.schemas import SOURCES

    table, sroot, groot = "exp_ho_tracing", str(tmp_path / "silver"), str(tmp_path / "gold")
    schema = SOURCES[table].bronze_schema

    def epoch(n, first, last, imei):
        given = {"imsi": "id * 3", "imei": str(imei), "ho_start_time": "timestamp_ntz'2024-01-01'", "src_lac": "1", "src_ci": "1",
                 "_ingested_at": f"timestamp_ntz'2024-01-0{n}'", "_file_hash": f"'{n}'", "_row_num": "1"}
        batch = spark.range(first, last).selectExpr(*[
            f"cast({given.get(f.name, 'null')} as {f.dataType.simpleString()}) as {f.name}" for f in schema.fields])
        U.merge_epoch(spark, batch, sroot, table, f"e{n}")
        GI.refresh_dim(spark, sroot, groot, span=1)
        return [(r["subscriber_key"], r["imsi"], r["imei"]) for r in GI.read_dim(spark, groot).orderBy("imsi").collect()]

    monkeypatch.setattr(GI, "BLOCK", 7)
    assert epoch(1, 10, 110, 5) == [(i + 1, 3 * (10 + i), 5) for i in range(100)]
    folders = [f for f, _, files in os.walk(groot) if any(x.endswith(".parquet") for x in files)]
    held = sum(x.endswith(".parquet") for _, _, files in os.walk(groot) for x in files)
    assert len(folders) < 10 and held < 20
    assert epoch(2, 0, 40, 6) == [(i + 1, 3 * i, 6 if i < 40 else 5) for i in range(110)]
    current = lambda: {r["version"] for r in GI._ranges(spark, groot, GI._current(spark, groot)[0]).collect()}
    assert len(current()) == 2
    monkeypatch.setattr(GI, "FEW", 0)
    assert epoch(3, 30, 90, 7) == [(i + 1, 3 * i, 6 if i < 30 else 7 if i < 90 else 5) for i in range(110)]
    assert len(current()) == 2  # the first epoch's version, with 20 of 100 rows current, is gone


def test_merge_moves_a_batch_once(spark, tmp_path):
    """Unparsed rows are deduplicated together with the current ones; with imsi in the key these aren't read for what has changed."""
    table, at = "exp_ho_tracing", tracking.now()
    rows = spark.range(6).select(*[
        {"imsi": F.col("id") % 3, "_row_num": F.col("id"), "src_lac": F.lit(1)}.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in SOURCES[table].bronze_schema.fields])
    current = silver.build_silver_table(rows.filter("_row_num < 3"), table, at)
    current = spark.createDataFrame(current.collect(), current.schema)
    merged = U.merge_batch(current, rows.filter("_row_num > 0"), table, at)
    assert sorted((r["imsi"], r["_row_num"]) for r in merged.collect()) == [(0, 3), (1, 4), (2, 5)]
    assert merged._jdf.queryExecution().sparkPlan().toString().count("Window [") == 1
    unread = rows.withColumn("imsi", F.raise_error(F.lit("read")).cast("bigint"))
    U._record_changes(unread, rows.filter("imsi > 0"), table, str(tmp_path / "changes"))
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "changes")).collect()) == [1, 2]
