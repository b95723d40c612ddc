"""Bronze -> silver -> gold on invented exports of all sources."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tests.conftest import SAMPLES
from tests.exportfiles import (INCIDENT_HEADER, SUBSCRIBERS, duration_sum, etcs_cells, group_call_cells, frame_error_rows, handover_rows, headers, incident_rows,
                               transactions_rows, write_export)
from trackyard.plans import bronze, gold, orchestrate, silver, tracking


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("wh"))
    exports = os.path.join(root, "exports")
    os.makedirs(exports)
    for f in os.listdir(SAMPLES):
        shutil.copy(os.path.join(SAMPLES, f), exports)
    write_export(exports, "Transaction-tracing_2026-05-13.csv", headers("exp_transaction_tracing"),
                 transactions_rows())
    write_export(exports, "HO-tracing_2026-05-13.csv", headers("exp_ho_tracing"), handover_rows())
    write_export(exports, "HDLC-Frame-Error-tracing_2026-05-13.csv", headers("exp_hdlc_frame_errors"),
                 frame_error_rows())
    incidents = os.path.join(root, "incidents")
    write_export(incidents, "ertms_disconnects.csv", INCIDENT_HEADER, incident_rows(), sep_line=False, bom=False)
    report = orchestrate.run_all(spark, os.path.join(root, "wh"), exports, incidents)
    gold_tables = orchestrate.read_gold(spark, os.path.join(root, "wh", "gold"))
    s = silver.read_silver(spark, os.path.join(root, "wh", "silver"))
    return {"root": root, "report": report, "silver": s, "gold": gold_tables, "exports": exports,
            "incidents": incidents, "wh": os.path.join(root, "wh")}


def test_bronze_run(warehouse):
    r = warehouse["report"]
    assert r.bronze_status == "SUCCESS", r
    assert r.bronze_stats.files_total == 7 and r.bronze_stats.files_success == 7
    assert r.bronze_stats.rows_loaded == 57 + 35 + 27 + 5 + 3 + 2 + 4


def test_bronze_lineage(spark, warehouse):
    b = bronze.read_bronze(spark, warehouse["wh"] + "/bronze", "exp_etcs_call")
    assert b.count() == 57
    nums = sorted(r[0] for r in b.select("_row_num").collect())
    assert nums == list(range(1, 58))
    assert b.select("_file_hash").distinct().count() == 1
    row = b.filter(F.col("_row_num") == 1).first()
    assert row["imsi"] == 604070051706194 and row["calling_number"] == 212799997194  # leading zeros dropped
    assert row["call_setup_duration"] == "3s 591ms" and str(row["system_version"]) == "1.0"


def test_silver_golden_values(warehouse):
    s = warehouse["silver"]
    counts = warehouse["report"].silver_counts
    assert (counts["exp_etcs_call"], counts["exp_subscriber_matrix"], counts["exp_vgcs_vbs_rec_tracing"]) == (57, 35, 27)
    e = s["exp_etcs_call"].agg(F.count_if(F.col("stop_time").isNull()), F.sum("call_setup_duration"),
                               F.sum("transaction_duration")).first()
    calls = etcs_cells()
    assert tuple(e) == (2, duration_sum(calls, "call_setup_duration"), duration_sum(calls, "transaction_duration"))
    v = s["exp_vgcs_vbs_rec_tracing"].agg(
        F.count_if(F.col("establishment_delay").isNull()), F.sum("establishment_delay"), F.sum("vgcs_duration"),
        *[f(F.col(c)) for c in ("sccp", "cell", "dispatcher")
          for f in (lambda c, c0=c: F.sum(f"{c0}_success_numerator"),
                    lambda c, c0=c: F.sum(f"{c0}_success_denominator"),
                    lambda c, c0=c: F.count_if(F.col(f"{c0}_success_rate").isNull()))]).first()
    groups = group_call_cells()
    ratio = lambda c, k: [int(x) for x in g[k].split(" / ")] if (g := c)[k] else None
    want = [sum(not g["establishment_delay"] for g in groups), duration_sum(groups, "establishment_delay"),
            duration_sum(groups, "vgcs_duration")]
    for name in ("sccp", "cell", "dispatcher"):
        parts = [p for g in groups if (p := ratio(g, f"{name}_success_rate"))]
        # no rate without a text, nor with a denominator of 0
        want += [sum(n for n, _ in parts), sum(m for _, m in parts), len(groups) - sum(m > 0 for _, m in parts)]
    assert list(v) == want


def test_silver_synthetic_sources(warehouse):
    s = warehouse["silver"]
    t = s["exp_transaction_tracing"]
    assert t.count() == 4  # two NULL-imsi rows with the same start_time collapse
    assert t.filter(F.col("stop_time").isNull()).count() == 1
    assert t.agg(F.sum("transaction_duration")).first()[0] == 4 * 62003
    fn = t.select("functional_number").distinct().collect()
    assert [r[0] for r in fn] == ["20108101"]
    ho = s["exp_ho_tracing"]
    assert ho.count() == 2
    assert ho.filter(F.col("trg_lac") == 102).count() == 1  # later row of the same key
    inc = s["sp_ertms_disconnects"]
    assert inc.count() == 3
    got = {r["nombre_ordre"]: (r["mrm"], r["km"]) for r in inc.collect()}
    assert got[2][0] == 7 and got[2][1] is None  # " 7 " -> 7, "PK 3" -> NULL
    assert got[3] == (None, __import__("decimal").Decimal("101.250"))
    assert got[4] == (None, None)
    r4 = inc.filter(F.col("nombre_ordre") == 4).first()
    assert (str(r4["date"]), r4["heure"], r4["derniere_7_jours"]) == ("2026-05-14", "09:30:00", True)
    assert inc.filter(F.col("nombre_ordre") == 3).first()["derniere_7_jours"] is False


def test_gold(warehouse):
    g = warehouse["gold"]
    dim = g["dim_subscriber"]
    keys = [r[0] for r in dim.orderBy("imsi").select("subscriber_key").collect()]
    assert keys == list(range(1, len(keys) + 1))
    assert dim.select("imsi").distinct().count() == dim.count() == SUBSCRIBERS + 2  # two more in the other sources
    fg = g["fact_group_call"]
    assert fg.count() == 27 and fg.filter(F.col("subscriber_key").isNull()).count() == 10
    assert len(g["fact_etcs_call"].columns) == 23 and g["fact_etcs_call"].count() == 57
    assert len(g["fact_transaction"].columns) == 27
    ho = g["fact_handover"]
    assert sorted(r[0] for r in ho.select("handover_duration_ms").collect()) == [40, 2500]
    fe = g["fact_frame_error"]
    assert len(fe.columns) == 14 and fe.count() >= 2
    assert fe.filter(F.col("subscriber_key").isNotNull()).count() >= 1
    inc = g["fact_ertms_disconnect"]
    # imei 35214500047160 belongs to two subscribers: the left join fans out, as the SQL join does
    assert len(inc.columns) == 35 and inc.count() == 4
    for name, df in g.items():
        assert df.count() >= warehouse["silver"][gold.FACTS[name][0]].count() if name in gold.FACTS else True


def test_views_registered(spark, warehouse):
    n = spark.sql("SELECT count(*) FROM fact_etcs_call f JOIN dim_subscriber d USING (subscriber_key)").first()[0]
    assert n == 57


def test_rerun_skips_and_log(spark, warehouse):
    wh = warehouse["wh"]
    bid, status, st = bronze.run_ingestion(spark, warehouse["exports"], warehouse["incidents"], wh + "/bronze")
    assert status == "SUCCESS" and st.files_skipped == 7 and st.rows_loaded == 0
    # a third run still skips (the append-only log keeps the SUCCESS)
    bid, status, st = bronze.run_ingestion(spark, warehouse["exports"], None, wh + "/bronze")
    assert st.files_skipped == 6
    assert tracking.recent_runs(spark, wh + "/bronze").count() >= 4
    # the current state per file is its latest event (SKIPPED), as the upsert leaves it
    assert tracking.non_success_files(spark, wh + "/bronze").count() == 7
    runs = {r["layer"] for r in tracking.runs(spark, wh + "/bronze").collect()}
    assert runs == {"bronze", "silver"}


def test_failures_are_isolated(spark, tmp_path):
    folder = str(tmp_path / "in")
    etcs_header = headers("exp_etcs_call")
    good = ["2026-05-13 10:00:00.000", "2026-05-13 10:01:00.000", "1s", "2s", "2", "1.0", "1", "", "604070051700001",
            "", "", "", "", "", "", "", "", "", "", "", "", "", "", "", "", ""]
    write_export(folder, "ETCS-Call-tracing_a.csv", etcs_header, [good])
    write_export(folder, "ETCS-Call-tracing_b.csv", etcs_header, [good])  # same bytes: second copy skipped
    write_export(folder, "ETCS-Call-tracing_c.csv", etcs_header + ["Surprise"], [good + ["x"]])
    bad_int = list(good)
    bad_int[8] = "not-a-number"
    write_export(folder, "ETCS-Call-tracing_d.csv", etcs_header, [good, bad_int])
    write_export(folder, "ETCS-Call-tracing_e.csv", etcs_header, [good[:5] + ["1.0", "2"] + good[7:] + ["extra"]])
    write_export(folder, "Cell-Load-report.csv", ["a", "b"], [["1", "2"]])
    write_export(folder, "ETCS-Call-tracing_f.csv", etcs_header + ["IMSI"], [good + ["1"]])
    root = str(tmp_path / "wh")
    bid, status, st = bronze.run_ingestion(spark, folder, None, root)
    assert (st.files_total, st.files_success, st.files_skipped, st.files_failed) == (7, 1, 1, 5)
    assert status == "PARTIAL"
    rows = tracking.read_log(spark, root, tracking.FILE_LOG).collect()
    by_name = {r["filename"]: r for r in rows}
    assert by_name["ETCS-Call-tracing_b.csv"]["status"] == "SKIPPED"
    assert "surprise" in by_name["ETCS-Call-tracing_c.csv"]["error_message"]
    assert "imsi" in by_name["ETCS-Call-tracing_d.csv"]["error_message"]
    assert "fields" in by_name["ETCS-Call-tracing_e.csv"]["error_message"]
    assert by_name["Cell-Load-report.csv"]["error_message"] == "the name fits no known export"
    assert bronze.read_bronze(spark, root, "exp_etcs_call").count() == 1
    assert "imsi.1" in by_name["ETCS-Call-tracing_f.csv"]["error_message"]
    assert tracking.non_success_files(spark, root).count() == 6


def test_empty_and_missing_folder(spark, tmp_path):
    bid, status, st = bronze.run_ingestion(spark, str(tmp_path / "missing"), None, str(tmp_path / "wh"))
    assert status == "SUCCESS" and st.files_total == 0


def test_numeric_text_coercion_per_file(spark, tmp_path):
    """A text column is written as integers only when every value of the file is a whole number."""
    folder = str(tmp_path / "in")
    h = headers("exp_transaction_tracing")
    rows = transactions_rows()
    hexed = [list(r) for r in rows]
    for i, r in enumerate(hexed):
        r[0] = f"2026-05-14 10:0{i}:00.000"
        r[19] = "14B36" if i == 0 else "20108101.0"
    floats = [list(r) for r in rows]
    for i, r in enumerate(floats):
        r[0] = f"2026-05-15 10:0{i}:00.000"
        r[19] = "20108101.0"
    write_export(folder, "Transaction-tracing_hex.csv", h, hexed)
    write_export(folder, "Transaction-tracing_float.csv", h, floats)
    root = str(tmp_path / "wh")
    bid, status, st = bronze.run_ingestion(spark, folder, None, root)
    assert status == "SUCCESS"
    b = bronze.read_bronze(spark, root, "exp_transaction_tracing")
    got = {(r["_source_file"], r["functional_number"]) for r in b.collect()}
    assert ("Transaction-tracing_hex.csv", "14B36") in got
    assert ("Transaction-tracing_hex.csv", "20108101.0") in got  # mixed file: text kept as is
    assert {fn for f, fn in got if f == "Transaction-tracing_float.csv"} == {"20108101"}


def test_gold_quality_report(warehouse):
    from trackyard.plans import profile

    rep = profile.gold_report(warehouse["gold"])
    nulls = {r["column_name"]: r["null_rows"] for r in rep["null_rates"].collect()}
    assert nulls["imsi_last_time"] == rep["null_rates"].first()["total_rows"] - 35
    match = {r["fact_name"]: (r["matched_rows"], r["total_rows"]) for r in rep["match_rates"].collect()}
    assert match["fact_group_call"] == (17, 27) and match["fact_etcs_call"] == (57, 57)
    dom = rep["domains"].collect()
    assert {(r["fact_name"], r["column_name"]) for r in dom} >= {("fact_etcs_call", "root_failure")}
    assert all(r["allowed"] for r in dom if r["fact_name"] == "fact_etcs_call" and r["value"] == "Success")


def test_run_totals_per_source(spark, warehouse):
    totals = tracking.run_totals(spark, warehouse["wh"] + "/bronze")
    first = warehouse["report"].bronze_batch
    got = {r["source_system"]: (r["files_total"], r["files_success"], r["rows_loaded"], r["status"])
           for r in totals.filter(F.col("batch_id") == first).collect()}
    assert got[None] == (7, 7, 57 + 35 + 27 + 5 + 3 + 2 + 4, "SUCCESS")
    assert got["sharepoint"] == (1, 1, 4, "SUCCESS") and got["expandium"][0] == 6


def test_log_compaction(spark, tmp_path):
    root = str(tmp_path / "wh")
    for i in range(3):
        tracking.record_run_start(spark, root, f"b{i}", "bronze")
        tracking.record_run_end(spark, root, f"b{i}", "bronze", tracking.now(), "SUCCESS", 0, 0)
    before = sorted(r.asDict().items() for r in tracking.runs(spark, root).collect())
    month_dir = [d for d in os.listdir(os.path.join(root, tracking.RUN_LOG)) if d.startswith("month=")]
    assert len(month_dir) == 1
    files = lambda: [f for f in os.listdir(os.path.join(root, tracking.RUN_LOG, month_dir[0]))
                     if f.endswith(".parquet")]
    assert len(files()) == 6
    tracking.compact_logs(spark, root, before_month="9999-12")
    assert len(files()) == 1
    assert sorted(r.asDict().items() for r in tracking.runs(spark, root).collect()) == before


def test_gold_views_mode(spark, warehouse, tmp_path):
    """Facts left as views over silver give the same rows as materialised facts."""
    from trackyard.plans import orchestrate as O

    wh = warehouse["wh"]
    groot = str(tmp_path / "gold_views")
    snap = silver.current_snapshot(spark, wh + "/silver")
    rows = O.publish_gold(spark, wh + "/silver", groot, snap, materialise_facts=False)
    assert set(rows) == {"dim_subscriber"}
    views = O.read_gold(spark, groot, register=False, silver_root=wh + "/silver")
    for name in gold.FACTS:
        a = sorted(map(repr, views[name].collect()))
        b = sorted(map(repr, warehouse["gold"][name].collect()))
        assert a == b, name


def test_retention(spark, warehouse, tmp_path):
    """Three loads, of which two are kept: two snapshots of silver and gold are left, and nothing frozen."""
    root, ckpt = str(tmp_path / "wh"), spark.sparkContext.getCheckpointDir()
    local = ckpt.removeprefix("file:")
    held = set(os.listdir(local))
    for _ in range(3):
        report = orchestrate.run_all(spark, root, warehouse["exports"], keep_snapshots=2)
        assert report.silver_status == "SUCCESS"
    for layer in ("silver", "gold"):
        names = [d for d in os.listdir(os.path.join(root, layer)) if d.startswith("snapshot=")]
        assert len(names) == 2 and f"snapshot={report.silver_batch}" in names
    assert orchestrate.read_gold(spark, os.path.join(root, "gold"), register=False)["fact_etcs_call"].count() == 57
    assert not [d for d in set(os.listdir(local)) - held if d.startswith(("frozen-", "bronze-"))]
    with pytest.raises(ValueError):
        silver.retain_snapshots(spark, os.path.join(root, "silver"), 0)
