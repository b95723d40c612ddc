"""Nothing is lost without a row in a log: unreadable stores, reused batch ids, copies, odd names, throwing tables."""

import os
import shutil

import pytest

from tests.exportfiles import frame_error_rows, handover_rows, headers, write_export
from trackyard.plans import bronze, silver, tracking

HO = "exp_ho_tracing"


def ho_file(folder, name="HO-tracing_1.csv", rows=None):
    write_export(str(folder), name, headers(HO), rows or handover_rows())
    return os.path.join(str(folder), name)


def outcomes(spark, root):
    return sorted((r.filename, r.status) for r in tracking.read_log(spark, root, tracking.FILE_LOG).collect())


def count(spark, root, table=HO):
    return bronze.read_bronze(spark, root, table).count()


def test_unreadable_store_is_not_an_empty_one(spark, tmp_path):
    ho_file(tmp_path / "in")
    root, out = str(tmp_path / "bronze"), str(tmp_path / "silver")
    bronze.run_ingestion(spark, str(tmp_path / "in"), None, root)
    _, status, _ = silver.run_silver(spark, root, out)
    assert status == "SUCCESS"
    before = silver.current_snapshot(spark, out)
    _, status, counts = silver.run_silver(spark, "nosuchstore://bucket/bronze", out, tracking_root=root)
    assert status == "FAILED" and counts == {} and silver.current_snapshot(spark, out) == before
    with pytest.raises(Exception, match="nosuchstore"):
        tracking._exists(spark, "nosuchstore://bucket/x")
    assert not tracking._exists(spark, str(tmp_path / "none"))


def test_reused_batch_id_keeps_earlier_rows(spark, tmp_path):
    root = str(tmp_path / "bronze")
    a = ho_file(tmp_path / "a")
    b = ho_file(tmp_path / "b", "HO-tracing_2.csv", handover_rows()[:1])
    bronze.ingest_folder(spark, [a], root, "stream-1")
    n = count(spark, root)
    stats = bronze.ingest_folder(spark, [b], root, "stream-1")
    assert stats.files_failed == 1 and count(spark, root) == n
    stats = bronze.ingest_folder(spark, [b], root, "stream-2")
    assert stats.files_success == 1 and count(spark, root) == n + 1


def test_copy_of_an_unroutable_file_is_loaded(spark, tmp_path):
    path = ho_file(tmp_path / "in")
    shutil.copy(path, str(tmp_path / "in" / "a_report.csv"))
    root = str(tmp_path / "bronze")
    stats = bronze.ingest_folder(spark, str(tmp_path / "in"), root, "b1")
    assert (stats.files_failed, stats.files_success, stats.files_skipped) == (1, 1, 0)
    assert count(spark, root) == len(handover_rows())


def test_copy_of_a_failed_file_has_its_turn(spark, tmp_path):
    # the same bytes routed to a table whose header does not fit, then to one where it does
    path = ho_file(tmp_path / "in", "b_HO-tracing.csv")
    shutil.copy(path, str(tmp_path / "in" / "a_HDLC-Frame-Error-tracing.csv"))
    shutil.copy(path, str(tmp_path / "in" / "c_HO-tracing.csv"))
    root = str(tmp_path / "bronze")
    stats = bronze.ingest_folder(spark, str(tmp_path / "in"), root, "b1")
    assert outcomes(spark, root) == [("a_HDLC-Frame-Error-tracing.csv", "FAILED"), ("b_HO-tracing.csv", "SUCCESS"),
                                     ("c_HO-tracing.csv", "SKIPPED")]
    assert stats.files_total == 3 and count(spark, root) == len(handover_rows())


def test_copies_of_one_name_in_two_folders_load_once(spark, tmp_path):
    a, b = ho_file(tmp_path / "a"), ho_file(tmp_path / "b")
    root = str(tmp_path / "bronze")
    stats = bronze.ingest_folder(spark, [a, b], root, "b1")
    assert (stats.files_success, stats.files_skipped) == (1, 1) and count(spark, root) == len(handover_rows())


def test_names_spark_passes_over_are_logged(spark, tmp_path):
    ho_file(tmp_path / "in")
    ho_file(tmp_path / "in", "_HO-tracing_2.csv", handover_rows()[:1])
    ho_file(tmp_path / "in", ".HO-tracing_3.csv", handover_rows()[:1])
    root = str(tmp_path / "bronze")
    stats = bronze.ingest_folder(spark, str(tmp_path / "in"), root, "b1")
    assert (stats.files_total, stats.files_failed, stats.files_success) == (3, 2, 1)
    assert {n for n, s in outcomes(spark, root) if s == "FAILED"} == {"_HO-tracing_2.csv", ".HO-tracing_3.csv"}


def test_throwing_table_fails_its_own_files(spark, tmp_path, monkeypatch):
    ho_file(tmp_path / "in")
    write_export(str(tmp_path / "in"), "HDLC-Frame-Error-tracing_1.csv", headers("exp_hdlc_frame_errors"),
                 frame_error_rows())
    real = bronze._load_table

    def broken(spark_, spec, *rest):
        if spec.table == HO:
            raise OSError("disk gone")
        return real(spark_, spec, *rest)

    monkeypatch.setattr(bronze, "_load_table", broken)
    root = str(tmp_path / "bronze")
    for _ in range(2):
        bronze.ingest_folder(spark, str(tmp_path / "in"), root, bronze.create_batch_id())
    assert count(spark, root, "exp_hdlc_frame_errors") == len(frame_error_rows())
    monkeypatch.setattr(bronze, "_load_table", real)
    bronze.ingest_folder(spark, str(tmp_path / "in"), root, bronze.create_batch_id())
    assert count(spark, root) == len(handover_rows())


def test_batch_ids_are_path_safe():
    a, b = bronze.create_batch_id(), bronze.create_batch_id("silver_run")
    assert a != b and not set(a + b) & set(': /\\')


def test_empty_file_is_logged_as_failed(spark, tmp_path):
    ho_file(tmp_path / "in")
    (tmp_path / "in" / "HO-tracing_2.csv").write_bytes(b"")
    root = str(tmp_path / "bronze")
    stats = bronze.ingest_folder(spark, str(tmp_path / "in"), root, "b1")
    assert (stats.files_total, stats.files_success, stats.files_failed) == (2, 1, 1)
    errors = {r.filename: r.error_message for r in tracking.read_log(spark, root, tracking.FILE_LOG).collect()}
    assert errors["HO-tracing_2.csv"] == "No columns to parse from file"
