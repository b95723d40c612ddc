"""Run and file tracking (T2-T10) on append-only Parquet logs.

The warehouse being reproduced updates its run row in place and upserts file
rows by hash. Here both logs are append-only event tables; the current view is
the latest event per key. Appends are idempotent per batch, survive retries,
and never rewrite history (which also fixes the SKIPPED-overwrites-SUCCESS
quirk: "already ingested" asks whether *any* SUCCESS event exists).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackyard.operators.merge import latest_state
from trackyard.schemas import FILE_LOG_SCHEMA, RUN_LOG_SCHEMA
from trackyard.sources.files import exists as _exists

RUN_LOG = "_tracking/ingest_runs"
FILE_LOG = "_tracking/ingest_files"


def now() -> _dt.datetime:
    """Driver-side load stamp; one literal per run, like NOW() in one transaction."""
    return _dt.datetime.now(_dt.UTC).replace(tzinfo=None)


def _schema(which: str):
    return RUN_LOG_SCHEMA if which == RUN_LOG else FILE_LOG_SCHEMA


def _time_col(which: str) -> str:
    return "event_time" if which == RUN_LOG else "processed_at"


def read_log(spark: SparkSession, root: str, which: str) -> DataFrame:
    path = f"{root}/{which}"
    schema = _schema(which)
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def _append(df: DataFrame, root: str, which: str) -> None:
    """Logs are partitioned by month, so old months can be compacted and recent reads prune."""
    (df.withColumn("month", F.date_format(_time_col(which), "yyyy-MM"))
       .write.mode("append").partitionBy("month").parquet(f"{root}/{which}"))


def compact_logs(spark: SparkSession, root: str, before_month: str | None = None) -> None:
    """Rewrite every month before ``before_month`` (default: the current month) of both
    logs as one file per month. A month is small (one row per file or run event); the
    rewrite replaces only those month directories (dynamic partition overwrite)."""
    before_month = before_month or now().strftime("%Y-%m")
    for which in (RUN_LOG, FILE_LOG):
        path = f"{root}/{which}"
        if not _exists(spark, path):
            continue
        old = spark.read.parquet(path).filter(F.col("month") < before_month)
        if old.isEmpty():
            continue
        (old.repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("month").parquet(path))


# --- T2 / T3 run log --------------------------------------------------------

def record_run_start(spark: SparkSession, root: str, batch_id: str, layer: str,
                     started: _dt.datetime | None = None) -> _dt.datetime:
    started = started or now()
    row = [(batch_id, layer, "start", started, started, None, "RUNNING", 0 if layer == "bronze" else None,
            0, None)]
    _append(spark.createDataFrame(row, RUN_LOG_SCHEMA), root, RUN_LOG)
    return started


def record_run_end(spark: SparkSession, root: str, batch_id: str, layer: str, started: _dt.datetime,
                   status: str, total_files: int | None, total_rows: int,
                   error_message: str | None = None) -> None:
    ended = now()
    row = [(batch_id, layer, "end", ended, started, ended, status, total_files, int(total_rows), error_message)]
    _append(spark.createDataFrame(row, RUN_LOG_SCHEMA), root, RUN_LOG)


def runs(spark: SparkSession, root: str) -> DataFrame:
    """Current state of every run (latest event per batch_id)."""
    return latest_state(read_log(spark, root, RUN_LOG), ["batch_id"]).drop("event", "event_time")


# --- T4 file log ------------------------------------------------------------

def record_file_results(results: DataFrame, root: str) -> None:
    """Append one event per processed file (the upsert is resolved on read)."""
    _append(results.select(*[F.col(f.name).cast(f.dataType) for f in FILE_LOG_SCHEMA.fields]), root, FILE_LOG)


def files(spark: SparkSession, root: str) -> DataFrame:
    """Current state per file_id (latest processed_at wins, as the upsert would leave it)."""
    return latest_state(read_log(spark, root, FILE_LOG), ["file_id"], "processed_at")


def record_paths(results: DataFrame, ledger: str, batch_id: str) -> None:
    """Append what became of each path (path, status, error)."""
    results.select("path", "status", "error", F.lit(batch_id).alias("batch_id"), F.lit(now()).cast("timestamp_ntz").alias(
        "recorded_at")).write.mode("append").parquet(ledger)


def failed_paths(spark: SparkSession, ledger: str) -> DataFrame:
    """(path, error) of the paths whose last outcome is FAILED."""
    if not _exists(spark, ledger):
        return spark.createDataFrame([], "path string, error string")
    return latest_state(spark.read.parquet(ledger), ["path"], "recorded_at").filter("status = 'FAILED'").select("path", "error")


# --- T5 / T6 status roll-up -------------------------------------------------

def rollup_status(failed, success):
    """failed = 0 -> SUCCESS; some success -> PARTIAL; else FAILED."""
    return (F.when(failed == 0, F.lit("SUCCESS"))
             .when(success > 0, F.lit("PARTIAL"))
             .otherwise(F.lit("FAILED")))


# --- T7 / T10 counts, T8 / T9 reports ----------------------------------------

def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table plus a ``total`` row (ROLLUP over the per-table counts)."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    rolled = counts.rollup("table_name").agg(F.sum("row_count").cast("bigint").alias("row_count"))
    return rolled.select(F.coalesce("table_name", F.lit("total")).alias("table_name"), "row_count")


def latest_runs(run_states: DataFrame, n: int = 10) -> DataFrame:
    """``ORDER BY start_time DESC LIMIT n`` (a top-k report: the limit is the feature)."""
    return (run_states.orderBy(F.col("start_time").desc_nulls_last(), F.col("batch_id").desc())
            .limit(n).select("batch_id", "layer", "start_time", "status", "total_files", "total_rows",
                             "error_message"))


def recent_runs(spark: SparkSession, root: str, n: int = 10) -> DataFrame:
    return latest_runs(runs(spark, root), n)


def not_successful(file_states: DataFrame) -> DataFrame:
    """Files whose current status is not SUCCESS (NULL status drops out), newest first."""
    return (file_states.filter(F.col("status") != "SUCCESS")
            .orderBy(F.col("processed_at").desc_nulls_last(), F.col("file_id"))
            .select("batch_id", "filename", "source_system", "status", "row_count", "error_message"))


def non_success_files(spark: SparkSession, root: str) -> DataFrame:
    return not_successful(files(spark, root))


def run_totals(spark: SparkSession, root: str) -> DataFrame:
    """File counts and rows per run and source system, plus the run's total row
    (``source_system`` NULL) from a ROLLUP; status rolled up as for a run."""
    log = read_log(spark, root, FILE_LOG)
    # one event per (run, file): a replayed micro-batch may have logged a file twice
    return totals_by_source(latest_state(log, ["batch_id", "file_id", "filename"], "processed_at"))


def batch_status(spark: SparkSession, root: str, batch_id: str) -> str:
    """T5: the status of a run, rolled up from its files' results; a run without files has succeeded."""
    log = read_log(spark, root, FILE_LOG).filter(F.col("batch_id") == batch_id)
    row = totals_by_source(log).filter(F.col("source_system").isNull()).select("status").first()
    return row["status"] if row else "SUCCESS"


def totals_by_source(per_file: DataFrame) -> DataFrame:
    """ROLLUP(batch_id, source_system) of per-file results; the NULL-source row is the run total."""
    agg = per_file.rollup("batch_id", "source_system").agg(
        F.count(F.lit(1)).alias("files_total"),
        F.count_if(F.col("status") == "SUCCESS").alias("files_success"),
        F.count_if(F.col("status") == "SKIPPED").alias("files_skipped"),
        F.count_if(F.col("status") == "FAILED").alias("files_failed"),
        F.sum("row_count").cast("bigint").alias("rows_loaded"))
    return (agg.filter(F.col("batch_id").isNotNull())
               .withColumn("status", rollup_status(F.col("files_failed"), F.col("files_success"))))
