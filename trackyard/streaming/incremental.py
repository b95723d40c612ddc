"""Incremental ingest with Structured Streaming.

The hourly poll of the original becomes a file-stream query run with
``trigger(availableNow=True)``: the stream checkpoint remembers which files
were seen (exactly-once discovery, survives driver restarts), and each
micro-batch goes through the same batch code as a bronze run. Content hashes
stay necessary: a renamed copy of a seen file is a new path to the stream. A file that failed is
a path that the stream has seen; a ledger of outcomes by path offers it again with each trigger until it succeeds.

Silver follows incrementally: each new bronze micro-batch is merged with the
current silver table by business key (latest ``_ingested_at`` wins, so a late
re-export still wins whatever its event time; no watermark, which would drop
such rows). The partitions it touches are written anew under a version of their own, which
becomes current by one row appended last: until then, and if the job is lost, readers see the state before.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trackyard.operators.dedup import dedup_latest
from trackyard.plans import bronze as B
from trackyard.plans import silver as S
from trackyard.plans import tracking
from trackyard.schemas import INCIDENT_TABLE, SOURCE_EXPORTS, SOURCE_INCIDENTS, SOURCES
from trackyard.sources.files import delete, exists

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint for good."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(text)["id"]


def start_export_stream(spark: SparkSession, exports_dir: str, bronze_root: str, checkpoint: str,
                        source_system: str = SOURCE_EXPORTS, tables=None, sep: str = ";",
                        available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """New export files only, each exactly once, through the bronze batch code; failed ones again until they succeed.

    Only the ``path`` column is used from the stream (content is pruned); the
    micro-batch's file list (one row per new file) drives ``ingest_folder``.
    A replayed micro-batch reuses its batch id, so its bronze partition is
    overwritten rather than duplicated.
    """
    ledger = f"{bronze_root}/_tracking/paths/{source_system}"
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = reader.load(exports_dir).select("path")

    def ingest(paths: list[str], batch_id: str) -> None:
        started = tracking.record_run_start(spark, bronze_root, batch_id, "bronze")
        try:
            stats = B.ingest_folder(spark, paths, bronze_root, batch_id, source_system, tables=tables, sep=sep,
                                    started=started, ledger=ledger)
            tracking.record_run_end(spark, bronze_root, batch_id, "bronze", started,
                                    tracking.batch_status(spark, bronze_root, batch_id), stats.files_total, stats.rows_loaded)
        except Exception as exc:
            tracking.record_run_end(spark, bronze_root, batch_id, "bronze", started, "FAILED", 0, 0,
                                    f"{type(exc).__name__}: {exc}")
            raise

    def failed() -> list[str]:
        return [r["path"] for r in tracking.failed_paths(spark, ledger).select("path").collect() if exists(spark, r["path"])]

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        # the scan has to be told its files; nothing else of them is collected
        paths = sorted(r["path"] for r in batch.distinct().collect())
        if paths:
            # the query's own id: another stream, or a new checkpoint, can't reuse a batch's name
            ingest(paths, f"stream-{query_id(spark, checkpoint)}-{epoch_id:08d}")

    # a trigger without new files makes no batch, so what has failed is offered before the stream starts
    if again := failed():
        ingest(sorted(again), B.create_batch_id("retry"))
    writer = files.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="60 minutes")
    return writer.start()


def start_incident_stream(spark: SparkSession, incidents_dir: str, bronze_root: str, checkpoint: str, sep: str = ";",
                          **options) -> StreamingQuery:
    """U1 for the incident sheet: every file of its folder belongs to its table."""
    return start_export_stream(spark, incidents_dir, bronze_root, checkpoint, SOURCE_INCIDENTS, [INCIDENT_TABLE], sep, **options)


# --------------------------------------------------------------------------
# U2 / U3 incremental latest-per-key
# --------------------------------------------------------------------------
# Every dedup key carries a time column except the matrix's (imsi alone), so
# all copies of a key share one day: the incremental silver table is
# partitioned by that day (the matrix by a hash bucket of imsi) and an epoch
# writes only the partitions its rows touch anew, not the whole table.

MATRIX_BUCKETS = 64
PART = "_part"


def partition_column(table: str):
    spec = SOURCES[table]
    timed = [k for k in spec.dedup_keys if spec.column(k).kind in ("timestamp_ntz", "date")]
    if timed:
        day = F.date_format(F.col(timed[0]), "yyyy-MM-dd")
    else:
        day = F.format_string("b%03d", F.pmod(F.xxhash64(*[F.col(k) for k in spec.dedup_keys]),
                                               F.lit(MATRIX_BUCKETS)))
    return F.coalesce(day, F.lit("none"))


def _table_root(silver_root: str, table: str) -> str:
    return f"{silver_root}/incremental/{table}"


VERSIONS = "version string, parts array<string>, published_at timestamp_ntz"


def current_versions(spark: SparkSession, silver_root: str, table: str) -> DataFrame | None:
    """(``PART``, version): the last published version of each partition; None before the first."""
    path = f"{_table_root(silver_root, table)}/versions"
    if not tracking._exists(spark, path):
        return None
    rows = spark.read.schema(VERSIONS).parquet(path).select(F.explode("parts").alias(PART), "version", "published_at")
    return rows.groupBy(PART).agg(F.max_by("version", F.struct("published_at", "version")).alias("version"))


def current_table(spark: SparkSession, silver_root: str, table: str, parts: DataFrame | None = None) -> DataFrame | None:
    """The current rows, of the partitions in ``parts`` only if given; None before the first epoch.

    The join with the partitions' current versions prunes the scan's folders at run time.
    """
    versions = current_versions(spark, silver_root, table)
    if versions is None:
        return None
    if parts is not None:
        versions = versions.join(parts, PART, "left_semi")
    data = spark.read.parquet(f"{_table_root(silver_root, table)}/data")
    return data.withColumn(PART, F.col(PART).cast("string")).join(versions, ["version", PART], "left_semi").drop("version", PART)


def merge_batch(current: DataFrame | None, batch_bronze: DataFrame, table: str, loaded_at) -> DataFrame:
    """Silver rows of the touched partitions and projected new bronze rows, the latest per key."""
    # a table whose silver rows are its bronze rows is deduplicated once, together with what is there; where values are
    # parsed, rows that a later one replaces must not be: they may hold what can't be parsed
    if current is None or S.has_derived(table):
        projected = S.build_silver_table(batch_bronze, table, loaded_at)
    else:
        projected = S.to_silver(batch_bronze, table, loaded_at)
    if current is None:
        return projected
    return dedup_latest(current.unionByName(projected), SOURCES[table].dedup_keys)


def merge_epoch(spark: SparkSession, batch: DataFrame, silver_root: str, table: str, epoch: str) -> None:
    """Merge one micro-batch: write the partitions it touches under a new version, then publish it.

    Nothing that is read is overwritten. A repeated epoch, published or not, gets a version of its own and
    comes to the same rows.
    """
    root, version = _table_root(silver_root, table), f"{epoch}-{uuid.uuid4().hex[:8]}"
    touched = batch.select(partition_column(table).alias(PART)).distinct()
    current = current_table(spark, silver_root, table, touched)
    if "imsi" in SOURCES[table].names:
        _record_changes(current, batch, table, f"{root}/changes/version={version}")
    merged = merge_batch(current, batch, table, tracking.now())
    merged.withColumns({"version": F.lit(version), PART: partition_column(table)}) \
          .write.mode("append").partitionBy("version", PART).parquet(f"{root}/data")
    written = spark.read.parquet(f"{root}/data").filter(F.col("version") == version).select(F.col(PART).cast("string")).distinct()
    written.agg(F.lit(version).alias("version"), F.array_sort(F.collect_set(PART)).alias("parts"),
                F.lit(tracking.now()).cast("timestamp_ntz").alias("published_at")) \
           .coalesce(1).write.mode("append").parquet(f"{root}/versions")


def _record_changes(current: DataFrame | None, batch: DataFrame, table: str, path: str) -> None:
    """Write the imsi whose rows an epoch adds or replaces."""
    keys, changed = SOURCES[table].dedup_keys, batch.select("imsi")
    if current is not None and "imsi" not in keys:  # else a row and the one that replaces it have the same imsi
        new = batch.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
        same = [current[k].eqNullSafe(new[f"__{k}"]) for k in keys]
        changed = changed.unionByName(current.join(new, same, "left_semi").select("imsi"))
    changed.filter("imsi is not null").distinct().write.parquet(path)


def published_versions(spark: SparkSession, silver_root: str, table: str) -> list[str]:
    path = f"{_table_root(silver_root, table)}/versions"
    if not tracking._exists(spark, path):
        return []
    return [r["version"] for r in spark.read.schema(VERSIONS).parquet(path).select("version").distinct().collect()]


def changed_imsi(spark: SparkSession, silver_root: str, table: str, version: str) -> DataFrame:
    """The imsi whose rows this epoch has added or replaced."""
    return spark.read.schema("imsi bigint").parquet(f"{_table_root(silver_root, table)}/changes/version={version}")


def drop_old_versions(spark: SparkSession, silver_root: str, table: str) -> None:
    """Delete the folders of versions that are no partition's current one. No epoch and no reader may be at work."""
    versions = current_versions(spark, silver_root, table)
    if versions is None:
        return
    data = f"{_table_root(silver_root, table)}/data"
    published = spark.read.schema(VERSIONS).parquet(f"{_table_root(silver_root, table)}/versions").select("version").distinct()
    for row in published.join(versions, "version", "left_anti").collect():
        delete(spark, f"{data}/version={row['version']}")


def start_silver_stream(spark: SparkSession, bronze_root: str, silver_root: str, table: str, checkpoint: str,
                        available_now: bool = True) -> StreamingQuery:
    """Fold each new bronze micro-batch of ``table`` into the silver table, partition by partition."""
    stream = spark.readStream.schema(SOURCES[table].bronze_schema).parquet(f"{bronze_root}/{table}")

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        if not batch.isEmpty():
            merge_epoch(spark, batch, silver_root, table, f"{query_id(spark, checkpoint)}-{epoch_id:08d}")

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="60 minutes")
    return writer.start()
