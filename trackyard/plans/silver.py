"""Silver layer (D1-D7, L1-L4): latest row per business key, parsed and typed.

Every table is one DataFrame: dedup window (one shuffle on the key, with a
map-side partial limit) and a projection of native expressions. A load writes
all seven tables into a fresh snapshot directory and publishes it by appending
one pointer row last, so readers never see a half-written layer (the
all-or-nothing transaction of the original) and a failed load leaves the
previous snapshot current.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackyard.functions import parse as P
from trackyard.operators.dedup import dedup_latest
from trackyard.plans import tracking
from trackyard.plans.bronze import read_bronze
from trackyard.schemas import ALL_TABLES, LINEAGE_COLUMNS, SOURCES
from trackyard.session import run_concurrently
from trackyard.sources.files import delete

RATE_COLUMNS = ("sccp_success_rate", "cell_success_rate", "dispatcher_success_rate")
POINTER = "_published"


def _prepared(table: str) -> dict[str, Column]:
    """Helper columns computed before the projection (each ratio text parsed once)."""
    pre = {}
    if table == "exp_vgcs_vbs_rec_tracing":
        for rate in RATE_COLUMNS:
            num, den = P.success_rate_split(rate)
            pre[f"__{rate}_num"], pre[f"__{rate}_den"] = num, den
    return pre


def _derived(table: str) -> dict[str, Column | list[tuple[str, Column]]]:
    """Silver expressions that differ from the bronze column of the same name."""
    dur = P.parse_duration_ms
    if table == "exp_etcs_call":
        return {"stop_time": P.sentinel_timestamp("stop_time", trim=True),
                "call_setup_duration": dur("call_setup_duration"),
                "transaction_duration": dur("transaction_duration")}
    if table == "exp_transaction_tracing":
        return {"stop_time": P.sentinel_timestamp("stop_time", trim=False),
                "call_setup_duration": dur("call_setup_duration"),
                "establishment_delay": dur("establishment_delay"),
                "transaction_duration": dur("transaction_duration")}
    if table == "exp_vgcs_vbs_rec_tracing":
        out: dict = {"establishment_delay": dur("establishment_delay"), "vgcs_duration": dur("vgcs_duration")}
        for rate in RATE_COLUMNS:
            stem = rate[: -len("_rate")]
            num, den = F.col(f"__{rate}_num"), F.col(f"__{rate}_den")
            out[rate] = [(f"{stem}_numerator", num), (f"{stem}_denominator", den),
                         (rate, P.success_rate_value(num, den))]
        return out
    if table == "sp_ertms_disconnects":
        return {"mrm": P.guarded_int("mrm"), "km": P.guarded_decimal("km")}
    return {}


def has_derived(table: str) -> bool:
    """Whether silver values are parsed from bronze ones; else they are the same."""
    return bool(_prepared(table) or _derived(table))


def silver_projection(table: str, loaded_at: _dt.datetime) -> list[Column]:
    """L4: silver column list in table order, lineage last (with the load stamp)."""
    derived = _derived(table)
    cols: list[Column] = []
    for c in SOURCES[table].columns:
        d = derived.get(c.name)
        if d is None:
            cols.append(F.col(c.name))
        elif isinstance(d, list):
            cols.extend(expr.alias(name) for name, expr in d)
        else:
            cols.append(d.alias(c.name))
    lineage = [F.col(c) for c in LINEAGE_COLUMNS]
    lineage.insert(3, F.lit(loaded_at).cast("timestamp_ntz").alias("_silver_loaded_at"))
    return cols + lineage


def to_silver(bronze_rows: DataFrame, table: str, loaded_at: _dt.datetime) -> DataFrame:
    """L4 on already-deduplicated rows: helper columns, then the typed projection."""
    pre = _prepared(table)
    return (bronze_rows.withColumns(pre) if pre else bronze_rows).select(*silver_projection(table, loaded_at))


def build_silver_table(bronze: DataFrame, table: str, loaded_at: _dt.datetime) -> DataFrame:
    """D1-D7 + L4: dedup-latest on the table's key, then the typed projection."""
    return to_silver(dedup_latest(bronze, SOURCES[table].dedup_keys), table, loaded_at)


def build_silver(bronze: Mapping[str, DataFrame], loaded_at: _dt.datetime | None = None) -> dict[str, DataFrame]:
    loaded_at = loaded_at or tracking.now()  # F8: one stamp for all seven tables
    return {t: build_silver_table(bronze[t], t, loaded_at) for t in bronze}


# --------------------------------------------------------------------------
# L1-L3 snapshot load
# --------------------------------------------------------------------------

def publish(spark: SparkSession, root: str, snapshot: str) -> None:
    row = spark.createDataFrame([(snapshot, tracking.now())], "snapshot string, published_at timestamp_ntz")
    row.write.mode("append").parquet(f"{root}/{POINTER}")


def current_snapshot(spark: SparkSession, root: str) -> str | None:
    path = f"{root}/{POINTER}"
    if not tracking._exists(spark, path):
        return None
    latest = (spark.read.parquet(path).orderBy(F.col("published_at").desc(), F.col("snapshot").desc())
              .limit(1).collect())
    return latest[0]["snapshot"] if latest else None


def retain_snapshots(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Delete the snapshots that were published before the latest ``keep`` ones; returns their names.

    Only snapshots that the pointer log names are touched: one that is being written has no pointer yet. A reader
    of the current snapshot is safe for the next ``keep - 1`` loads.
    """
    if keep < 1:
        raise ValueError("the current snapshot has to stay")
    path = f"{root}/{POINTER}"
    if not tracking._exists(spark, path):
        return []
    # one row a snapshot name; a name that was published again counts by its last time
    names = [r["snapshot"] for r in spark.read.parquet(path).groupBy("snapshot").agg(F.max("published_at").alias("at"))
             .orderBy(F.col("at").desc(), F.col("snapshot").desc()).select("snapshot").collect()]
    gone = [n for n in names[keep:] if tracking._exists(spark, f"{root}/snapshot={n}")]
    for name in gone:
        delete(spark, f"{root}/snapshot={name}")
    return gone


def read_silver(spark: SparkSession, silver_root: str, snapshot: str | None = None) -> dict[str, DataFrame]:
    snapshot = snapshot or current_snapshot(spark, silver_root)
    if snapshot is None:
        raise FileNotFoundError(f"no published silver snapshot under {silver_root}")
    return {t: spark.read.parquet(f"{silver_root}/snapshot={snapshot}/{t}") for t in ALL_TABLES}


def load_silver(spark: SparkSession, bronze_root: str, silver_root: str, snapshot: str,
                loaded_at: _dt.datetime | None = None) -> dict[str, int]:
    """L1/L2: full rebuild of the seven tables into ``snapshot``, published when all are written."""
    bronze = {t: read_bronze(spark, bronze_root, t) for t in ALL_TABLES}
    silver = build_silver(bronze, loaded_at)
    run_concurrently([lambda t=t, df=df: df.write.mode("overwrite").parquet(f"{silver_root}/snapshot={snapshot}/{t}")
                      for t, df in silver.items()])
    counts = {r["table_name"]: int(r["row_count"]) for r in tracking.layer_counts(
        read_silver(spark, silver_root, snapshot)).collect()}  # T7, read back from the written files
    publish(spark, silver_root, snapshot)
    return counts


def run_silver(spark: SparkSession, bronze_root: str, silver_root: str, batch_id: str | None = None,
               tracking_root: str | None = None) -> tuple[str, str, dict[str, int]]:
    """L3: run-log start, load, counts, run-log end (error text ``Type: message``)."""
    from trackyard.plans.bronze import create_batch_id

    tracking_root = tracking_root or bronze_root
    batch_id = batch_id or create_batch_id("silver_run")
    started = tracking.record_run_start(spark, tracking_root, batch_id, "silver")
    status, counts, error = "FAILED", {}, None
    try:
        counts = load_silver(spark, bronze_root, silver_root, batch_id, loaded_at=started)
        status = "SUCCESS"
    except Exception as exc:  # noqa: BLE001 - recorded in the run log
        error = f"{type(exc).__name__}: {exc}"
    tracking.record_run_end(spark, tracking_root, batch_id, "silver", started, status, None,
                            counts.get("total", 0), error)
    return batch_id, status, counts
