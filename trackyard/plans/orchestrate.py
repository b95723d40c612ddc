"""End-to-end run (entry D of the original scheduler): bronze -> gate -> silver -> gold.

The timer is not reproduced (a cluster scheduler or the availableNow stream
does that); this is one run. The gate uses the run *status*, not an exit
code: a FAILED bronze run stops, PARTIAL continues.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from trackyard.plans import bronze as B
from trackyard.plans import gold as G
from trackyard.plans import silver as S
from trackyard.plans import tracking
from trackyard.schemas import ALL_TABLES
from trackyard.session import frozen_scope, run_concurrently


@dataclass
class RunReport:
    bronze_batch: str
    bronze_status: str
    bronze_stats: B.Stats
    silver_batch: str | None = None
    silver_status: str | None = None
    silver_counts: dict = field(default_factory=dict)
    gold_rows: dict = field(default_factory=dict)


def publish_gold(spark: SparkSession, silver_root: str, gold_root: str, snapshot: str,
                 materialise_facts: bool = True) -> dict[str, int]:
    """Materialise the dimension once per silver snapshot (its key must be frozen);
    write the facts next to it, or, with ``materialise_facts=False``, leave them as
    views that ``read_gold`` builds on the fly, as the original's gold views were."""
    silver = S.read_silver(spark, silver_root, snapshot)
    with frozen_scope(spark):
        dim, dim_rows = G.build_dim(silver)
        dim.write.mode("overwrite").parquet(f"{gold_root}/snapshot={snapshot}/dim_subscriber")
    rows = {"dim_subscriber": dim_rows}
    if materialise_facts:
        dim = spark.read.parquet(f"{gold_root}/snapshot={snapshot}/dim_subscriber")

        def write_fact(name: str) -> int:
            G.build_fact(name, silver, dim).write.mode("overwrite").parquet(
                f"{gold_root}/snapshot={snapshot}/{name}")
            return spark.read.parquet(f"{gold_root}/snapshot={snapshot}/{name}").count()

        counts = run_concurrently([lambda n=n: write_fact(n) for n in G.FACTS])
        rows.update(zip(G.FACTS, counts, strict=True))
    S.publish(spark, gold_root, snapshot)
    return rows


def read_gold(spark: SparkSession, gold_root: str, register: bool = True, silver_root: str | None = None) -> dict:
    """Current gold tables; facts that were not materialised are built as views over the
    silver snapshot of the same name (``silver_root`` defaults to a sibling ``silver``)."""
    snap = S.current_snapshot(spark, gold_root)
    if snap is None:
        raise FileNotFoundError(f"no published gold snapshot under {gold_root}")
    base = f"{gold_root}/snapshot={snap}"
    dim = spark.read.parquet(f"{base}/dim_subscriber")
    tables = {"dim_subscriber": dim}
    silver = None
    for name in G.FACTS:
        if tracking._exists(spark, f"{base}/{name}"):
            tables[name] = spark.read.parquet(f"{base}/{name}")
            continue
        if silver is None:  # not materialised: the fact is a view over silver
            silver_root = silver_root or gold_root.rstrip("/").rsplit("/", 1)[0] + "/silver"
            silver = S.read_silver(spark, silver_root, snap)
        tables[name] = G.build_fact(name, silver, dim)
    if register:
        G.register_views(spark, tables)
    return tables


def run_all(spark: SparkSession, warehouse: str, exports_dir: str | None, incidents_dir: str | None = None,
            incidents_sep: str = ";", keep_snapshots: int | None = None) -> RunReport:
    """Bronze, silver and gold; with ``keep_snapshots`` older snapshots of silver and gold are removed afterwards."""
    bronze_root, silver_root, gold_root = (f"{warehouse}/bronze", f"{warehouse}/silver", f"{warehouse}/gold")
    bid, bstatus, bstats = B.run_ingestion(spark, exports_dir, incidents_dir, bronze_root,
                                           incidents_sep=incidents_sep)
    report = RunReport(bid, bstatus, bstats)
    if bstatus == "FAILED":
        return report
    sid, sstatus, counts = S.run_silver(spark, bronze_root, silver_root)
    report.silver_batch, report.silver_status, report.silver_counts = sid, sstatus, counts
    if sstatus == "SUCCESS":
        report.gold_rows = publish_gold(spark, silver_root, gold_root, sid)
        if keep_snapshots:
            for root in (silver_root, gold_root):
                S.retain_snapshots(spark, root, keep_snapshots)
    return report


def run_incremental(spark: SparkSession, warehouse: str, exports_dir: str | None, incidents_dir: str | None = None,
                    incidents_sep: str = ";") -> dict:
    """One incremental run of all layers: new and repaired files to bronze, new bronze rows to silver, changed imsi to gold.

    Returns the gold tables. What has been read before is not read again, whatever the length of history.
    """
    from trackyard.plans import gold_incremental
    from trackyard.streaming import incremental as U

    bronze_root, silver_root, gold_root = (f"{warehouse}/{x}" for x in ("bronze", "silver", "gold"))
    state = f"{warehouse}/_streams"
    if exports_dir:
        U.start_export_stream(spark, exports_dir, bronze_root, f"{state}/exports").awaitTermination()
    if incidents_dir:
        U.start_incident_stream(spark, incidents_dir, bronze_root, f"{state}/incidents", incidents_sep).awaitTermination()
    tables = [t for t in ALL_TABLES if tracking._exists(spark, f"{bronze_root}/{t}")]
    run_concurrently([lambda t=t: U.start_silver_stream(spark, bronze_root, silver_root, t, f"{state}/{t}").awaitTermination()
                      for t in tables])
    gold_incremental.refresh_dim(spark, silver_root, gold_root)
    return gold_incremental.read_gold(spark, silver_root, gold_root)
