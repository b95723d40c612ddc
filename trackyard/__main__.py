"""Command line: ``python -m trackyard <command> --warehouse DIR [...]``.

  bronze   ingest the export folder (and incident folder) into bronze
  silver   rebuild silver from bronze into a new snapshot
  gold     publish dim + facts for the current silver snapshot
  all      bronze -> status gate -> silver -> gold
  stream   incremental ingest of new export files (availableNow), then incremental silver
  report   recent runs, non-success files, row counts of the current silver snapshot

Under spark-submit the session comes from the cluster; ``--master`` is for local use.
"""

from __future__ import annotations

import argparse
import json
import sys

from trackyard.session import build_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m trackyard", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("command", choices=["bronze", "silver", "gold", "all", "stream", "report"])
    p.add_argument("--warehouse", required=True, help="root folder of bronze/silver/gold")
    p.add_argument("--exports", help="folder of supervision exports")
    p.add_argument("--incidents", help="folder of incident-sheet exports (delimited)")
    p.add_argument("--incidents-sep", default=";")
    p.add_argument("--checkpoint", help="stream checkpoint folder (stream command)")
    p.add_argument("--master", help="e.g. local[8]; omit under spark-submit")
    return p


def main(argv: list[str] | None = None) -> dict:
    from trackyard.plans import bronze, orchestrate, silver, tracking
    from trackyard.schemas import ALL_TABLES

    args = _parser().parse_args(argv)
    spark = build_session(args.master)
    wh = args.warehouse.rstrip("/")
    broot, sroot, groot = f"{wh}/bronze", f"{wh}/silver", f"{wh}/gold"
    out: dict = {"command": args.command}
    if args.command == "bronze":
        bid, status, st = bronze.run_ingestion(spark, args.exports, args.incidents, broot,
                                               incidents_sep=args.incidents_sep)
        out.update(batch_id=bid, status=status, **st.__dict__)
    elif args.command == "silver":
        sid, status, counts = silver.run_silver(spark, broot, sroot)
        out.update(batch_id=sid, status=status, counts=counts)
    elif args.command == "gold":
        snap = silver.current_snapshot(spark, sroot)
        out.update(snapshot=snap, rows=orchestrate.publish_gold(spark, sroot, groot, snap))
    elif args.command == "all":
        r = orchestrate.run_all(spark, wh, args.exports, args.incidents, args.incidents_sep)
        out.update(bronze_batch=r.bronze_batch, bronze_status=r.bronze_status, bronze=r.bronze_stats.__dict__,
                   silver_batch=r.silver_batch, silver_status=r.silver_status, silver=r.silver_counts,
                   gold=r.gold_rows)
    elif args.command == "stream":
        from trackyard.streaming import incremental

        ckpt = (args.checkpoint or f"{wh}/_stream").rstrip("/")
        incremental.start_export_stream(spark, args.exports, broot, f"{ckpt}/exports").awaitTermination()
        for table in ALL_TABLES:
            if tracking._exists(spark, f"{broot}/{table}"):
                incremental.start_silver_stream(spark, broot, sroot, table, f"{ckpt}/{table}").awaitTermination()
        out.update(status="done")
    else:
        out["recent_runs"] = [r.asDict() for r in tracking.recent_runs(spark, broot).collect()]
        out["non_success_files"] = [r.asDict() for r in tracking.non_success_files(spark, broot).collect()]
        if silver.current_snapshot(spark, sroot):
            out["silver_counts"] = {r["table_name"]: r["row_count"] for r in
                                    tracking.layer_counts(silver.read_silver(spark, sroot)).collect()}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
