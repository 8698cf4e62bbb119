"""Command line: ``python -m flowlake <command> [options]``.

The only place that creates a SparkSession (``getOrCreate``, so it reuses
an active one, e.g. under ``spark-submit``).  Every command prints a JSON
report built from the returned DataFrame (small: one row per table).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def _print(value) -> None:
    print(json.dumps(value, indent=2, default=str))


def main(argv: list[str] | None = None) -> int:
    from flowlake.operators import evolution as EV
    from flowlake.operators import maintenance as M
    from flowlake.operators import validate as V
    from flowlake.plans.transform import run_transform
    from flowlake.session import configure
    from flowlake.sources import csv as S
    from flowlake.sources import fs
    from flowlake.sources.snapshots import SnapshotStore

    parser = argparse.ArgumentParser(prog="flowlake")
    sub = parser.add_subparsers(dest="command", required=True)
    t = sub.add_parser("transform", help="raw CSV captures -> fact + aggregate snapshots")
    t.add_argument("--raw", required=True, help="glob of the CSV captures")
    t.add_argument("--root", required=True, help="snapshot root")
    t.add_argument("--cache-mode", choices=["full", "narrow", "none"], default="none")
    t.add_argument("--cluster-fact", action="store_true",
                   help="rebalance the fact by day before its write (captures that mix many days)")
    t.add_argument("--adaptive", choices=["on", "off"], default=None, help="adaptive execution for this run")
    t.add_argument("--shuffle-partitions", type=int, default=None, help="shuffle partitions for this run")
    t.add_argument("--plans-dir", default=None, help="write each table's query plan here")
    t.add_argument("--metrics", default=None, help="store the report as a JSON file here as well")
    t.add_argument("--types", default=None,
                   help='JSON {"column": "type"} for columns beyond the canonical ones')
    t.add_argument("--infer", action="store_true",
                   help="infer the types of other columns with one pass over the text")
    t.add_argument("--header", default=None,
                   help="the header line shared by every file (skips per-file header reads)")
    v = sub.add_parser("validate", help="raw-text recount vs fact; exit 1 on a mismatch")
    v.add_argument("--raw", required=True)
    v.add_argument("--root", required=True)
    e = sub.add_parser("export", help="replace the tables of another root from pinned versions")
    e.add_argument("--root", required=True)
    e.add_argument("--target", required=True)
    w = sub.add_parser("warehouse", help="daily warehouse load with row checks")
    w.add_argument("--root", required=True)
    w.add_argument("--target", required=True)
    w.add_argument("--date", default=None, help="ingestion date (default: today, UTC)")
    r = sub.add_parser("retain", help="retention with an audit trail")
    r.add_argument("--root", required=True)
    r.add_argument("--run-id", default=None)
    p = sub.add_parser("publish", help="manifest of versions and row counts")
    p.add_argument("--root", required=True)
    p.add_argument("--run-id", default=None, help="verify against this retention audit")
    d = sub.add_parser("evolve", help="evolution + time-travel demo on a copy of the fact")
    d.add_argument("--root", required=True)
    d.add_argument("--demo-root", required=True)
    args = parser.parse_args(argv)

    spark = configure(SparkSession.builder.appName(f"flowlake-{args.command}").getOrCreate())
    store = SnapshotStore(spark, args.root)
    if args.command == "transform":
        plans: dict[str, str] | None = {} if args.plans_dir else None
        types = json.loads(args.types) if args.types else None
        settings = {}
        if args.adaptive:
            settings["spark.sql.adaptive.enabled"] = str(args.adaptive == "on").lower()
        if args.shuffle_partitions:
            settings["spark.sql.shuffle.partitions"] = str(args.shuffle_partitions)
        began = time.perf_counter()
        scan = S.csv_scan(spark, args.raw, types=types, header=args.header, infer=args.infer)
        read_seconds = time.perf_counter() - began
        report = run_transform(spark, scan, store,
                               cache_mode=args.cache_mode,
                               cluster_fact=args.cluster_fact, plans=plans,
                               read_seconds=read_seconds, settings=settings)
        for name, text in (plans or {}).items():
            fs.write_new(spark, f"{args.plans_dir.rstrip('/')}/{name}.txt", text)
        metrics = _rows(report)[0]
        if args.metrics:
            fs.write_new(spark, args.metrics, json.dumps(metrics, indent=2, default=str))
        _print(metrics)
    elif args.command == "validate":
        fact = store.read("network_events")
        labels = V.validate_labels(spark, args.raw, fact)
        structure = V.validate_structure(S.raw_record_count(spark, args.raw), fact)
        ok_labels = labels.where("NOT match").isEmpty()
        ok_structure = structure.first()["passed"]
        _print({"labels": _rows(labels), "structure": _rows(structure)[0],
                "passed": ok_labels and ok_structure})
        return 0 if ok_labels and ok_structure else 1
    elif args.command == "export":
        _print(_rows(M.export_tables(store, SnapshotStore(spark, args.target))))
    elif args.command == "warehouse":
        day = dt.date.fromisoformat(args.date) if args.date else dt.datetime.now(dt.timezone.utc).date()
        _print(_rows(M.warehouse_export(store, SnapshotStore(spark, args.target), day)))
    elif args.command == "retain":
        run_id = args.run_id or f"manual-{uuid.uuid4()}"
        _print({"run_id": run_id, "audit": _rows(M.retention_apply(store, run_id))})
    elif args.command == "publish":
        _print(_rows(M.publish_manifest(store, args.run_id)))
    elif args.command == "evolve":
        demo = SnapshotStore(spark, args.demo_root)
        EV.seed_copy(store, demo)
        info = EV.column_evolution(demo, "network_events", store.read("network_events"))
        check = _rows(EV.evolution_check(demo, "network_events", info["before_version"]))[0]
        _print({**info, **check})
        return 0 if check["passed"] else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
