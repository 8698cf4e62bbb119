"""Benchmark: the flow transform and its headline queries on the driver's data.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints one JSON line.  ``value`` is the sum of
the per-query wall times.  Each query is forced with a ``noop`` write (the
full plan runs, nothing is collected).  Setup that is not part of any
query (writing the raw flows out as CSV captures) is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from flowlake.operators import aggregates as A  # noqa: E402
from flowlake.operators import validate as V  # noqa: E402
from flowlake.operators.quantile import exact_percentile_frame  # noqa: E402
from flowlake.plans.facts import build_fact  # noqa: E402
from flowlake.plans.queries_ingest import write_flows_csv  # noqa: E402
from flowlake.plans.transform import run_transform  # noqa: E402
from flowlake.session import configure, scratch_path  # noqa: E402
from flowlake.sources import csv as S, fs  # noqa: E402
from flowlake.sources.flows import raw_flows  # noqa: E402
from flowlake.sources.snapshots import SnapshotStore  # noqa: E402

RATE = "Flow_Packets/s"
WIDE_TYPES = {f"Feature {i:02d}": "double" for i in range(76)}
#: Rows of the baseline's published run; ``BENCH_REFERENCE_ROWS=0`` leaves that run out.
REFERENCE_ROWS = int(os.environ.get("BENCH_REFERENCE_ROWS", "2830743"))


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("flowlake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * int(cpus))))
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="flowlake-bench-ckpt-"))
    return configure(spark)


def wide_flows(raw):
    """Raw flows plus 76 numeric feature columns derived from each row,
    giving the 83-column shape of flow-meter exports."""
    from pyspark.sql import functions as F
    rate, dur = F.col(" Flow Packets/s"), F.col(" Flow Duration")
    feats = [((rate * (i + 1) / 7) if i % 3 else (dur % (i + 11))).alias(f" Feature {i:02d}")
             for i in range(76)]
    return raw.select(*raw.columns, *feats)


def reference_flows(raw, rows):
    """Every raw flow in as many copies as reach ``rows``, with 76 feature columns as short as those of
    real captures (about 300 bytes a line)."""
    from pyspark.sql import functions as F
    copies = -(-rows // max(1, raw.count()))
    rate, dur, copy = F.col(" Flow Packets/s"), F.col(" Flow Duration"), F.col("copy")
    feats = [(F.round(rate * (i + 1) / 7, 1) if i % 8 == 0 else (dur + copy) % (i + 11)).alias(f" Feature {i:02d}")
             for i in range(76)]
    many = raw.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    return many.select(*raw.columns, *feats)


def reference_shape(spark, sf_dir: str, settings: list[tuple[str, dict[str, str]]]) -> dict:
    """The transform over captures of the baseline's rows and columns, once for each (cache mode, session
    settings): seconds, rows a second and stages."""
    path = write_flows_csv(reference_flows(raw_flows(spark, sf_dir, "events"), REFERENCE_ROWS),
                           scratch_path(spark, "bench-reference"))
    out: dict = {"columns": 7 + len(WIDE_TYPES), "bytes": sum(size for _, size in fs.glob_files(spark, f"{path}/*/*.csv")), "runs": {}}
    for mode, conf in settings:
        t0 = time.perf_counter()
        raw = S.csv_scan(spark, f"{path}/*/*.csv", types=WIDE_TYPES)
        report = run_transform(spark, raw, SnapshotStore(spark, scratch_path(spark, "bench-ref-store")),
                               cache_mode=mode, settings=conf, read_seconds=time.perf_counter() - t0)
        seconds = time.perf_counter() - t0
        rows = report.first()["cleaned_rows"]
        name = " ".join([mode, *(f"{k.removeprefix('spark.sql.')}={v}" for k, v in conf.items())])
        out["runs"][name] = {"sec": round(seconds, 3), "rows": rows, "rows_per_sec": round(rows / seconds, 1),
                             "stages": stages(report)}
    return out


def stages(report) -> dict[str, float]:
    return {k: round(v, 3) for k, v in sorted(report.first()["timings_seconds"].items())}


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # untimed setup: raw captures as CSV files and as Parquet
    line_csv = write_flows_csv(raw_flows(spark, sf_dir, "lineitem"), scratch_path(spark, "bench-li"))
    ev_csv = write_flows_csv(raw_flows(spark, sf_dir, "events"), scratch_path(spark, "bench-ev"))
    line_glob, ev_glob = f"{line_csv}/*/*.csv", f"{ev_csv}/*/*.csv"
    wide_csv = write_flows_csv(wide_flows(raw_flows(spark, sf_dir, "events")),
                               scratch_path(spark, "bench-wide"))
    wide_glob = f"{wide_csv}/*/*.csv"
    line_pq = scratch_path(spark, "bench-li-parquet")
    raw_flows(spark, sf_dir, "lineitem").write.parquet(line_pq)
    line_raw = spark.read.parquet(line_pq)
    line_rows = line_raw.count()

    # headline: CSV captures -> fact snapshot -> three aggregate snapshots
    store = SnapshotStore(spark, scratch_path(spark, "bench-store"))
    report = timed("transform_csv_events",
                   lambda: run_transform(spark, S.csv_scan(spark, ev_glob), store))
    rows = report.first()["cleaned_rows"]
    stages_events = stages(report)
    # the reference's capture shape: 83 columns, mostly numeric features
    report_wide = timed("transform_csv_events_wide", lambda: run_transform(
        spark, S.csv_scan(spark, wide_glob, types=WIDE_TYPES), SnapshotStore(spark, scratch_path(spark, "bench-w"))))
    stages_wide = stages(report_wide)
    timed("transform_parquet_events",
          lambda: run_transform(spark, raw_flows(spark, sf_dir, "events"),
                                SnapshotStore(spark, scratch_path(spark, "bench-store-pq")), cluster_fact=True))

    # compute on the larger lineitem flows, from the raw Parquet captures
    fact, cols = build_fact(line_raw)
    timed("clean_lineitem", lambda: run(fact))
    timed("label_counts_lineitem", lambda: run(A.label_counts(fact)))
    timed("src_ip_window_counts_lineitem", lambda: run(A.src_ip_window_counts(fact, cols)))
    timed("exact_quantile_lineitem",
          lambda: exact_percentile_frame(A.benign_rates(fact, RATE), RATE, 0.99).first())
    timed("anomaly_threshold_counts_lineitem",
          lambda: run(A.anomaly_threshold_counts(fact, cols)))
    timed("csv_scan_lineitem", lambda: run(S.csv_scan(spark, line_glob)))
    ev_clean, _ = build_fact(S.csv_scan(spark, ev_glob))
    timed("validate_labels_events", lambda: run(V.validate_labels(spark, ev_glob, ev_clean)))

    extra = {}
    if os.environ.get("BENCH_FULL") == "1":
        # lineitem ship dates span ~2,500 days: the day/category layout makes
        # this run write ~10k partition folders, so file creation dominates
        t0 = time.perf_counter()
        rep = run_transform(spark, line_raw, SnapshotStore(spark, scratch_path(spark, "bench-li-store")), cluster_fact=True)
        extra["transform_parquet_lineitem_sec"] = round(time.perf_counter() - t0, 3)
        extra["stages_transform_parquet_lineitem"] = stages(rep)
        # the published comparison: cache modes, adaptive execution off, twice the partitions
        twice = str(2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
        settings = [("none", {}), ("narrow", {}), ("full", {}),
                    ("narrow", {"spark.sql.adaptive.enabled": "false"}), ("narrow", {"spark.sql.shuffle.partitions": twice})]
    else:
        settings = [("none", {})]
    if REFERENCE_ROWS:
        extra["reference_shape"] = reference_shape(spark, sf_dir, settings)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "flow_transform_and_queries_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(Path(sf_dir).name.replace("sf", "") or 0),
        "cleaned_rows_events": rows,
        "stages_transform_csv_events": stages_events,
        "stages_transform_csv_events_wide": stages_wide,
        **extra,
        "rows_per_sec_transform_csv": round(rows / times["transform_csv_events"], 1),
        "raw_rows_lineitem": line_rows,
        "rows_per_sec_clean_lineitem": round(line_rows / times["clean_lineitem"], 1),
        "rows_per_sec_csv_scan_lineitem": round(line_rows / times["csv_scan_lineitem"], 1),
    }))


if __name__ == "__main__":
    main()
