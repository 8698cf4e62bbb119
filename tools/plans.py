"""Write the formatted physical plans of the headline queries to docs/PLANS.md.

Usage: python tools/plans.py [sf_dir]
Runs the transform into a scratch store first, so the aggregate plans are
the ones a consumer gets over the written fact snapshot.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from flowlake.operators import aggregates as A  # noqa: E402
from flowlake.operators import validate as V  # noqa: E402
from flowlake.operators.quantile import _band_key  # noqa: E402
from flowlake.plans.facts import build_fact  # noqa: E402
from flowlake.plans.queries_ingest import csv_fact, flows_csv  # noqa: E402
from flowlake.plans.transform import run_transform  # noqa: E402
from flowlake.session import configure, scratch_path  # noqa: E402
from flowlake.sources.flows import raw_flows  # noqa: E402
from flowlake.sources.snapshots import SnapshotStore  # noqa: E402

RATE = "Flow_Packets/s"


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = re.sub(r"Location: .*", "Location: <scratch>", buf.getvalue())
    text = re.sub(r"#\d+L?", "", text)
    return text.strip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    store = SnapshotStore(spark, scratch_path(spark, "plans"))
    run_transform(spark, raw_flows(spark, sf_dir), store)
    fact = store.read("network_events")
    _, cols = build_fact(raw_flows(spark, sf_dir))
    threshold = A.anomaly_threshold(fact, cols)
    csv_clean, _ = csv_fact(spark, sf_dir)
    sections = [
        ("Cleaning from CSV captures (one Project + Filter over the scan)", csv_clean),
        ("Fact write input: rows clustered by partition value (REBALANCE, AQE splits hot values)",
         csv_clean.hint("rebalance", "event_date", "attack_category")),
        ("label_counts over the fact snapshot", A.label_counts(fact)),
        ("src_ip_window_counts over the fact snapshot", A.src_ip_window_counts(fact, cols)),
        ("Benign rates for the exact percentile (partition pruning)", A.benign_rates(fact, RATE)),
        ("Exact percentile, pass 1: exact counts per magnitude band (partial aggregation)",
         A.benign_rates(fact, RATE).select(F.col(RATE).alias("x"))
         .groupBy(_band_key(F.col("x")).alias("key"))
         .agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi"))),
        (f"anomaly_threshold_counts (threshold {threshold} as a literal)",
         A.anomaly_threshold_counts(fact, cols, threshold)),
        ("validate_labels: raw-text recount full-outer-joined with the fact",
         V.validate_labels(spark, flows_csv(spark, sf_dir), csv_clean)),
    ]
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/plans.py` on `{Path(sf_dir).name}` (AQE initial plans; "
           "attribute ids and scratch paths removed).", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", formatted(df), "```", ""]
    (ROOT / "docs" / "PLANS.md").write_text("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
