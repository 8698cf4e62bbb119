"""Aggregate tables over the cleaned fact.

Every aggregate is a ``groupBy().agg()`` over a handful of columns, so
Spark plans partial (map-side) aggregation before the shuffle: a hot key
that holds a third of all rows still sends one partial row per map task
and group, never its raw rows.  The anomaly threshold is a literal in the
plan, so ``rate > t`` reaches the Parquet scan as a pushed filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions import cleaning as C
from flowlake.operators.quantile import exact_percentile

WINDOW = "5 minutes"
THRESHOLD_PERCENTILE = 0.99


#: What each aggregate reads: fact columns, and canonical columns where the input has them.
READS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "label_counts": (("event_date", "label", "attack_category"), ()),
    "src_ip_window_counts": (("event_time", "label", "attack_category"),
                             ("source_ip", "total_len_fwd_packets", "total_len_bwd_packets")),
    "anomaly_threshold_counts": (("event_date", "label", "attack_category"), ("source_ip", "flow_packets_per_sec")),
}


def columns_read(cols: dict[str, str]) -> list[str]:
    """The fact columns that the aggregates read, in name order."""
    names = {name for fixed, _ in READS.values() for name in fixed}
    return sorted(names | {cols[c] for _, optional in READS.values() for c in optional if c in cols})


def label_counts(fact: DataFrame) -> DataFrame:
    """A1: flows per (event_date, label, attack_category)."""
    return fact.groupBy("event_date", "label", "attack_category").agg(
        F.count(F.lit(1)).alias("flow_count")
    )


def attack_flag_sum(category: Column | str = "attack_category") -> Column:
    """A5: number of ATTACK rows in the group, as bigint."""
    c = F.col(category) if isinstance(category, str) else category
    return F.count_if(c == F.lit(C.ATTACK)).cast("bigint")


def timed_rows(fact: DataFrame) -> DataFrame:
    """Rows that carry an event time."""
    return fact.where(F.col("event_time").isNotNull())


def flatten_window(windowed: DataFrame, window_col: str = "window") -> DataFrame:
    """Window struct -> window_start / window_end (+ window_date)."""
    rest = [c for c in windowed.columns if c != window_col]
    return windowed.select(
        *rest,
        F.col(f"{window_col}.start").alias("window_start"),
        F.col(f"{window_col}.end").alias("window_end"),
    ).withColumn("window_date", F.to_date("window_start"))


def src_ip_window_counts(fact: DataFrame, cols: dict[str, str]) -> DataFrame | None:
    """A2: per (source_ip, label, 5-minute tumbling window): flows, bytes, attacks.

    ``None`` when the input has no source-IP column (optional table)."""
    if "source_ip" not in cols:
        return None
    fwd = F.col(cols["total_len_fwd_packets"]) if "total_len_fwd_packets" in cols else None
    bwd = F.col(cols["total_len_bwd_packets"]) if "total_len_bwd_packets" in cols else None
    windowed = (
        timed_rows(fact)
        .groupBy(
            F.col(cols["source_ip"]).alias("source_ip"),
            "label",
            F.window("event_time", WINDOW).alias("window"),
        )
        .agg(
            F.count(F.lit(1)).alias("flow_count"),
            F.sum(C.flow_bytes(fwd, bwd)).alias("total_bytes"),
            attack_flag_sum().alias("attack_flow_count"),
        )
    )
    out = flatten_window(windowed)
    return out.select(
        "source_ip", "label", "window_start", "window_end",
        "flow_count", "total_bytes", "attack_flow_count", "window_date",
    )


def benign_rates(fact: DataFrame, rate_col: str) -> DataFrame:
    """Rates of benign flows; the category filter prunes fact partitions."""
    return fact.where(F.col("attack_category") == F.lit(C.BENIGN)).select(rate_col)


def anomaly_threshold(fact: DataFrame, cols: dict[str, str],
                      p: float = THRESHOLD_PERCENTILE) -> float | None:
    """A4 applied: exact p-th percentile of benign rates over the whole fact."""
    if "flow_packets_per_sec" not in cols:
        return None
    rate = cols["flow_packets_per_sec"]
    return exact_percentile(benign_rates(fact, rate), rate, p)


def anomaly_filter(fact: DataFrame, rate_col: str, threshold) -> DataFrame:
    """Strictly above the threshold; a null rate is never flagged."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return fact.where(F.col(rate_col) > t)


def anomaly_threshold_counts(fact: DataFrame, cols: dict[str, str],
                             threshold: float | None = None) -> DataFrame | None:
    """A3: flagged flows per (event_date[, source_ip], label) plus the threshold.

    ``None`` when there is no rate column or no finite benign rate."""
    if "flow_packets_per_sec" not in cols:
        return None
    if threshold is None:
        threshold = anomaly_threshold(fact, cols)
        if threshold is None:
            return None
    rate = cols["flow_packets_per_sec"]
    keys = [F.col("event_date")]
    if "source_ip" in cols:
        keys.append(F.col(cols["source_ip"]).alias("source_ip"))
    keys.append(F.col("label"))
    return (
        anomaly_filter(fact, rate, threshold)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("anomalous_flow_count"),
        )
        .withColumn("threshold_packets_per_sec", F.lit(float(threshold)))
    )


def threshold_subquery_counts(fact: DataFrame, cols: dict[str, str],
                              threshold_df: DataFrame) -> DataFrame:
    """The same counts with the threshold as a scalar subquery.

    One lazy plan, no cross join: Spark evaluates the one-row subquery once
    and uses the value in the filter of every task."""
    rate = cols["flow_packets_per_sec"]
    t = threshold_df.select(F.col(threshold_df.columns[0]).cast("double")).scalar()
    keys = [F.col("event_date")]
    if "source_ip" in cols:
        keys.append(F.col(cols["source_ip"]).alias("source_ip"))
    keys.append(F.col("label"))
    return (
        fact.where(F.col(rate) > t)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("anomalous_flow_count"),
             F.max(t).alias("threshold_packets_per_sec"))
    )


def row_count(df: DataFrame) -> DataFrame:
    """A6 as a one-row DataFrame (no driver round trip)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def label_totals(fact: DataFrame) -> DataFrame:
    """Rows per label."""
    return fact.groupBy("label").agg(F.count(F.lit(1)).alias("flow_count"))


def ip_totals(window_counts: DataFrame) -> DataFrame:
    """A10: per source IP totals rolled up from the window table."""
    return window_counts.groupBy("source_ip").agg(
        F.sum("flow_count").alias("flow_count"),
        F.sum("total_bytes").alias("total_bytes"),
        F.sum("attack_flow_count").alias("attack_flow_count"),
    )


def null_split_counts(df: DataFrame, column: str) -> DataFrame:
    """P20: null vs non-null rows of one column in a single pass."""
    return df.agg(
        F.count_if(F.col(column).isNull()).cast("bigint").alias("null_rows"),
        F.count(F.col(column)).alias("non_null_rows"),
    )
