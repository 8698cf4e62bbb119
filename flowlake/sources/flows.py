"""Raw flow records derived from the driver's tables.

There are no flow-meter captures in the test data, so raw flows are a
projection of ``events`` (or, for bench-size runs, of ``lineitem``) with
the flow-meter header names, text timestamps in the four accepted
formats and deterministic dirt (non-finite rates, padded, blank, null and
stray-header labels, missing source IPs, unparseable times).  Every input
row becomes one raw flow row; nothing is dropped or sampled here.

``events``:  flow duration = event_id, source IP = user_id, label =
event_type with ``view`` as the benign label, rate = value, fwd bytes =
props.k, bwd bytes = floor(value), capture file named by the weekday.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.operators.clean import SOURCE_FILE

# Raw header names as written by the flow meter (leading space).
H_DURATION = " Flow Duration"
H_SOURCE_IP = " Source IP"
H_TIMESTAMP = " Timestamp"
H_RATE = " Flow Packets/s"
H_FWD = " Total Length of Fwd Packets"
H_BWD = " Total Length of Bwd Packets"
H_LABEL = " Label"

# Dirt is keyed on the row id so both the Spark build and the SQL oracle
# produce it identically (prime moduli; first matching rule wins).
INF_EVERY, NAN_EVERY, NEG_INF_EVERY = 97, 89, 83
STRAY_EVERY, NULL_LABEL_EVERY, BLANK_EVERY, PAD_EVERY = 101, 103, 107, 7
NO_IP_EVERY = 61
BAD_TIME_EVERY = 53
BAD_TIME_TEXT = "not a time"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dirty_rate(rid: Column, rate: Column) -> Column:
    return (
        F.when(rid % INF_EVERY == 0, F.lit(float("inf")))
        .when(rid % NAN_EVERY == 0, F.lit(float("nan")))
        .when(rid % NEG_INF_EVERY == 0, F.lit(float("-inf")))
        .otherwise(rate.cast("double"))
    )


def _dirty_label(rid: Column, label: Column) -> Column:
    return (
        F.when(rid % STRAY_EVERY == 0, F.lit(H_LABEL))
        .when(rid % NULL_LABEL_EVERY == 0, F.lit(None).cast("string"))
        .when(rid % BLANK_EVERY == 0, F.lit("  "))
        .when(rid % PAD_EVERY == 0, F.concat(F.lit(" "), label, F.lit(" ")))
        .otherwise(label)
    )


def _time_text(rid: Column, ts: Column) -> Column:
    """One of the four accepted formats, chosen by row id; some junk."""
    return (
        F.when(rid % BAD_TIME_EVERY == 0, F.lit(BAD_TIME_TEXT))
        .when(rid % 4 == 0, F.date_format(ts, "d/M/yyyy H:mm"))
        .when(rid % 4 == 1, F.date_format(ts, "d/M/yyyy H:mm:ss"))
        .when(rid % 4 == 2, F.date_format(ts, "M/d/yyyy h:mm:ss a"))
        .otherwise(F.date_format(ts, "M/d/yyyy H:mm"))
    )


def capture_file(ts: Column) -> Column:
    return F.concat(F.lit("file:///data/raw/"), F.date_format(ts, "EEEE"),
                    F.lit("-capture.csv"))


def events_raw_flows(events: DataFrame) -> DataFrame:
    rid = F.col("event_id")
    label = F.when(F.col("event_type") == "view", F.lit("BENIGN")).otherwise(F.col("event_type"))
    return events.select(
        rid.alias(H_DURATION),
        F.when(rid % NO_IP_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.col("user_id").cast("string")).alias(H_SOURCE_IP),
        _time_text(rid, F.col("ts")).alias(H_TIMESTAMP),
        _dirty_rate(rid, F.col("value")).alias(H_RATE),
        F.get_json_object("props", "$.k").cast("bigint").alias(H_FWD),
        F.floor("value").cast("bigint").alias(H_BWD),
        _dirty_label(rid, label).alias(H_LABEL),
        capture_file(F.col("ts")).alias(SOURCE_FILE),
    )


def lineitem_raw_flows(lineitem: DataFrame) -> DataFrame:
    """Bench-size flows: one row per lineitem (N = benign)."""
    rid = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    label = F.when(F.col("l_returnflag") == "N", F.lit("BENIGN")).otherwise(F.col("l_returnflag"))
    return lineitem.select(
        rid.alias(H_DURATION),
        F.col("l_suppkey").cast("string").alias(H_SOURCE_IP),
        _time_text(rid, F.col("l_shipdate")).alias(H_TIMESTAMP),
        _dirty_rate(rid, F.col("l_extendedprice")).alias(H_RATE),
        F.col("l_quantity").cast("bigint").alias(H_FWD),
        F.col("l_partkey").alias(H_BWD),
        label.alias(H_LABEL),
        capture_file(F.col("l_shipdate")).alias(SOURCE_FILE),
    )


def raw_flows(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    if source == "events":
        return events_raw_flows(table(spark, sf_dir, "events"))
    if source == "lineitem":
        return lineitem_raw_flows(table(spark, sf_dir, "lineitem"))
    raise ValueError(f"unknown flow source {source!r}")
