"""Queries over the cleaned fact: projections, filters, aggregates, sorts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.functions import cleaning as C
from flowlake.operators import aggregates as A
from flowlake.operators import clean as K
from flowlake.operators.quantile import exact_percentile_frame
from flowlake.operators.reconcile import except_all_both_ways
from flowlake.plans.facts import flows_fact, prepared_raw
from flowlake.plans.oracle import with_ctes
from flowlake.plans.registry import register

RATE = "Flow_Packets/s"
DURATION = "Flow_Duration"


# --- aggregates --------------------------------------------------------------

@register("label_counts", with_ctes("label_counts", body="SELECT * FROM label_counts"))
def q_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = flows_fact(spark, sf_dir)
    return A.label_counts(fact)


@register("src_ip_window_counts", with_ctes("windows", body="SELECT * FROM windows"))
def q_src_ip_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, cols = flows_fact(spark, sf_dir)
    return A.src_ip_window_counts(fact, cols)


@register("anomaly_threshold_counts", with_ctes("anomaly", body="SELECT * FROM anomaly"))
def q_anomaly_threshold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, cols = flows_fact(spark, sf_dir)
    return A.anomaly_threshold_counts(fact, cols)


@register("exact_quantile", with_ctes(
    "threshold", body="SELECT t AS p99_packets_per_sec FROM threshold"))
def q_exact_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, cols = flows_fact(spark, sf_dir)
    frame = exact_percentile_frame(A.benign_rates(fact, RATE), RATE, 0.99)
    return frame.select(F.col("value").alias("p99_packets_per_sec"))


@register("threshold_cross_join", with_ctes("anomaly", body="SELECT * FROM anomaly"))
def q_threshold_cross_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, cols = flows_fact(spark, sf_dir)
    threshold = exact_percentile_frame(A.benign_rates(fact, RATE), RATE, 0.99)
    return A.threshold_subquery_counts(fact, cols, threshold)


@register("conditional_sum", with_ctes("fact", body="""
SELECT event_date, count(*) AS flow_count,
       CAST(count_if(attack_category = 'ATTACK') AS BIGINT) AS attack_flow_count
FROM fact GROUP BY event_date"""))
def q_conditional_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = flows_fact(spark, sf_dir)
    return fact.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("flow_count"),
        A.attack_flag_sum().alias("attack_flow_count"),
    )


@register("row_count", with_ctes("fact", body="SELECT count(*) AS row_count FROM fact"))
def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = flows_fact(spark, sf_dir)
    return A.row_count(fact)


@register("label_totals", with_ctes("fact", body="""
SELECT label, count(*) AS flow_count FROM fact GROUP BY label"""))
def q_label_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = flows_fact(spark, sf_dir)
    return A.label_totals(fact)


@register("ip_totals", with_ctes("windows", body="""
SELECT source_ip, CAST(sum(flow_count) AS BIGINT) AS flow_count,
       CAST(sum(total_bytes) AS BIGINT) AS total_bytes,
       CAST(sum(attack_flow_count) AS BIGINT) AS attack_flow_count
FROM windows GROUP BY source_ip"""))
def q_ip_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, cols = flows_fact(spark, sf_dir)
    return A.ip_totals(A.src_ip_window_counts(fact, cols))


@register("null_split_counts", with_ctes("fact", body="""
SELECT CAST(count_if("Flow_Packets/s" IS NULL) AS BIGINT) AS null_rows,
       count("Flow_Packets/s") AS non_null_rows FROM fact"""))
def q_null_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = flows_fact(spark, sf_dir)
    return A.null_split_counts(fact, RATE)


# --- projections / filters ---------------------------------------------------

@register("trim_label", with_ctes("parsed", body="""
SELECT "Flow_Duration", label FROM parsed"""))
def q_trim_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, cols = prepared_raw(spark, sf_dir)
    return raw.select(DURATION, K.trimmed_label(raw, cols).alias("label"))


@register("drop_stray_headers", with_ctes("parsed", body="""
SELECT "Flow_Duration", label FROM parsed WHERE label IS NOT NULL AND label <> 'Label'"""))
def q_drop_stray_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, cols = prepared_raw(spark, sf_dir)
    label = K.trimmed_label(raw, cols)
    return raw.where(K.keep_labelled(label)).select(DURATION, label.alias("label"))


@register("nonfinite_to_null", with_ctes("parsed", body="""
SELECT "Flow_Duration", "Flow_Packets/s" FROM parsed"""))
def q_nonfinite_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, cols = prepared_raw(spark, sf_dir)
    return raw.select(DURATION, C.nonfinite_to_null(F.col(RATE)).alias(RATE))


@register("date_from_filename", with_ctes("parsed", body="""
SELECT "Flow_Duration", _source_file, file_date AS filename_date FROM parsed"""))
def q_date_from_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, _ = prepared_raw(spark, sf_dir)
    return raw.select(DURATION, K.SOURCE_FILE, K.filename_date(raw).alias("filename_date"))


@register("parse_timestamp_multi", with_ctes("parsed", body="""
SELECT "Flow_Duration", "Timestamp", event_time FROM parsed"""))
def q_parse_timestamp_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, cols = prepared_raw(spark, sf_dir)
    return raw.select(DURATION, "Timestamp", K.event_time(raw, cols).alias("event_time"))


@register("event_date", with_ctes("parsed", body="""
SELECT "Flow_Duration", event_time,
       coalesce(CAST(event_time AS DATE), file_date) AS event_date FROM parsed"""))
def q_event_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, cols = prepared_raw(spark, sf_dir)
    ts = K.event_time(raw, cols)
    return raw.select(DURATION, ts.alias("event_time"),
                      F.coalesce(F.to_date(ts), K.filename_date(raw)).alias("event_date"))


@register("attack_category", with_ctes("parsed", body="""
SELECT "Flow_Duration", label,
       CASE WHEN upper(label) = 'BENIGN' THEN 'BENIGN' ELSE 'ATTACK' END AS attack_category
FROM parsed WHERE label IS NOT NULL AND label <> 'Label'"""))
def q_attack_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, cols = prepared_raw(spark, sf_dir)
    label = K.trimmed_label(raw, cols)
    return raw.where(K.keep_labelled(label)).select(
        DURATION, label.alias("label"), C.attack_category(label).alias("attack_category"))


@register("rename_label", with_ctes("anomaly", body="""
SELECT source_ip, label FROM anomaly"""))
def q_rename_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, cols = flows_fact(spark, sf_dir)
    return A.anomaly_threshold_counts(fact, cols).select("source_ip", "label")


@register("drop_undated", with_ctes("fact", body="SELECT * FROM fact"))
def q_drop_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = flows_fact(spark, sf_dir)
    return fact


NARROW = sorted({"event_date", "event_time", "label", "attack_category", "Source_IP",
                 RATE, "Total_Length_of_Fwd_Packets", "Total_Length_of_Bwd_Packets"})


@register("narrow_projection", with_ctes("fact", body="SELECT " + ", ".join(
    f'"{c}"' for c in NARROW) + " FROM fact"))
def q_narrow_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = flows_fact(spark, sf_dir)
    return fact.select(*NARROW)


@register("flow_bytes", with_ctes("fact", body="""
SELECT "Flow_Duration", "Total_Length_of_Fwd_Packets" + "Total_Length_of_Bwd_Packets" AS flow_bytes
FROM fact"""))
def q_flow_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, cols = flows_fact(spark, sf_dir)
    return fact.select(DURATION, C.flow_bytes(F.col(cols["total_len_fwd_packets"]),
                                              F.col(cols["total_len_bwd_packets"])).alias("flow_bytes"))


@register("anomaly_filter", with_ctes("threshold", body="""
SELECT "Flow_Duration", label, "Flow_Packets/s" FROM fact
WHERE "Flow_Packets/s" > (SELECT t FROM threshold)"""))
def q_anomaly_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, cols = flows_fact(spark, sf_dir)
    t = A.anomaly_threshold(fact, cols)
    return A.anomaly_filter(fact, RATE, t).select(DURATION, "label", RATE)


@register("timed_rows", with_ctes("fact", body="""
SELECT "Flow_Duration", event_time FROM fact WHERE event_time IS NOT NULL"""))
def q_timed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = flows_fact(spark, sf_dir)
    return A.timed_rows(fact).select(DURATION, "event_time")


@register("flatten_window", with_ctes("fact", body="""
SELECT "Flow_Duration", time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end,
       CAST(time_bucket(INTERVAL 5 MINUTE, event_time) AS DATE) AS window_date
FROM fact WHERE event_time IS NOT NULL"""))
def q_flatten_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = flows_fact(spark, sf_dir)
    rows = A.timed_rows(fact).select(DURATION, F.window("event_time", A.WINDOW).alias("window"))
    return A.flatten_window(rows)


@register("constant_column", with_ctes("fact", body="""
SELECT "Flow_Duration", label, CAST(0.87 AS DOUBLE) AS threat_intel_score FROM fact"""))
def q_constant_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = flows_fact(spark, sf_dir)
    return fact.select(DURATION, "label", F.lit(0.87).cast("double").alias("threat_intel_score"))


@register("align_columns", with_ctes("label_counts", body="""
SELECT event_date, label, attack_category, flow_count FROM label_counts"""))
def q_align_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = flows_fact(spark, sf_dir)
    source = A.label_counts(fact)
    shuffled = source.select(*reversed(source.columns))
    return shuffled.select(*source.columns)


# --- sorts, limits, set operations -------------------------------------------

@register("top_n_ordered", with_ctes("fact", body="""
SELECT "Flow_Duration", event_date, label FROM fact
ORDER BY event_date, label, "Flow_Duration" LIMIT 3"""))
def q_top_n_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = flows_fact(spark, sf_dir)
    return fact.orderBy("event_date", "label", DURATION).limit(3).select(
        DURATION, "event_date", "label")


@register("limit_n", with_ctes("fact", body="""
SELECT "Flow_Duration", label FROM fact ORDER BY "Flow_Duration" LIMIT 3"""))
def q_limit_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = flows_fact(spark, sf_dir)
    return fact.orderBy(DURATION).limit(3).select(DURATION, "label")


@register("except_all_both_ways", with_ctes("fact", extra="""
kept AS (SELECT event_date, label FROM fact),
timed AS (SELECT CAST(event_time AS DATE) AS event_date, label FROM parsed
          WHERE label IS NOT NULL AND label <> 'Label' AND event_time IS NOT NULL)""", body="""
SELECT 'left' AS side, * FROM (SELECT * FROM kept EXCEPT ALL SELECT * FROM timed)
UNION ALL
SELECT 'right' AS side, * FROM (SELECT * FROM timed EXCEPT ALL SELECT * FROM kept)"""))
def q_except_all_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_date, label) rows, many of them alike: the fact against its timed rows."""
    fact, _ = flows_fact(spark, sf_dir)
    raw, cols = prepared_raw(spark, sf_dir)
    label, ts = K.trimmed_label(raw, cols), K.event_time(raw, cols)
    timed = (raw.where(K.keep_labelled(label) & ts.isNotNull())
             .select(F.to_date(ts).alias("event_date"), label.alias("label")))
    return except_all_both_ways(fact.select("event_date", "label"), timed)
