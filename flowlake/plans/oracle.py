"""Independent DuckDB SQL for every named query (the correctness oracle).

Written from the documented semantics, not generated from the Spark code.
The base CTEs rebuild the raw flows and the cleaned fact straight from the
``events`` table with DuckDB functions.
"""

from __future__ import annotations

RAW = r"""
raw AS (
  SELECT
    event_id AS "Flow_Duration",
    CASE WHEN event_id % 61 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS "Source_IP",
    CASE WHEN event_id % 53 = 0 THEN 'not a time'
         WHEN event_id % 4 = 0 THEN strftime(ts, '%-d/%-m/%Y %-H:%M')
         WHEN event_id % 4 = 1 THEN strftime(ts, '%-d/%-m/%Y %-H:%M:%S')
         WHEN event_id % 4 = 2 THEN strftime(ts, '%-m/%-d/%Y %-I:%M:%S %p')
         ELSE strftime(ts, '%-m/%-d/%Y %-H:%M') END AS "Timestamp",
    CASE WHEN event_id % 97 = 0 THEN 'Infinity'::DOUBLE
         WHEN event_id % 89 = 0 THEN 'NaN'::DOUBLE
         WHEN event_id % 83 = 0 THEN '-Infinity'::DOUBLE
         ELSE value END AS rate_raw,
    CAST(props->>'$.k' AS BIGINT) AS "Total_Length_of_Fwd_Packets",
    CAST(floor(value) AS BIGINT) AS "Total_Length_of_Bwd_Packets",
    CASE WHEN event_id % 101 = 0 THEN ' Label'
         WHEN event_id % 103 = 0 THEN NULL
         WHEN event_id % 107 = 0 THEN '  '
         WHEN event_id % 7 = 0 THEN ' ' || base_label || ' '
         ELSE base_label END AS label_raw,
    'file:///data/raw/' || strftime(ts, '%A') || '-capture.csv' AS _source_file
  FROM (SELECT *, CASE WHEN event_type = 'view' THEN 'BENIGN' ELSE event_type END AS base_label
        FROM events)
)"""

PARSED = r"""
parsed AS (
  SELECT *,
    trim(label_raw) AS label,
    CASE WHEN isnan(rate_raw) OR isinf(rate_raw) THEN NULL ELSE rate_raw END AS "Flow_Packets/s",
    coalesce(try_strptime("Timestamp", '%-d/%-m/%Y %-H:%M'),
             try_strptime("Timestamp", '%-d/%-m/%Y %-H:%M:%S'),
             try_strptime("Timestamp", '%-m/%-d/%Y %-I:%M:%S %p'),
             try_strptime("Timestamp", '%-m/%-d/%Y %-H:%M')) AS event_time,
    CASE WHEN lower(_source_file) LIKE '%friday%' THEN DATE '2017-07-07'
         WHEN lower(_source_file) LIKE '%thursday%' THEN DATE '2017-07-06'
         WHEN lower(_source_file) LIKE '%wednesday%' THEN DATE '2017-07-05'
         WHEN lower(_source_file) LIKE '%tuesday%' THEN DATE '2017-07-04'
         WHEN lower(_source_file) LIKE '%monday%' THEN DATE '2017-07-03'
    END AS file_date
  FROM raw
)"""

FACT = r"""
fact AS (
  SELECT "Flow_Duration", "Source_IP", "Timestamp", "Flow_Packets/s",
         "Total_Length_of_Fwd_Packets", "Total_Length_of_Bwd_Packets",
         label, _source_file, event_time,
         coalesce(CAST(event_time AS DATE), file_date) AS event_date,
         CASE WHEN upper(label) = 'BENIGN' THEN 'BENIGN' ELSE 'ATTACK' END AS attack_category
  FROM parsed
  WHERE label IS NOT NULL AND label <> 'Label'
    AND coalesce(CAST(event_time AS DATE), file_date) IS NOT NULL
)"""

THRESHOLD = r"""
threshold AS (
  SELECT quantile_disc("Flow_Packets/s", 0.99) AS t
  FROM fact WHERE attack_category = 'BENIGN' AND "Flow_Packets/s" IS NOT NULL
)"""

LABEL_COUNTS = r"""
label_counts AS (
  SELECT event_date, label, attack_category, count(*) AS flow_count
  FROM fact GROUP BY event_date, label, attack_category
)"""

WINDOWS = r"""
windows AS (
  SELECT "Source_IP" AS source_ip, label,
         time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
         time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end,
         count(*) AS flow_count,
         CAST(sum("Total_Length_of_Fwd_Packets" + "Total_Length_of_Bwd_Packets") AS BIGINT) AS total_bytes,
         CAST(count_if(attack_category = 'ATTACK') AS BIGINT) AS attack_flow_count,
         CAST(time_bucket(INTERVAL 5 MINUTE, event_time) AS DATE) AS window_date
  FROM fact WHERE event_time IS NOT NULL
  GROUP BY ALL
)"""

ANOMALY = r"""
anomaly AS (
  SELECT event_date, "Source_IP" AS source_ip, label,
         count(*) AS anomalous_flow_count,
         (SELECT t FROM threshold) AS threshold_packets_per_sec
  FROM fact WHERE "Flow_Packets/s" > (SELECT t FROM threshold)
  GROUP BY event_date, "Source_IP", label
)"""

_CTES = {
    "raw": RAW, "parsed": PARSED, "fact": FACT, "threshold": THRESHOLD,
    "label_counts": LABEL_COUNTS, "windows": WINDOWS, "anomaly": ANOMALY,
}
_ORDER = ["raw", "parsed", "fact", "threshold", "label_counts", "windows", "anomaly"]


def with_ctes(*names: str, body: str, extra: str | None = None) -> str:
    """Prefix ``body`` with the named CTEs, everything they depend on and
    ``extra`` (more ``name AS (...)`` definitions)."""
    needed = set(names)
    deps = {"parsed": {"raw"}, "fact": {"parsed"}, "threshold": {"fact"},
            "label_counts": {"fact"}, "windows": {"fact"}, "anomaly": {"threshold", "fact"}}
    changed = True
    while changed:
        changed = False
        for n in list(needed):
            for d in deps.get(n, ()):
                if d not in needed:
                    needed.add(d)
                    changed = True
    parts = [_CTES[n] for n in _ORDER if n in needed]
    if extra:
        parts.append("\n" + extra)
    return "WITH " + ",".join(parts) + "\n" + body
