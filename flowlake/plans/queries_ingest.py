"""Queries over raw CSV files: scan, lineage, headers, line counts, recounts.

The driver's tables hold no CSV, so the raw flows of ``events`` are first
written as CSV (flow-meter headers with their leading spaces, one folder
per capture file) to a fresh folder under the shared work root; the
queries then read those files like real captures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.functions.columns import (
    REQUIRED_COLUMNS, prepare_columns, require_columns, resolve_aliases, sanitize_names, strip_headers,
)
from flowlake.operators.clean import SOURCE_FILE, clean, fact_columns
from flowlake.operators import validate as V
from flowlake.plans.oracle import with_ctes
from flowlake.plans.registry import register
from flowlake.session import configure, scratch_path
from flowlake.sources import csv as S
from flowlake.sources.captures import by_file, captures
from flowlake.sources.flows import raw_flows

_WRITTEN: dict[tuple[str, str], str] = {}


def write_flows_csv(raw: DataFrame, path: str) -> str:
    """Write raw flows as CSV captures: folder ``capture=<file name>``."""
    capture = F.regexp_extract(F.col(SOURCE_FILE), r"([^/]+)$", 1)
    (
        raw.withColumn("capture", capture).drop(SOURCE_FILE)
        .hint("rebalance", "capture")  # a hot capture is split, not one task
        .write.mode("errorifexists")
        .partitionBy("capture")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def flows_csv(spark: SparkSession, sf_dir: str) -> str:
    """Glob of the CSV captures for ``sf_dir`` (written once per application)."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        path = scratch_path(spark, "flows-csv")
        write_flows_csv(raw_flows(spark, sf_dir), path)
        _WRITTEN[key] = path
    return _WRITTEN[key] + "/*/*.csv"


def csv_fact(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, str]]:
    raw = S.csv_scan(spark, flows_csv(spark, sf_dir))
    df, cols = prepare_columns(raw)
    return clean(df, cols), fact_columns(cols)


RAW_CSV_SQL = with_ctes("raw", body="""
SELECT "Flow_Duration" AS "Flow Duration", "Source_IP" AS "Source IP", "Timestamp",
       rate_raw AS "Flow Packets/s",
       "Total_Length_of_Fwd_Packets" AS "Total Length of Fwd Packets",
       "Total_Length_of_Bwd_Packets" AS "Total Length of Bwd Packets",
       label_raw AS "Label"
FROM raw""")


@register("csv_scan", RAW_CSV_SQL)
def q_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.csv_scan(spark, flows_csv(spark, sf_dir))
    return raw.drop(SOURCE_FILE)


@register("source_lineage", with_ctes("raw", body="""
SELECT "Flow_Duration", regexp_extract(_source_file, '([^/]+)$', 1) AS source_name FROM raw"""))
def q_source_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per row, the capture it came from, taken from the decoded file path."""
    raw = S.csv_scan(spark, flows_csv(spark, sf_dir))
    return raw.select(F.col("Flow Duration").alias("Flow_Duration"),
                      V.source_name(F.col(SOURCE_FILE)).alias("source_name"))


@register("raw_line_count", with_ctes("raw", body="SELECT count(*) AS raw_rows FROM raw"))
def q_raw_line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.raw_line_count(spark, flows_csv(spark, sf_dir))


@register("smallest_file", with_ctes("raw", body="""
SELECT count(DISTINCT _source_file) AS captures, CAST(0 AS BIGINT) AS smaller_files, count(*) AS rows_of_its_kind
FROM raw"""))
def q_smallest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pick against the captures table: captures listed, files smaller than it, and the
    rows of all files with the pick's header (all share one)."""
    files = captures(spark, flows_csv(spark, sf_dir))
    pick = S.smallest_file(spark, flows_csv(spark, sf_dir))
    header = files.join(pick.select("file_path"), "file_path").select("header").scalar()
    alike = files.where(F.col("header") == header)
    counted = by_file(S.raw_line_counts(spark, flows_csv(spark, sf_dir)), alike)
    return files.agg(F.count_distinct("capture").alias("captures"),
                     F.count_if(F.col("file_size") < pick.select("file_size").scalar()).alias("smaller_files"),
                     ).withColumn("rows_of_its_kind", counted.agg(F.sum("raw_rows")).scalar())


def _header_rows(spark: SparkSession, sf_dir: str) -> list[str]:
    groups = S.header_groups(spark, flows_csv(spark, sf_dir))
    return S.parse_header(next(iter(groups)))


def _filled_cells(df: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    """A row per (name, what became of it): how many rows have a value there."""
    counts = df.agg(*[F.count(F.col(f"`{new}`")).alias(f"c{i}") for i, (_, new) in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(old).alias("raw_name"), F.lit(new).alias("name"),
                               F.col(f"c{i}").alias("non_null_rows")) for i, (old, new) in enumerate(names)])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def _filled_sql(rows: list[tuple[str, str, str]]) -> str:
    return with_ctes("raw", body="\nUNION ALL ".join(
        f"SELECT '{old}' AS raw_name, '{new}' AS name, count({cell}) AS non_null_rows FROM raw"
        for old, new, cell in rows))


#: header as written, stripped, and its cell in the oracle's raw rows.
_HEADERS = [(" Flow Duration", "Flow Duration", '"Flow_Duration"'), (" Source IP", "Source IP", '"Source_IP"'),
            (" Timestamp", "Timestamp", '"Timestamp"'), (" Flow Packets/s", "Flow Packets/s", "rate_raw"),
            (" Total Length of Fwd Packets", "Total Length of Fwd Packets", '"Total_Length_of_Fwd_Packets"'),
            (" Total Length of Bwd Packets", "Total Length of Bwd Packets", '"Total_Length_of_Bwd_Packets"'),
            (" Label", "Label", "label_raw")]


@register("strip_headers", _filled_sql(_HEADERS))
def q_strip_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_names = _header_rows(spark, sf_dir)
    text = S.read_text_columns(spark, flows_csv(spark, sf_dir))
    stripped = strip_headers(text.toDF(*(raw_names + [SOURCE_FILE])))
    return _filled_cells(stripped, list(zip(raw_names, stripped.columns)))


@register("resolve_aliases", with_ctes("parsed", body="""
SELECT "Flow_Duration" AS flow_duration, "Source_IP" AS source_ip, "Timestamp" AS timestamp,
       rate_raw AS flow_packets_per_sec,
       "Total_Length_of_Fwd_Packets" AS total_len_fwd_packets,
       "Total_Length_of_Bwd_Packets" AS total_len_bwd_packets, label_raw AS label
FROM parsed"""))
def q_resolve_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.csv_scan(spark, flows_csv(spark, sf_dir))
    cols = resolve_aliases(raw.columns)
    return raw.select(*[F.col(f"`{actual}`").alias(canonical) for canonical, actual in cols.items()])


@register("require_columns", _filled_sql([
    ("flow_duration", "Flow Duration", '"Flow_Duration"'), ("label", "Label", "label_raw")]))
def q_require_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The required columns, the header each was found under and its filled cells."""
    text = S.read_text_columns(spark, flows_csv(spark, sf_dir))
    cols = resolve_aliases(text.columns)
    require_columns(cols)
    return _filled_cells(text, [(c, cols[c]) for c in REQUIRED_COLUMNS]).select("raw_name", "name", "non_null_rows")


@register("sanitize_names", _filled_sql([
    (new, new.replace(" ", "_"), cell) for _, new, cell in _HEADERS]))
def q_sanitize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = S.read_text_columns(spark, flows_csv(spark, sf_dir)).drop(SOURCE_FILE)
    renamed, _ = sanitize_names(text, resolve_aliases(text.columns))
    return _filled_cells(renamed, list(zip(text.columns, renamed.columns)))


MONDAY_CAPTURE = "Monday-capture.csv"


@register("rows_of_source_file", with_ctes("fact", body="""
SELECT "Flow_Duration", label FROM fact
WHERE regexp_extract(_source_file, '([^/]+)$', 1) = 'Monday-capture.csv'"""))
def q_rows_of_source_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = csv_fact(spark, sf_dir)
    return S.rows_of_source_file(fact, MONDAY_CAPTURE).select("Flow_Duration", "label")


_RECOUNT = """
recount AS (
  SELECT regexp_extract(_source_file, '([^/]+)$', 1) AS source_name, label,
         count(*) AS raw_flow_count
  FROM parsed WHERE label IS NOT NULL AND label <> 'Label'
    AND (event_time IS NOT NULL OR file_date IS NOT NULL) GROUP BY ALL),
fact_counts AS (
  SELECT regexp_extract(_source_file, '([^/]+)$', 1) AS source_name, label,
         count(*) AS fact_flow_count
  FROM fact GROUP BY ALL)"""


@register("validate_labels", with_ctes("fact", extra=_RECOUNT, body="""
SELECT coalesce(r.source_name, f.source_name) AS source_name,
       coalesce(r.label, f.label) AS label,
       coalesce(r.raw_flow_count, 0) AS raw_flow_count,
       coalesce(f.fact_flow_count, 0) AS fact_flow_count,
       coalesce(r.raw_flow_count, 0) = coalesce(f.fact_flow_count, 0) AS match
FROM recount r FULL OUTER JOIN fact_counts f
  ON r.source_name = f.source_name AND r.label = f.label"""))
def q_validate_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = csv_fact(spark, sf_dir)
    return V.validate_labels(spark, flows_csv(spark, sf_dir), fact)


@register("reconcile_label_counts", with_ctes("fact", extra="""
recount AS (SELECT label, count(*) AS raw_flow_count FROM parsed
            WHERE label IS NOT NULL AND label <> 'Label'
              AND (event_time IS NOT NULL OR file_date IS NOT NULL) GROUP BY label),
fact_counts AS (SELECT label, count(*) AS fact_flow_count FROM fact GROUP BY label)""", body="""
SELECT coalesce(r.label, f.label) AS label,
       coalesce(r.raw_flow_count, 0) AS raw_flow_count,
       coalesce(f.fact_flow_count, 0) AS fact_flow_count,
       coalesce(r.raw_flow_count, 0) = coalesce(f.fact_flow_count, 0) AS match
FROM recount r FULL OUTER JOIN fact_counts f ON r.label = f.label"""))
def q_reconcile_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = csv_fact(spark, sf_dir)
    return V.reconcile_label_counts(spark, flows_csv(spark, sf_dir), fact)


@register("validate_structure", with_ctes("fact", body="""
SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM raw) AS records, count(*) AS cleaned_rows,
       count(*) <= (SELECT count(*) FROM raw) AS passed FROM fact"""))
def q_validate_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, _ = csv_fact(spark, sf_dir)
    return V.validate_structure(S.raw_record_count(spark, flows_csv(spark, sf_dir)), fact)


@register("raw_record_count", """
SELECT count(*) AS records, count(*) FILTER (text LIKE '%' || chr(10) || '%') > 0 AS more_lines FROM documents""")
def q_raw_record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of CSV files whose cells hold line feeds, quotes and commas: the documents' texts."""
    configure(spark)
    path = scratch_path(spark, "documents-csv")
    spark.read.parquet(f"{sf_dir}/documents.parquet").write.option("header", True).csv(path)
    counted = S.raw_record_count(spark, f"{path}/*.csv")
    return counted.select("records", (F.col("raw_rows") > F.col("records")).alias("more_lines"))
