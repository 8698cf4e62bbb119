"""Queries over versioned snapshot tables: writes, time travel, evolution,
retention, export and manifests.

Each query first runs the transform over the flows of ``events`` into a
fresh store under the shared work root (once per application and scale
factor); queries that change tables work on their own copy.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.operators import evolution as EV
from flowlake.operators import maintenance as M
from flowlake.operators.reconcile import fingerprint, multiset_equal, table_equality
from flowlake.plans.oracle import with_ctes
from flowlake.plans.registry import register
from flowlake.plans.transform import run_transform
from flowlake.session import configure, scratch_path
from flowlake.sources.flows import raw_flows
from flowlake.sources.snapshots import SnapshotStore

FACT_COLS = ('"Flow_Duration", "Source_IP", "Timestamp", "Flow_Packets/s", '
             '"Total_Length_of_Fwd_Packets", "Total_Length_of_Bwd_Packets", label, '
             '_source_file, event_time, event_date, attack_category')
TOP3 = ("(SELECT * FROM fact ORDER BY event_date, label, \"Flow_Duration\" LIMIT 3)")
COUNTS = """
counts AS (
  SELECT 'network_events' AS "table", (SELECT count(*) FROM fact) AS row_count
  UNION ALL SELECT 'label_counts', (SELECT count(*) FROM label_counts)
  UNION ALL SELECT 'src_ip_window_counts', (SELECT count(*) FROM windows)
  UNION ALL SELECT 'anomaly_threshold_counts', (SELECT count(*) FROM anomaly))"""


def _once(name: str):
    """Memoise a read-only fixture per (application, sf_dir)."""
    memo: dict = {}

    def wrap(fn):
        def inner(spark: SparkSession, sf_dir: str):
            key = (spark.sparkContext.applicationId, sf_dir)
            if key not in memo:
                memo[key] = fn(spark, sf_dir)
            return memo[key]
        inner.__name__ = name
        return inner
    return wrap


@_once("base")
def base(spark: SparkSession, sf_dir: str) -> tuple[SnapshotStore, DataFrame]:
    """Transform output for ``sf_dir`` (computed once per application)."""
    configure(spark)
    store = SnapshotStore(spark, scratch_path(spark, "warehouse")).namespace("security")
    report = run_transform(spark, raw_flows(spark, sf_dir), store)
    return store, report.cache()


def fresh(spark: SparkSession, name: str) -> SnapshotStore:
    return SnapshotStore(spark, scratch_path(spark, name))


def copy_of(spark: SparkSession, sf_dir: str, tables=("network_events",)) -> SnapshotStore:
    src, _ = base(spark, sf_dir)
    dst = fresh(spark, "copy")
    for t in tables:
        EV.seed_copy(src, dst, t)
    return dst


def fact_cols(df: DataFrame) -> DataFrame:
    return df.select("Flow_Duration", "Source_IP", "Timestamp", "Flow_Packets/s",
                     "Total_Length_of_Fwd_Packets", "Total_Length_of_Bwd_Packets", "label",
                     "_source_file", "event_time", "event_date", "attack_category")


# --- writes and reads --------------------------------------------------------

@register("partitioned_overwrite", with_ctes("fact", body=f"SELECT {FACT_COLS} FROM fact"))
def q_partitioned_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = base(spark, sf_dir)
    return fact_cols(store.read("network_events"))


@_once("label_versions")
def _label_versions(spark: SparkSession, sf_dir: str) -> SnapshotStore:
    """label_counts v0 = all rows, v1 = ATTACK rows only (overwrite)."""
    src, _ = base(spark, sf_dir)
    store = fresh(spark, "versions")
    lc = src.read("label_counts")
    store.overwrite("label_counts", lc, ["event_date"])
    store.overwrite("label_counts", lc.where(F.col("attack_category") == "ATTACK"), ["event_date"])
    return store


@register("snapshot_read_latest", with_ctes("label_counts", body="""
SELECT * FROM label_counts WHERE attack_category = 'ATTACK'"""))
def q_snapshot_read_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_versions(spark, sf_dir).read("label_counts")


@register("snapshot_read_version", with_ctes("label_counts", body="SELECT * FROM label_counts"))
def q_snapshot_read_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_versions(spark, sf_dir).read("label_counts", version=0)


@_once("evolved")
def _evolved(spark: SparkSession, sf_dir: str) -> tuple[SnapshotStore, dict]:
    src, _ = base(spark, sf_dir)
    demo = fresh(spark, "demo")
    EV.seed_copy(src, demo)
    info = EV.column_evolution(demo, "network_events", src.read("network_events"))
    return demo, info


@register("snapshot_read_id", with_ctes("fact", body=f"SELECT {FACT_COLS} FROM fact"))
def q_snapshot_read_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    demo, info = _evolved(spark, sf_dir)
    old = demo.read("network_events", snapshot_id=info["before_snapshot_id"])
    if EV.NEW_COLUMN in old.columns:
        raise AssertionError("snapshot read did not restore the historical schema")
    return fact_cols(old)


@register("table_scan", with_ctes("label_counts", body="SELECT * FROM label_counts"))
def q_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = base(spark, sf_dir)
    view = f"label_counts_{uuid.uuid4().hex[:8]}"
    store.read("label_counts").createOrReplaceTempView(view)
    return spark.table(view)


@register("snapshot_history")
def q_snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    demo, _ = _evolved(spark, sf_dir)
    return demo.history("network_events").select(
        "version", "committed_at", "operation", "snapshot_id", "row_count")


@register("required_tables_check", with_ctes("label_counts", "windows", "anomaly", extra=COUNTS, body="""
SELECT "table", "table" IN ('network_events', 'label_counts') AS required, true AS present, row_count FROM counts"""))
def q_required_tables_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = base(spark, sf_dir)
    M.require_tables(store)
    return M.table_presence(store).select("table", "required", "present", "row_count")


@_once("exported")
def _exported(spark: SparkSession, sf_dir: str) -> tuple[SnapshotStore, DataFrame, DataFrame]:
    src, _ = base(spark, sf_dir)
    target = fresh(spark, "export")
    first = M.export_tables(src, target).cache()
    second = M.export_tables(src, target).cache()
    return target, first, second


@register("pinned_export_scan", with_ctes("fact", body=f"SELECT {FACT_COLS} FROM fact"))
def q_pinned_export_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, _, _ = _exported(spark, sf_dir)
    return fact_cols(target.read("network_events"))


@register("create_or_replace", with_ctes("label_counts", body="SELECT * FROM label_counts"))
def q_create_or_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, _, _ = _exported(spark, sf_dir)
    return target.read("label_counts")


@register("create_table_as", with_ctes("label_counts", body="SELECT * FROM label_counts"))
def q_create_table_as(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, _ = base(spark, sf_dir)
    target = fresh(spark, "ctas")
    target.create("label_counts", src.read("label_counts"), ["event_date"])
    try:
        target.create("label_counts", src.read("label_counts"), ["event_date"])
        raise AssertionError("create over an existing table must fail")
    except FileExistsError:
        pass
    return target.read("label_counts")


@register("snapshot_history_rows", with_ctes("fact", body="""
SELECT CAST(0 AS BIGINT) AS version, 'CREATE' AS operation, count(*) AS row_count FROM fact
UNION ALL SELECT 1, 'ADD COLUMNS', count(*) FROM fact
UNION ALL SELECT 2, 'APPEND', count(*) + 3 FROM fact"""))
def q_snapshot_history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 without its times and ids, which differ from run to run."""
    demo, _ = _evolved(spark, sf_dir)
    return demo.history("network_events").select("version", "operation", "row_count")


@register("append_guard", with_ctes("fact", body="""
SELECT true AS blocked, count(*) AS rows_before, count(*) AS rows_after FROM fact"""))
def q_append_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    demo = copy_of(spark, sf_dir)
    batch = EV.ordered_batch(demo.read("network_events")).withColumn(
        EV.NEW_COLUMN, F.lit(0.87).cast("double"))
    before = demo.commit("network_events").row_count
    blocked = EV.append_guard(demo, "network_events", batch).first()["blocked"]
    return demo.read("network_events").agg(F.count(F.lit(1)).alias("rows_after")).select(
        F.lit(blocked).alias("blocked"), F.lit(before).cast("long").alias("rows_before"), "rows_after")


EVOLVED_SQL = with_ctes("fact", body=f"""
SELECT "Flow_Duration", label, event_date, CAST(NULL AS DOUBLE) AS threat_intel_score FROM fact
UNION ALL
SELECT "Flow_Duration", label, event_date, CAST({{score}} AS DOUBLE) FROM {TOP3}""")


@register("append_evolve", EVOLVED_SQL.replace("{score}", "0.87"))
def q_append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    demo = copy_of(spark, sf_dir)
    info = EV.merge_evolution(demo, "network_events", demo.read("network_events"))
    if not info["blocked"]:
        raise AssertionError("append without merge must be blocked")
    return demo.read("network_events").select("Flow_Duration", "label", "event_date",
                                              EV.NEW_COLUMN)


@register("add_column", EVOLVED_SQL.replace("{score}", "0.9"))
def q_add_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    demo, _ = _evolved(spark, sf_dir)
    return demo.read("network_events").select("Flow_Duration", "label", "event_date",
                                              EV.NEW_COLUMN)


@register("append_same", with_ctes("fact", body=f"""
SELECT "Flow_Duration", label, event_date FROM fact
UNION ALL SELECT "Flow_Duration", label, event_date FROM {TOP3}"""))
def q_append_same(spark: SparkSession, sf_dir: str) -> DataFrame:
    demo = copy_of(spark, sf_dir)
    demo.append("network_events", EV.ordered_batch(demo.read("network_events")))
    return demo.read("network_events").select("Flow_Duration", "label", "event_date")


@register("append_folded", with_ctes("windows", body="SELECT * FROM windows"))
def q_append_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window counts appended in twelve batches, folded as they come: few segments, the same rows."""
    src, _ = base(spark, sf_dir)
    windows = src.read("src_ip_window_counts")
    store = fresh(spark, "folded")
    slot = F.pmod(F.xxhash64("window_start", "label"), F.lit(12))
    for k in range(12):
        batch = windows.where(slot == k)
        if k:
            store.append("src_ip_window_counts", batch)
            store.fold("src_ip_window_counts", fan=4)
        else:
            store.overwrite("src_ip_window_counts", batch, ["window_date"])
    commit = store.commit("src_ip_window_counts")
    if len(commit.segments) > 8 or commit.fingerprint() != src.fingerprint("src_ip_window_counts"):
        raise AssertionError(f"folding left {len(commit.segments)} segments or other rows")
    return store.read("src_ip_window_counts")


@register("seed_copy", with_ctes("fact", body=f"SELECT {FACT_COLS} FROM fact"))
def q_seed_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, _ = base(spark, sf_dir)
    demo = fresh(spark, "seed")
    first = EV.seed_copy(src, demo)
    second = EV.seed_copy(src, demo)
    if not first or second:
        raise AssertionError("seed must copy once")
    return fact_cols(demo.read("network_events"))


@register("drop_optional_output", with_ctes("windows", body="""
SELECT 'src_ip_window_counts' AS "table", true AS was_present, count(*) AS rows_before, false AS present,
       count(*) AS rows_of_old_version FROM windows"""))
def q_drop_optional_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dropped table is gone for readers; its last version can still be read."""
    store = copy_of(spark, sf_dir, ("network_events", "label_counts", "src_ip_window_counts"))
    before = store.commit("src_ip_window_counts")
    out = M.drop_optional_output(store, "src_ip_window_counts")
    old = store.read("src_ip_window_counts", version=before.version).agg(F.count(F.lit(1)))
    return out.select("table", "was_present", F.lit(before.row_count).cast("long").alias("rows_before"),
                      "present", old.scalar().alias("rows_of_old_version"))


@register("table_properties", with_ctes("label_counts", body="""
SELECT t."table", p.key, p.value, t.row_count
FROM (SELECT 'network_events' AS "table", (SELECT count(*) FROM fact) AS row_count
      UNION ALL SELECT 'label_counts', (SELECT count(*) FROM label_counts)) t,
     (VALUES ('compression', 'snappy'), ('deleted_file_retention', 'interval 7 days'),
             ('log_retention', 'interval 30 days')) AS p(key, value)"""))
def q_table_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = copy_of(spark, sf_dir, ("network_events", "label_counts"))
    store.set_properties("label_counts", {"deleted_file_retention": "interval 14 days"})
    store.set_properties("label_counts", M.RETENTION_PROPERTIES)
    rows = []
    for name in ("network_events", "label_counts"):
        c = store.commit(name)
        rows += [(name, k, v, c.row_count) for k, v in sorted(c.properties.items())]
    return spark.createDataFrame(rows, "table string, key string, value string, row_count long")


# --- retention -----------------------------------------------------------------

def _retention_store(spark: SparkSession, sf_dir: str) -> SnapshotStore:
    """Overwrite sequence BENIGN -> ATTACK -> all rows of label_counts."""
    src, _ = base(spark, sf_dir)
    store = fresh(spark, "retention")
    lc = src.read("label_counts")
    for part in (lc.where("attack_category = 'BENIGN'"), lc.where("attack_category = 'ATTACK'"), lc):
        store.overwrite("label_counts", part, ["event_date"])
    store.overwrite("network_events", src.read("network_events"), M.TABLES["network_events"])
    return store


LATER = dt.timedelta(days=8)
_DEAD_SQL = with_ctes("label_counts", body="""
SELECT 'label_counts' AS "table", CAST(0 AS BIGINT) AS segment_version, count(*) AS segment_rows
FROM label_counts WHERE attack_category = 'BENIGN'
UNION ALL
SELECT 'label_counts', CAST(1 AS BIGINT), count(*) FROM label_counts
WHERE attack_category = 'ATTACK'""")


def _with_rows(store: SnapshotStore, dead: DataFrame) -> DataFrame:
    """Segment -> the version that wrote it (name prefix) -> rows it added."""
    hist = store.history("label_counts").select(
        F.col("version").alias("segment_version"), F.col("added_rows").alias("segment_rows"))
    written_by = F.regexp_extract("segment", r"^segment=(\d+)-", 1).cast("bigint")
    return (dead.withColumn("segment_version", written_by)
            .join(hist, "segment_version")
            .select("table", "segment_version", "segment_rows"))


@register("retention_candidates", _DEAD_SQL)
def q_retention_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _retention_store(spark, sf_dir)
    now = dt.datetime.now(dt.timezone.utc) + LATER
    return _with_rows(store, M.retention_candidates(store, "label_counts", now=now))


@register("retention_by_property", with_ctes("label_counts", extra="""
dead AS (
  SELECT t."table", count_if(attack_category = 'BENIGN') + count_if(attack_category = 'ATTACK') AS n
  FROM label_counts, (VALUES ('label_counts'), ('src_ip_window_counts')) AS t("table") GROUP BY t."table")""", body="""
SELECT "table", d.days, CASE WHEN "table" = 'label_counts' OR d.days > 14 THEN 2 ELSE 0 END AS dead_segments,
       CAST(CASE WHEN "table" = 'label_counts' OR d.days > 14 THEN n ELSE 0 END AS BIGINT) AS dead_rows,
       CASE WHEN d.days > 30 THEN 2 ELSE 0 END AS expired_versions
FROM dead, (VALUES (8), (15), (31)) AS d(days)"""))
def q_retention_by_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables with the same history; one keeps deleted files for 14 days."""
    src, _ = base(spark, sf_dir)
    store = fresh(spark, "retention-by-property")
    lc = src.read("label_counts")
    parts = (lc.where("attack_category = 'BENIGN'"), lc.where("attack_category = 'ATTACK'"), lc)
    for name, keep in (("label_counts", "interval 7 days"), ("src_ip_window_counts", "interval 14 days")):
        for part in parts:
            store.overwrite(name, part, ["event_date"], {"deleted_file_retention": keep})
    out = None
    for days in (8, 15, 31):
        now = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=days)
        for name in ("label_counts", "src_ip_window_counts"):
            added = store.history(name).select(F.col("version").alias("last_version"), "added_rows")
            dead = M.retention_candidates(store, name, now=now).join(added, "last_version").agg(
                F.count(F.lit(1)).cast("int").alias("dead_segments"),
                F.coalesce(F.sum("added_rows"), F.lit(0)).alias("dead_rows"))
            expired = M.expired_records(store, name, now=now).agg(F.count(F.lit(1)).cast("int")).scalar()
            row = dead.select(F.lit(name).alias("table"), F.lit(days).alias("days"), "dead_segments", "dead_rows",
                              expired.alias("expired_versions"))
            out = row if out is None else out.unionByName(row)
    return out


@register("retention_anti_join", _DEAD_SQL)
def q_retention_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _retention_store(spark, sf_dir)
    dead = (M.segment_lifetimes(store, "label_counts")
            .join(M.live_segments(store, "label_counts"), "segment", "left_anti")
            .select(F.lit("label_counts").alias("table"), "segment"))
    return _with_rows(store, dead)


_RETAINED_TABLES = """
SELECT 'network_events' AS "table", true AS present, CAST(0 AS BIGINT) AS removed_count,
       (SELECT count(*) FROM fact) AS row_count
UNION ALL SELECT 'label_counts', true, {removed}, (SELECT count(*) FROM label_counts)
UNION ALL SELECT 'src_ip_window_counts', false, 0, NULL
UNION ALL SELECT 'anomaly_threshold_counts', false, 0, NULL"""


def _with_current_rows(store: SnapshotStore, audit: DataFrame) -> DataFrame:
    """Audit rows with the rows that each live table still has after the run."""
    counted = None
    for name in ("network_events", "label_counts"):
        rows = store.read(name).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table"), "row_count")
        counted = rows if counted is None else counted.unionByName(rows)
    return audit.join(counted, "table", "left").select("table", "present", "removed_count", "row_count")


@register("retention_apply", with_ctes("label_counts", body=_RETAINED_TABLES.replace("{removed}", "2")))
def q_retention_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments that the first run removed per table, and the rows that stay."""
    store = _retention_store(spark, sf_dir)
    now = dt.datetime.now(dt.timezone.utc) + LATER
    audit = M.retention_apply(store, f"run-{uuid.uuid4().hex[:8]}", now=now)
    return _with_current_rows(store, audit.filter("status = 'complete' AND table <> '*'"))


@register("audit_gate", with_ctes("label_counts", body=_RETAINED_TABLES.replace("{removed}", "0")))
def q_audit_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second, empty-handed run of the same id leaves for the gate to pass."""
    store = _retention_store(spark, sf_dir)
    now = dt.datetime.now(dt.timezone.utc) + LATER
    run_id = f"run-{uuid.uuid4().hex[:8]}"
    M.retention_apply(store, run_id, now=now)
    M.retention_apply(store, run_id, now=now)
    return _with_current_rows(store, M.audit_gate(store, run_id))


# --- export and manifests ------------------------------------------------------

@register("export_manifest", with_ctes("label_counts", "windows", "anomaly", extra=COUNTS, body="""
SELECT "table", true AS present, row_count FROM counts"""))
def q_export_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, first, _ = _exported(spark, sf_dir)
    return first.select("table", "present", "row_count")


@register("publish_manifest", with_ctes("label_counts", "windows", "anomaly", extra=COUNTS, body="""
SELECT "table", true AS present, row_count FROM counts"""))
def q_publish_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, _ = base(spark, sf_dir)
    store = fresh(spark, "publish")
    for name in M.TABLES:
        EV.seed_copy(src, store, name)
    run_id = f"run-{uuid.uuid4().hex[:8]}"
    M.retention_apply(store, run_id)
    M.publish_manifest(store, run_id)
    return M.published(store).select("table", "present", "row_count")


@register("warehouse_export", with_ctes("label_counts", "windows", "anomaly", extra=COUNTS, body="""
SELECT "table", true AS present, row_count, true AS ordered, true AS clustered FROM counts"""))
def q_warehouse_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, _ = base(spark, sf_dir)
    target = fresh(spark, "warehouse-load")
    today = dt.datetime.now(dt.timezone.utc).date()
    loaded = M.warehouse_export(src, target, today).select("table", "present", "row_count")
    ordered = spark.createDataFrame(
        [(t, M.unordered_files(target, t).isEmpty(), M.overlapping_files(target, t).isEmpty()) for t in M.TABLES],
        "table string, ordered boolean, clustered boolean")
    return loaded.join(ordered, "table")


@register("export_row_check", with_ctes("label_counts", "windows", "anomaly", extra=COUNTS, body="""
SELECT "table", row_count AS source_rows, row_count AS target_rows, true AS match FROM counts"""))
def q_export_row_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, _ = base(spark, sf_dir)
    target, _, _ = _exported(spark, sf_dir)
    frames = []
    for name in M.TABLES:
        s = src.read(name).agg(F.count(F.lit(1)).alias("source_rows"))
        t = target.read(name).agg(F.count(F.lit(1)).alias("target_rows")).select("target_rows").scalar()
        frames.append(s.select(F.lit(name).alias("table"), "source_rows", t.alias("target_rows"),
                               (F.col("source_rows") == t).alias("match")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("idempotent_rerun", with_ctes("label_counts", "windows", "anomaly", extra=COUNTS, body="""
SELECT "table", row_count AS first_rows, row_count AS second_rows, true AS same_rows, true AS same_fingerprints
FROM counts"""))
def q_idempotent_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, _ = base(spark, sf_dir)
    target, first, second = _exported(spark, sf_dir)
    f = first.select("table", F.col("row_count").alias("first_rows"))
    s = second.select("table", F.col("row_count").alias("second_rows"))
    frames = []
    for name in M.TABLES:
        same_rows = multiset_equal(src.read(name), target.read(name))
        # by the commit records alone: the source's version and both exports of it
        prints = {src.fingerprint(name), *(target.fingerprint(name, v) for v in target.versions(name))}
        frames.append(spark.createDataFrame([(name, same_rows, len(prints) == 1)],
                                            "table string, same_rows boolean, same_fingerprints boolean"))
    same = frames[0]
    for fr in frames[1:]:
        same = same.unionByName(fr)
    return f.join(s, "table").join(same, "table").select("table", "first_rows", "second_rows",
                                                         "same_rows", "same_fingerprints")


@register("run_report", with_ctes("label_counts", "windows", "anomaly", extra=COUNTS, body="""
SELECT 'none' AS cache_mode, count(*) AS cleaned_rows,
       CAST(count_if("Source_IP" IS NULL) AS BIGINT) AS null_source_ip,
       CAST(count_if("Flow_Packets/s" IS NULL) AS BIGINT) AS null_flow_packets_per_sec,
       CAST(count_if(event_time IS NULL) AS BIGINT) AS null_event_time,
       CAST(count_if(attack_category = 'ATTACK') AS BIGINT) AS attack_rows,
       min(event_time) AS first_time, max(event_time) AS last_time, min(event_date) AS first_date,
       max(event_date) AS last_date, min(_source_file) AS first_capture, max(_source_file) AS last_capture,
       (SELECT t FROM threshold) AS threshold_packets_per_sec,
       (SELECT CAST(sum(row_count) AS BIGINT) FROM counts) AS rows_of_all_tables
FROM fact"""))
def q_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of a run's report that follow from its input."""
    _, report = base(spark, sf_dir)
    nulls = [F.col("null_rows")[c].alias(f"null_{c}") for c in ("source_ip", "flow_packets_per_sec", "event_time")]
    total = F.aggregate(F.map_values("table_rows"), F.lit(0).cast("long"), lambda a, n: a + n)
    return report.select("cache_mode", "cleaned_rows", *nulls, "attack_rows", "first_time", "last_time", "first_date",
                         "last_date", "first_capture", "last_capture", "threshold_packets_per_sec",
                         total.alias("rows_of_all_tables"))


@register("cache_mode", with_ctes("label_counts", body="""
SELECT m.cache_mode, lc.* FROM label_counts lc,
  (VALUES ('full'), ('narrow'), ('none')) AS m(cache_mode)"""))
def q_cache_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for mode in ("full", "narrow", "none"):
        store = fresh(spark, f"cache-{mode}")
        run_transform(spark, raw_flows(spark, sf_dir), store, cache_mode=mode)
        lc = store.read("label_counts").select(F.lit(mode).alias("cache_mode"), "*")
        out = lc if out is None else out.unionByName(lc)
    return out


@register("table_fingerprint", with_ctes("fact", body="""
SELECT count(*) AS rows, true AS same_when_repartitioned, count(*) = 0 AS same_without_first FROM fact"""))
def q_table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact's checksum against that of the same rows dealt anew, and of all but
    the first day's rows."""
    store, _ = base(spark, sf_dir)
    fact = store.read("network_events")
    first_day = fact.agg(F.min("event_date")).scalar()
    own = fingerprint(fact).select(F.struct("*").alias("own"))
    dealt = fingerprint(fact.repartition(7, "label")).select(F.struct("*")).scalar()
    fewer = fingerprint(fact.where(F.col("event_date") > first_day)).select(F.struct("*")).scalar()
    return own.select("own.rows", own["own"].eqNullSafe(dealt).alias("same_when_repartitioned"),
                      own["own"].eqNullSafe(fewer).alias("same_without_first"))


@register("table_equality", with_ctes("label_counts", body="""
SELECT true AS same_schema,
       CAST(count_if(attack_category = 'BENIGN') AS BIGINT) AS only_left,
       CAST(0 AS BIGINT) AS only_right, count_if(attack_category = 'BENIGN') = 0 AS equal
FROM label_counts"""))
def q_table_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _label_versions(spark, sf_dir)
    return table_equality(store.read("label_counts", version=0), store.read("label_counts"))


# --- history, versions, schema diff, evolution check ---------------------------

@register("ordered_history", with_ctes("fact", body="""
SELECT h.version, h.operation, h.added_rows, n.n + h.extra AS row_count
FROM (VALUES (0, 'CREATE', NULL, 0), (1, 'ADD COLUMNS', 0, 0), (2, 'APPEND', 3, 3))
       AS h(version, operation, added_rows, extra),
     (SELECT count(*) AS n FROM fact) AS n"""))
def q_ordered_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    demo, _ = _evolved(spark, sf_dir)
    h = demo.history("network_events")
    return h.select(F.col("version").cast("int").alias("version"), "operation",
                    F.when(F.col("version") == 0, F.lit(None)).otherwise(F.col("added_rows"))
                    .cast("int").alias("added_rows"), "row_count")


@register("latest_version", with_ctes("fact", body="""
SELECT CAST(2 AS BIGINT) AS latest_version, count(*) + 3 AS row_count FROM fact"""))
def q_latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    demo, _ = _evolved(spark, sf_dir)
    h = demo.history("network_events")
    return h.agg(F.max("version").alias("latest_version"),
                 F.max_by("row_count", "version").alias("row_count"))


@register("latest_snapshot", with_ctes("fact", body="""
SELECT CAST(2 AS BIGINT) AS version, 'APPEND' AS operation, count(*) + 3 AS row_count FROM fact"""))
def q_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    demo, _ = _evolved(spark, sf_dir)
    return demo.history("network_events", limit=1).select("version", "operation", "row_count")


@register("schema_diff", with_ctes("fact", body="""
SELECT 'threat_intel_score' AS column_name, 'double' AS data_type,
       CAST(3 AS BIGINT) AS row_delta WHERE EXISTS (SELECT 1 FROM fact)"""))
def q_schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    demo, info = _evolved(spark, sf_dir)
    return EV.schema_diff(demo.read("network_events", version=info["before_version"]),
                          demo.read("network_events"))


@register("evolution_check", with_ctes("fact", body="""
SELECT count(*) AS before_rows, count(*) + 3 AS after_rows, count(*) AS null_rows,
       false AS old_has_column, true AS new_has_column, true AS passed FROM fact"""))
def q_evolution_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    demo, info = _evolved(spark, sf_dir)
    return EV.evolution_check(demo, "network_events", info["before_version"])
