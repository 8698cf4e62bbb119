"""Table maintenance: retention, export, manifests and the warehouse load.

All decisions are Spark plans over the commit logs (small DataFrames of one
row per version); the only driver-side actions are file-system deletes of
whole segment folders and the tiny result rows they produce.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, LongType, StringType, StructField, StructType, TimestampType,
)

from flowlake.sources import fs
from flowlake.sources.snapshots import Commit, SnapshotStore, row_hash

# Tables of one run, their partitioning, and which are required.
TABLES: dict[str, list[str]] = {
    "network_events": ["event_date", "attack_category"],
    "label_counts": ["event_date"],
    "src_ip_window_counts": ["window_date"],
    "anomaly_threshold_counts": ["event_date"],
}
REQUIRED_TABLES = ("network_events", "label_counts")
RETENTION_PROPERTIES = {
    "log_retention": "interval 30 days",
    "deleted_file_retention": "interval 7 days",
}
WAREHOUSE_PARTITION_EXPIRY_DAYS = 60


class MissingTable(FileNotFoundError):
    pass


class RowCountMismatch(RuntimeError):
    pass


class StaleAudit(ValueError):
    pass


# -- required tables (S10) ------------------------------------------------------

def table_presence(store: SnapshotStore, names=tuple(TABLES)) -> DataFrame:
    """One row per expected table: required flag, present flag, version, rows."""
    rows = []
    for name in names:
        v = store.latest_version(name)
        present = v is not None and store.commit(name, v).present
        rows.append((name, name in REQUIRED_TABLES, present, v if present else None,
                     store.commit(name, v).row_count if present else None))
    return store.spark.createDataFrame(
        rows, "table string, required boolean, present boolean, version long, row_count long")


def missing_required(store: SnapshotStore) -> DataFrame:
    """Expected required tables ``left_anti`` the committed live tables."""
    presence = table_presence(store)
    expected = presence.where("required").select("table")
    live = presence.where("present").select("table")
    return expected.join(live, "table", "left_anti")


def require_tables(store: SnapshotStore) -> None:
    missing = [r["table"] for r in missing_required(store).collect()]
    if missing:
        raise MissingTable(f"required tables missing under {store.root}: {missing}")


# -- retention (K12, K13, K14, J3) ---------------------------------------------

def segment_lifetimes(store: SnapshotStore, name: str) -> DataFrame:
    """Every segment ever referenced, its last referencing version and the
    time the next version stopped referencing it (null while live)."""
    hist = store.history(name).select("version", "committed_at", "segments")
    refs = hist.select("version", F.explode("segments").alias("segment"))
    last = refs.groupBy("segment").agg(F.max("version").alias("last_version"))
    nxt = hist.select((F.col("version") - 1).alias("last_version"),
                      F.col("committed_at").alias("removed_at"))
    return last.join(nxt, "last_version", "left")


def live_segments(store: SnapshotStore, name: str) -> DataFrame:
    c = store.commit(name)
    return store.spark.createDataFrame([(s,) for s in c.segments], "segment string")


def orphan_segments(store: SnapshotStore, name: str) -> DataFrame:
    """Segment folders no commit references (a write that died before its
    commit record), dated by the folder's modification time."""
    listed = store.spark.createDataFrame(
        [(n, ms) for n, ms in fs.list_dirs_with_mtime(store.spark, f"{store.path(name)}/data")
         if n.startswith("segment=")], "segment string, mtime_ms long")
    known = segment_lifetimes(store, name).select("segment")
    return listed.join(known, "segment", "left_anti").select(
        "segment", F.lit(None).cast("long").alias("last_version"),
        F.timestamp_millis("mtime_ms").alias("removed_at"))


def _cutoff(store: SnapshotStore, name: str, key: str, now: dt.datetime | None) -> Column:
    """The table's own period (an interval property, parsed by Spark) before ``now``."""
    now = now or dt.datetime.now(dt.timezone.utc)
    if now.tzinfo is None:
        now = now.replace(tzinfo=dt.timezone.utc)
    period = store.commit(name).properties.get(key, RETENTION_PROPERTIES[key])
    return F.lit(now) - F.lit(period).cast("interval")


def expired_records(store: SnapshotStore, name: str, now: dt.datetime | None = None) -> DataFrame:
    """Commit records superseded longer ago than ``log_retention``, oldest first.  A version
    goes only with all older ones, so what is left of the history has no gap."""
    hist = store.history(name).select("version", "committed_at")
    superseded = hist.select((F.col("version") - 1).alias("version"), F.col("committed_at").alias("superseded_at"))
    cutoff = _cutoff(store, name, "log_retention", now)
    kept = (hist.join(superseded, "version", "left")
            .where(F.col("superseded_at").isNull() | (F.col("superseded_at") >= cutoff))
            .agg(F.min("version")).scalar())
    return (hist.join(superseded, "version").where(F.col("version") < kept)
            .select(F.lit(name).alias("table"), "version", "superseded_at").orderBy("version"))


def retention_candidates(store: SnapshotStore, name: str,
                         now: dt.datetime | None = None,
                         keep: dt.timedelta | None = None) -> DataFrame:
    """K12 (dry run): segments not in the current version (J3 anti join)
    whose removal is older than the table's ``deleted_file_retention`` (or ``keep``),
    plus uncommitted (orphan) segment folders older than it."""
    if keep is not None:
        now = now or dt.datetime.now(dt.timezone.utc)
        cutoff = F.lit((now if now.tzinfo else now.replace(tzinfo=dt.timezone.utc)) - keep)
    else:
        cutoff = _cutoff(store, name, "deleted_file_retention", now)
    dead = segment_lifetimes(store, name).join(live_segments(store, name), "segment", "left_anti")
    return (
        dead.unionByName(orphan_segments(store, name))
        .where(F.col("removed_at").isNotNull() & (F.col("removed_at") < cutoff))
        .select(F.lit(name).alias("table"), "segment", "last_version", "removed_at")
    )


AUDIT_SCHEMA = StructType([
    StructField("run_id", StringType()),
    StructField("root", StringType()),
    StructField("table", StringType()),
    StructField("attempt", StringType()),
    StructField("status", StringType()),
    StructField("present", BooleanType()),
    StructField("version_before", LongType()),
    StructField("candidates", ArrayType(StringType())),
    StructField("existing_candidates", ArrayType(StringType())),
    StructField("removed", ArrayType(StringType())),
    StructField("removed_count", LongType()),
    StructField("version_after", LongType()),
    StructField("error", StringType()),
])


def _audit_dir(store: SnapshotStore, run_id: str) -> str:
    """One folder per run, named by the run id itself (letters that names can't hold, escaped)."""
    return f"{store.root}/_retention/run-{quote(run_id, safe='')}"


def _audit_write(store: SnapshotStore, run_id: str, seq: int, rows: list[tuple]) -> None:
    """Append audit records as one new JSON file (create-if-absent)."""
    names = [f.name for f in AUDIT_SCHEMA.fields]
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"
    lines = [json.dumps({**dict(zip(names, r)), "seq": seq, "written_at": now}) for r in rows]
    fs.write_new(store.spark, f"{_audit_dir(store, run_id)}/{seq:08d}.json", "\n".join(lines))


def read_audit(store: SnapshotStore, run_id: str) -> DataFrame:
    schema = StructType(list(AUDIT_SCHEMA.fields) + [
        StructField("seq", LongType()), StructField("written_at", TimestampType())])
    path = _audit_dir(store, run_id)
    if not fs.exists(store.spark, path):
        return store.spark.createDataFrame([], schema)
    return store.spark.read.schema(schema).json(f"{path}/*.json")


def retention_apply(store: SnapshotStore, run_id: str, tables=tuple(TABLES), now: dt.datetime | None = None,
                    properties: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Dry run -> audit row (running) -> delete -> re-list -> audit row.

    Candidates are recorded before anything is deleted; a retry appends a
    new attempt; ``removed`` counts only segments seen present before and
    absent after.  The run ends with a ``run`` row of status complete or
    failed.  Returns the audit rows of this run.

    Each table's properties are set right first: RETENTION_PROPERTIES, or what ``properties``
    says for that table.  Its own periods then decide, for segments and for commit records
    (a record only goes once none of its segments is left)."""
    existing = read_audit(store, run_id).agg(F.max("seq")).first()[0]
    seq = 0 if existing is None else existing + 1
    attempt = uuid.uuid4().hex[:12]
    require_tables(store)
    _audit_write(store, run_id, seq, [(run_id, store.root, "*", attempt, "running", None, None,
                                       None, None, None, None, None, None)])
    seq += 1
    try:
        for name in tables:
            if not store.present(name):
                _audit_write(store, run_id, seq, [(run_id, store.root, name, attempt, "complete",
                                                   False, None, [], [], [], 0, None, None)])
                seq += 1
                continue
            store.set_properties(name, {**RETENTION_PROPERTIES, **(properties or {}).get(name, {})})
            before = store.latest_version(name)
            cands = [r["segment"] for r in retention_candidates(store, name, now).collect()]
            data = f"{store.path(name)}/data"
            present = _among(store, data, cands)
            _audit_write(store, run_id, seq, [(run_id, store.root, name, attempt, "running", True,
                                               before, cands, present, None, None, None, None)])
            seq += 1
            with ThreadPoolExecutor(max_workers=16) as pool:
                list(pool.map(lambda s: fs.delete(store.spark, f"{data}/{s}"), present))
            left = set(_among(store, data, present))
            removed = [s for s in present if s not in left]
            _forget_records(store, name, now)
            _audit_write(store, run_id, seq, [(run_id, store.root, name, attempt, "complete", True,
                                               before, cands, present, removed, len(removed),
                                               store.latest_version(name), None)])
            seq += 1
        _audit_write(store, run_id, seq, [(run_id, store.root, "*", attempt, "complete", None,
                                           None, None, None, None, None, None, None)])
    except Exception as exc:
        _audit_write(store, run_id, seq, [(run_id, store.root, "*", attempt, "failed", None, None,
                                           None, None, None, None, None, str(exc))])
        raise
    return read_audit(store, run_id).where(F.col("attempt") == attempt).orderBy("seq")


def _among(store: SnapshotStore, data: str, segments: list[str]) -> list[str]:
    """Those of the segments that are on disk: one listing."""
    listed = set(fs.list_names(store.spark, data))
    return [s for s in segments if s in listed]


def _forget_records(store: SnapshotStore, name: str, now: dt.datetime | None) -> None:
    """Delete expired commit records, oldest first, up to the first one that still has a segment
    of its own on disk."""
    live = set(store.commit(name).segments)
    listed = set(fs.list_names(store.spark, f"{store.path(name)}/data"))
    for row in expired_records(store, name, now).collect():
        if any(s in listed and s not in live for s in store.commit(name, row["version"]).segments):
            break
        store.forget(name, row["version"])


def audit_gate(store: SnapshotStore, run_id: str) -> DataFrame:
    """Latest per-table audit rows of a complete run for this root.

    Raises when the audit is missing, not complete, or of another root."""
    audit = read_audit(store, run_id)
    last_run = (audit.where(F.col("table") == "*").orderBy(F.col("seq").desc())
                .select("status", "root", "attempt").first())
    if last_run is None or last_run["status"] != "complete" or last_run["root"] != store.root:
        raise StaleAudit(f"no finished retention run {run_id!r} is recorded for {store.root}")
    final = audit.where((F.col("attempt") == last_run["attempt"]) & (F.col("table") != "*")
                        & (F.col("status") == "complete"))
    return final.select("run_id", "root", "table", "present",
                        F.col("version_after").alias("version"), "removed_count")


# -- export and manifests (K15, K16, V3) -----------------------------------------

MANIFEST_SCHEMA = "table string, present boolean, source_version long, " \
                  "target_version long, snapshot_id long, row_count long"


def export_tables(source: SnapshotStore, target: SnapshotStore,
                  tables: dict[str, list[str]] = TABLES) -> DataFrame:
    """Pin each source version, replace the target table, check counts,
    publish one manifest after all tables (old marker removed first)."""
    spark = source.spark
    require_tables(source)   # a refused export leaves the last manifest alone
    marker = f"{target.root}/_manifest"
    if fs.exists(spark, marker):
        fs.delete(spark, marker)

    def export_one(name: str, parts: list[str]) -> tuple:
        if not source.present(name):
            target.drop(name)
            return (name, False, None, None, None, None)
        pinned = source.commit(name)
        data = source.read(name, version=pinned.version)
        version = target.create_or_replace(name, data, parts,
                                           {"compression": "gzip", "format_version": "2"})
        written = target.commit(name, version)
        export_row_check(pinned.row_count, written.row_count, name)
        fingerprint_check(pinned, written, name)
        return (name, True, pinned.version, version, written.snapshot_id, written.row_count)

    # tables are independent: their copy jobs run side by side; the manifest
    # is published only after every one of them has passed its row check
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        futures = [pool.submit(export_one, name, parts) for name, parts in tables.items()]
        rows = [f.result() for f in futures]
    manifest = spark.createDataFrame(rows, MANIFEST_SCHEMA)
    manifest.coalesce(1).write.mode("errorifexists").json(marker)
    return manifest


def export_row_check(expected: int, actual: int, name: str) -> None:
    """V3: source rows must equal target rows."""
    if expected != actual:
        raise RowCountMismatch(f"{name}: {actual} rows arrived of {expected}")


def fingerprint_check(source: Commit, target: Commit, name: str) -> None:
    """The rows written must be the rows pinned, by the fingerprints that both writes left
    (a table from before there were any has none)."""
    if source.fingerprint() is not None and source.fingerprint() != target.fingerprint():
        raise RowCountMismatch(f"{name}: the rows that arrived aren't those of version {source.version}")


def publish_manifest(store: SnapshotStore, run_id: str | None = None,
                     tables=tuple(TABLES)) -> DataFrame:
    """Version + counted rows per table; with ``run_id`` the retention
    audit must agree on presence and version (full outer join on table).

    Versions are pinned: rows are counted in the version that is reported.  The
    checked manifest is stored with its time and audit run (``published``) and returned
    as it was stored."""
    spark = store.spark
    frames = []
    for name in tables:
        if store.present(name):
            c = store.commit(name)
            frames.append(store.read(name, version=c.version).agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table"), F.lit(True).alias("present"),
                F.lit(c.version).cast("long").alias("version"), "row_count"))
        else:
            frames.append(spark.createDataFrame(
                [(name, False, None, None)], "table string, present boolean, version long, "
                "row_count long"))
    manifest = frames[0]
    for f in frames[1:]:
        manifest = manifest.unionByName(f)
    if run_id is None:
        return _publish(store, manifest, None)
    audited = audit_gate(store, run_id).select(
        "table", F.col("present").alias("audited_present"),
        F.col("version").alias("audited_version"))
    checked = manifest.join(audited, "table", "full_outer")
    bad = checked.where(
        (F.coalesce(F.col("present"), F.lit(False)) != F.coalesce(F.col("audited_present"), F.lit(False)))
        | (F.col("present") & ~F.col("version").eqNullSafe(F.col("audited_version"))))
    changed = [r["table"] for r in bad.select("table").collect()]
    if changed:
        raise StaleAudit(f"run retention again: {changed} differ from the audited versions")
    return _publish(store, manifest, run_id)


PUBLISHED_SCHEMA = "table string, present boolean, version long, row_count long, run_id string, " \
                   "audit string, published_at timestamp"


def _publish(store: SnapshotStore, manifest: DataFrame, run_id: str | None) -> DataFrame:
    """Store one manifest (a row per table) as one new JSON file and read it back."""
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"
    audit = None if run_id is None else _audit_dir(store, run_id)
    lines = [json.dumps({**r.asDict(), "run_id": run_id, "audit": audit, "published_at": now})
             for r in manifest.collect()]
    path = f"{store.root}/_published/{now.replace(':', '')}-{uuid.uuid4().hex[:8]}.json"
    fs.write_new(store.spark, path, "\n".join(lines))
    return store.spark.read.schema(PUBLISHED_SCHEMA).json(path)


def published(store: SnapshotStore) -> DataFrame:
    """Every manifest published for this root, newest last."""
    return (store.spark.read.schema(PUBLISHED_SCHEMA).json(f"{store.root}/_published/*.json")
            .orderBy("published_at", "table"))


# -- warehouse export (K17) -------------------------------------------------------

def warehouse_export(source: SnapshotStore, target: SnapshotStore, run_date: dt.date,
                     tables=tuple(TABLES)) -> DataFrame:
    """Replace each warehouse table with the pinned source snapshot.

    Daily ingestion partition, rows clustered by ``label``, gzip, microsecond
    timestamps, loaded-rows check, ``label`` required.  One shuffle deals rows out by ranges of
    (label, row hash), so a file holds few labels, and a label that a third of all
    rows share is spread over several tasks; each task sorts its rows.
    Partitions older than the expiry are removed from the warehouse."""
    spark = source.spark
    require_tables(source)

    def load_one(name: str) -> tuple:
        if not source.present(name):
            target.drop(name)
            return (name, False, None, None, None, None)
        pinned = source.commit(name)
        data = source.read(name, version=pinned.version)
        if "label" not in data.columns:
            raise ValueError(f"can't cluster {name}: no label column")
        # the partition column leads, so that the writer keeps this order
        staged = (data.repartitionByRange("label", row_hash(data.columns))
                  .withColumn("ingest_date", F.lit(run_date).cast("date"))
                  .sortWithinPartitions("ingest_date", "label"))
        version = target.create_or_replace(name, staged, ["ingest_date"], {"compression": "gzip"},
                                           cluster=False)
        loaded = target.commit(name, version).row_count
        export_row_check(pinned.row_count, loaded, name)
        expire_partitions(target, name, run_date)
        return (name, True, pinned.version, version, f"{target.path(name)}/ingest_date={run_date}", loaded)

    # microsecond timestamps for the whole load; tables load side by side
    prior = spark.conf.get("spark.sql.parquet.outputTimestampType")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    try:
        with ThreadPoolExecutor(max_workers=len(tables)) as pool:
            futures = [pool.submit(load_one, name) for name in tables]
            rows = [f.result() for f in futures]
    finally:
        spark.conf.set("spark.sql.parquet.outputTimestampType", prior)
    return spark.createDataFrame(rows, "table string, present boolean, source_version long, target_version long, "
                                       "target string, row_count long")


def expire_partitions(store: SnapshotStore, name: str, today: dt.date,
                      days: int = WAREHOUSE_PARTITION_EXPIRY_DAYS) -> DataFrame:
    """Leave out loads older than the expiry window: a new version without their
    segments.  Each load is a segment of one ingestion date, so no row is rewritten."""
    oldest = f"ingest_date={today - dt.timedelta(days=days)}"
    segments = store.commit(name).segments
    live = [s for s in segments
            if any(day >= oldest for day in fs.list_names(store.spark, f"{store.path(name)}/data/{s}")
                   if day.startswith("ingest_date="))]
    if len(live) < len(segments):
        store.keep_segments(name, live, "EXPIRE PARTITIONS")
    return store.read(name)


def _placed_rows(store: SnapshotStore, name: str, column: str) -> DataFrame:
    """A column of the current version's rows, with their file and place in it."""
    data = f"{store.path(name)}/data"
    rows = store.spark.read.option("basePath", data).parquet(*[f"{data}/{s}" for s in store.commit(name).segments])
    return rows.select(F.col(column).alias("__v"), F.col("_metadata.file_path").alias("file_path"),
                       F.col("_metadata.row_index").alias("__at"))


def overlapping_files(store: SnapshotStore, name: str, column: str = "label") -> DataFrame:
    """Files of the current version whose range of ``column`` overlaps an earlier one's by more
    than the value that both end on (none after ``warehouse_export``: only a label that is spread
    over tasks stands in several files)."""
    ranges = _placed_rows(store, name, column).groupBy("file_path").agg(
        F.min("__v").alias("low"), F.max("__v").alias("high"))
    before = F.max("high").over(Window.orderBy("low", "high", "file_path")
                                .rowsBetween(Window.unboundedPreceding, -1))
    return ranges.withColumn("__before", before).where(F.col("__before") > F.col("low")).drop("__before")


def unordered_files(store: SnapshotStore, name: str, column: str = "label") -> DataFrame:
    """Files of the current version in which ``column`` falls from a row to the next
    (none after ``warehouse_export``).  Rows are compared in file order, within tasks."""
    placed = _placed_rows(store, name, column)
    runs = placed.groupBy("file_path", "__v").agg(F.min("__at").alias("__first"), F.max("__at").alias("__last"))
    after = F.lag("__last").over(Window.partitionBy("file_path").orderBy(F.asc_nulls_first("__v")))
    return (runs.withColumn("__before", after).filter(F.col("__before") > F.col("__first"))
            .select("file_path").distinct())


def drop_optional_output(store: SnapshotStore, name: str) -> DataFrame:
    """K9: remove a stale optional table; returns one row describing it."""
    if name in REQUIRED_TABLES:
        raise ValueError(f"{name} is required and cannot be dropped")
    was_present = store.present(name)
    version = store.drop(name)
    return store.spark.createDataFrame(
        [(name, was_present, version, store.present(name))],
        "table string, was_present boolean, drop_version long, present boolean")

