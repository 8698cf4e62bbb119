"""Retention audit, export/loader checks and manifests on small tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowlake.operators import maintenance as M
from flowlake.sources import fs
from flowlake.sources.snapshots import SnapshotStore

UTC = dt.timezone.utc


def labels(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "label string")


@pytest.fixture()
def aged(spark, tmp):
    """BENIGN -> ATTACK -> CURRENT; the first removal is past the limit."""
    store = SnapshotStore(spark, tmp)
    now = dt.datetime.now(UTC)
    for name in ("network_events", "label_counts"):
        store.overwrite(name, labels(spark, "BENIGN"), committed_at=now - dt.timedelta(days=20))
        store.overwrite(name, labels(spark, "ATTACK"), committed_at=now - dt.timedelta(days=10))
        store.overwrite(name, labels(spark, "CURRENT"), committed_at=now - dt.timedelta(days=1))
    return store


def test_candidates_exclude_current_and_recent(aged):
    got = sorted(r.last_version for r in M.retention_candidates(aged, "label_counts").collect())
    assert got == [0]
    dead = M.segment_lifetimes(aged, "label_counts").join(
        M.live_segments(aged, "label_counts"), "segment", "left_anti")
    assert sorted(r.last_version for r in dead.collect()) == [0, 1]


def test_retention_removes_once_and_keeps_reads(aged):
    first = M.retention_apply(aged, "run-1")
    done = {r.table: r.removed_count for r in first.where("status = 'complete'").collect()
            if r.table != "*"}
    assert done == {"network_events": 1, "label_counts": 1,
                    "src_ip_window_counts": 0, "anomaly_threshold_counts": 0}
    second = M.retention_apply(aged, "run-1")
    again = {r.table: r.removed_count for r in second.where("status = 'complete'").collect()
             if r.table != "*"}
    assert again["label_counts"] == 0
    assert [r.label for r in aged.read("label_counts").collect()] == ["CURRENT"]
    assert [r.label for r in aged.read("label_counts", version=1).collect()] == ["ATTACK"]
    gate = {r.table: r.present for r in M.audit_gate(aged, "run-1").collect()}
    assert gate["label_counts"] and not gate["src_ip_window_counts"]


def test_failed_retention_is_refused(aged, monkeypatch):
    def boom(*a, **k):
        raise OSError("disk gone")
    monkeypatch.setattr(fs, "delete", boom)
    with pytest.raises(OSError):
        M.retention_apply(aged, "run-2")
    with pytest.raises(M.StaleAudit):
        M.audit_gate(aged, "run-2")
    with pytest.raises(M.StaleAudit):
        M.audit_gate(aged, "never-ran")


def test_retention_requires_tables(spark, tmp):
    store = SnapshotStore(spark, tmp)
    store.overwrite("network_events", labels(spark, "A"))
    with pytest.raises(M.MissingTable):
        M.retention_apply(store, "run-3")


def one_row_tables(spark, store):
    df = spark.createDataFrame([(dt.date(2017, 7, 3), "BENIGN", 2)],
                               "event_date date, label string, flow_count long")
    for name in M.TABLES:
        store.overwrite(name, df, ["event_date"])
    return df


def test_emptied_snapshot_keeps_partition_column(spark, tmp):
    store = SnapshotStore(spark, tmp)
    df = one_row_tables(spark, store)
    store.overwrite("label_counts", df.limit(0), ["event_date"])
    assert store.latest_version("label_counts") == 1
    out = store.read("label_counts")
    assert out.count() == 0 and "event_date" in out.columns


def test_warehouse_export(spark, tmp):
    src = SnapshotStore(spark, tmp + "/src")
    one_row_tables(spark, src)
    wh = SnapshotStore(spark, tmp + "/wh")
    today = dt.date(2024, 2, 1)
    report = {r.table: r for r in M.warehouse_export(src, wh, today).collect()}
    assert all(r.present and r.row_count == 1 for r in report.values())
    t = wh.read("label_counts")
    assert t.select("ingest_date").first()[0] == today
    assert wh.commit("label_counts").properties["compression"] == "gzip"
    # rerun replaces, never appends
    M.warehouse_export(src, wh, today)
    assert wh.read("label_counts").count() == 1


def test_warehouse_files_are_sorted_by_label(spark, tmp):
    src, wh = SnapshotStore(spark, tmp + "/src"), SnapshotStore(spark, tmp + "/wh")
    one_row_tables(spark, src)
    many = spark.range(0, 4000, numPartitions=3).select(
        F.lit(dt.date(2017, 7, 3)).alias("event_date"),
        F.concat(F.lit("l"), F.pmod(F.xxhash64("id"), F.lit(5)).cast("string")).alias("label"),
        F.col("id").alias("flow_count"))
    src.overwrite("label_counts", many, ["event_date"])
    M.warehouse_export(src, wh, dt.date(2024, 2, 1))
    assert M.unordered_files(wh, "label_counts").isEmpty()
    assert not M.unordered_files(src, "label_counts").isEmpty()
    assert wh.read("label_counts").count() == 4000


def test_expiry_drops_old_loads_without_rewriting(spark, tmp):
    wh = SnapshotStore(spark, tmp)
    load = lambda day: spark.createDataFrame([("A", dt.date(2024, 1, day))], "label string, ingest_date date")
    wh.overwrite("t", load(1), ["ingest_date"])
    wh.append("t", load(20))
    segments = wh.commit("t").segments
    M.expire_partitions(wh, "t", dt.date(2024, 1, 25), days=10)
    assert wh.commit("t").segments == segments[1:] and wh.commit("t").row_count == 1
    assert [r.ingest_date.day for r in wh.read("t").collect()] == [20]


def test_refused_export_keeps_the_last_manifest(spark, tmp):
    src, target = SnapshotStore(spark, tmp + "/src"), SnapshotStore(spark, tmp + "/target")
    one_row_tables(spark, src)
    tables = {name: ["event_date"] for name in M.TABLES}
    M.export_tables(src, target, tables)
    src.drop("label_counts")
    with pytest.raises(M.MissingTable):
        M.export_tables(src, target, tables)
    assert fs.exists(spark, f"{target.root}/_manifest/_SUCCESS")


def test_half_written_commit_is_not_seen(spark, tmp, monkeypatch):
    store = SnapshotStore(spark, tmp)
    store.overwrite("t", labels(spark, "A"))
    from pathlib import Path
    Path(f"{tmp}/t/commits/.00000000000000000001.json.dead.tmp").write_text("")
    assert [r.label for r in store.read("t").collect()] == ["A"]
    store.overwrite("t", labels(spark, "B"))
    assert [r.label for r in store.read("t").collect()] == ["B"]
    with pytest.raises(FileExistsError):
        fs.write_new(spark, f"{tmp}/t/commits/{1:020d}.json", "{}")


def test_replayed_stream_batch_is_appended_once(spark, tmp):
    from flowlake.streaming.windows import _append_batch
    store = SnapshotStore(spark, tmp)
    sink = _append_batch(store, "t", [])
    sink(labels(spark, "A"), 0)
    sink(labels(spark, "B"), 1)
    sink(labels(spark, "B"), 1)
    assert sorted(r.label for r in store.read("t").collect()) == ["A", "B"]
    assert store.latest_version("t") == 1


def test_warehouse_export_guards(spark, tmp, monkeypatch):
    src = SnapshotStore(spark, tmp + "/src")
    one_row_tables(spark, src)
    wh = SnapshotStore(spark, tmp + "/wh")
    src.drop("src_ip_window_counts")
    report = {r.table: r.present for r in M.warehouse_export(src, wh, dt.date(2024, 2, 1)).collect()}
    assert report["src_ip_window_counts"] is False and not wh.present("src_ip_window_counts")
    src.overwrite("anomaly_threshold_counts",
                  spark.createDataFrame([(dt.date(2017, 7, 3), 1)], "event_date date, n long"),
                  ["event_date"])
    with pytest.raises(ValueError, match="no label column"):
        M.warehouse_export(src, wh, dt.date(2024, 2, 1))
    src.drop("label_counts")
    with pytest.raises(M.MissingTable):
        M.warehouse_export(src, wh, dt.date(2024, 2, 1))


def test_row_mismatch_raises():
    with pytest.raises(M.RowCountMismatch):
        M.export_row_check(3, 2, "t")


def test_publish_manifest_refuses_changed_tables(spark, tmp):
    store = SnapshotStore(spark, tmp)
    df = one_row_tables(spark, store)
    M.retention_apply(store, "run-9")
    manifest = {r.table: r.row_count for r in M.publish_manifest(store, "run-9").collect()}
    assert manifest == {name: 1 for name in M.TABLES}
    stored = M.published(store).collect()
    assert {r.table: (r.row_count, r.run_id) for r in stored} == {name: (1, "run-9") for name in M.TABLES}
    assert all(r.published_at is not None and r.audit for r in stored)
    store.overwrite("label_counts", df.union(df), ["event_date"])
    with pytest.raises(M.StaleAudit):
        M.publish_manifest(store, "run-9")


def test_missing_required_tables(spark, tmp):
    store = SnapshotStore(spark, tmp)
    store.overwrite("label_counts", labels(spark, "A"))
    assert [r.table for r in M.missing_required(store).collect()] == ["network_events"]
    with pytest.raises(M.MissingTable):
        M.require_tables(store)


def test_history_and_time_travel_by_id(spark, tmp):
    store = SnapshotStore(spark, tmp)
    store.overwrite("t", labels(spark, "A"))
    store.overwrite("t", labels(spark, "B", "C"))
    hist = store.history("t").collect()
    assert [r.version for r in hist] == [0, 1]
    assert [r.operation for r in hist] == ["CREATE", "OVERWRITE"]
    old = store.read("t", snapshot_id=hist[0].snapshot_id)
    assert [r.label for r in old.collect()] == ["A"]
    assert store.read("t").where(F.col("label") == "C").count() == 1


def test_snapshot_read_excludes_obsolete_files(spark, tmp):
    store = SnapshotStore(spark, tmp)
    df = spark.createDataFrame([(dt.date(2017, 7, 3), "OLD")], "event_date date, label string")
    store.overwrite("t", df, ["event_date"])
    store.overwrite("t", df.selectExpr("event_date", "'NEW' AS label"), ["event_date"])
    assert fs.exists(spark, f"{store.path('t')}/data/{store.commit('t', 0).segments[0]}")
    assert [r.label for r in store.read("t").collect()] == ["NEW"]
    back = store.read("t")
    assert dict(back.dtypes)["event_date"] == "date"


def test_orphan_segment_is_a_candidate_once_old(spark, tmp):
    store = SnapshotStore(spark, tmp)
    store.overwrite("t", labels(spark, "A"))
    # a write whose job died before its commit: data on disk, no commit record
    labels(spark, "LOST").write.parquet(f"{store.path('t')}/data/segment=1-deadbeef")
    assert [r.label for r in store.read("t").collect()] == ["A"]
    assert M.retention_candidates(store, "t").count() == 0  # too recent
    later = dt.datetime.now(UTC) + dt.timedelta(days=8)
    got = [(r.segment, r.last_version) for r in M.retention_candidates(store, "t", now=later).collect()]
    assert got == [("segment=1-deadbeef", None)]
    # the next real commit reuses no orphan name: it takes the next version number
    store.overwrite("t", labels(spark, "B"))
    assert store.latest_version("t") == 1


def test_history_last_n(spark, tmp):
    store = SnapshotStore(spark, tmp)
    for v in ("A", "B", "C"):
        store.overwrite("t", labels(spark, v))
    assert [r.version for r in store.history("t", limit=2).collect()] == [2, 1]


def test_rebalanced_write_splits_a_hot_partition_value(spark, tmp):
    from pyspark.sql import functions as F
    hot = F.when(F.col("id") % 10 < 9, F.lit("2017-07-03")).otherwise(
        F.concat(F.lit("2017-07-0"), (F.col("id") % 3 + 4).cast("string")))
    df = spark.range(0, 300_000).select(
        hot.cast("date").alias("event_date"), F.col("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    prior = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        store = SnapshotStore(spark, tmp)
        store.overwrite("t", df, ["event_date"])
    finally:
        spark.conf.set(key, prior)
    seg = store.commit("t").segments[0]
    files = spark.read.format("binaryFile").load(f"{store.path('t')}/data/{seg}") \
        .select("path", "event_date")
    per_date = {str(r.event_date): r["count"] for r in files.groupBy("event_date").count().collect()}
    assert per_date["2017-07-03"] > 1, per_date      # the hot value was split
    assert store.read("t").count() == 300_000        # nothing dropped


def test_compact_many_appends(spark, tmp):
    store = SnapshotStore(spark, tmp)
    store.overwrite("t", labels(spark, "A"))
    for v in ("B", "C", "D"):
        store.append("t", labels(spark, v))
    assert len(store.commit("t").segments) == 4
    version = store.compact("t")
    assert store.commit("t").segments and len(store.commit("t").segments) == 1
    assert store.commit("t", version).operation == "COMPACT"
    assert sorted(r.label for r in store.read("t").collect()) == ["A", "B", "C", "D"]
    assert store.compact("t") is None  # already one segment
