"""Fingerprints kept by writes, bucketed digests, retention by property, clustered loads."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowlake.operators import maintenance as M
from flowlake.operators import reconcile as R
from flowlake.sources.snapshots import SnapshotStore


def rows(spark, values, schema="k long, v string"):
    return spark.createDataFrame(values, schema)


def test_versions_are_compared_without_reading_rows(spark, tmp):
    store = SnapshotStore(spark, tmp)
    df = rows(spark, [(i % 7, f"v{i % 5}") for i in range(100)] + [(None, None)] * 3)
    store.overwrite("a", df.repartition(4))
    store.overwrite("b", df.where("k < 3").repartition(2))
    store.append("b", df.where("not coalesce(k < 3, false)"))
    assert store.fingerprint("a") == store.fingerprint("b")
    assert store.fingerprint("a") == tuple(R.fingerprint(df).first())
    assert store.fingerprint("b", 0) != store.fingerprint("b", 1)
    store.add_column("b", "extra", "double")                 # null in every row: the rows stay what they were
    assert store.fingerprint("b") == store.fingerprint("a") == tuple(R.fingerprint(store.read("b")).first())
    store.compact("b")
    assert store.fingerprint("b") == store.fingerprint("a")
    store.overwrite("empty", df.limit(0))
    assert store.fingerprint("empty") == (0, 0, None, None)


def test_an_export_of_other_rows_is_refused(spark, tmp):
    store = SnapshotStore(spark, tmp)
    store.overwrite("a", rows(spark, [(1, "x"), (2, "y")]))
    store.overwrite("b", rows(spark, [(1, "x"), (2, "z")]))
    M.fingerprint_check(store.commit("a"), store.commit("a"), "a")
    with pytest.raises(M.RowCountMismatch):
        M.fingerprint_check(store.commit("a"), store.commit("b"), "a")


@pytest.mark.parametrize("buckets", [1, 5, 4096])
def test_digests_drill_down_to_the_differing_rows(spark, buckets):
    left = rows(spark, [(i % 50, f"v{i % 3}") for i in range(400)] + [(None, "n")] * 2 + [(1, None)])
    right = left.union(rows(spark, [(7, "v0"), (7, "v0"), (99, "new")])).exceptAll(rows(spark, [(None, "n"), (1, None)]))
    want = {tuple(r) for r in R.difference_counts(left, right).collect()}
    assert {tuple(r) for r in R.drilled_differences(left, right, buckets).collect()} == want and len(want) == 4
    assert R.drilled_differences(left, left.repartition(3), buckets).isEmpty()
    assert R.multiset_equal(left, left.repartition(3)) and not R.multiset_equal(left, right)
    both = sorted(map(tuple, R.except_all_both_ways(left, right).collect()), key=str)
    assert both == sorted([("left", None, "n"), ("left", 1, None), ("right", 7, "v0"), ("right", 7, "v0"),
                           ("right", 99, "new")], key=str)


def test_equal_tables_shuffle_digests_only(spark):
    left = rows(spark, [(i, "x" * 50) for i in range(1000)])
    plan = R.differing_buckets(left, left.repartition(3))._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "hashpartitioning" in line:
            assert "hashpartitioning(bucket" in line


def test_each_table_keeps_files_for_its_own_period(spark, tmp):
    store = SnapshotStore(spark, tmp)
    for name in M.REQUIRED_TABLES:
        for k in range(3):
            store.overwrite(name, rows(spark, [(k, "x")] * (k + 1)))
    long = {"network_events": {"deleted_file_retention": "interval 2 weeks"}}
    now = dt.datetime.now(dt.timezone.utc)

    def removed(days):
        audit = M.retention_apply(store, f"run {days}/é", now=now + dt.timedelta(days=days), properties=long)
        return {r["table"]: r["removed_count"] for r in audit.where("status = 'complete' and present").collect()}

    assert removed(8) == {"network_events": 0, "label_counts": 2}
    assert removed(15) == {"network_events": 2, "label_counts": 0}
    assert M.audit_gate(store, "run 15/é").count() == 4
    # superseded records go after the log's own period, oldest first; the current version never does
    assert store.versions("label_counts")[:3] == [0, 1, 2]
    removed(31)
    assert store.versions("label_counts") == [2] and store.read("label_counts").count() == 3
    store.append("label_counts", rows(spark, [(9, "y")]))
    assert store.read("label_counts").count() == 4 and store.latest_version("label_counts") == 3


def test_expired_records_wait_for_their_segments(spark, tmp):
    store = SnapshotStore(spark, tmp)
    for k in range(3):
        store.overwrite("t", rows(spark, [(k, "x")]), properties={"deleted_file_retention": "interval 60 days"})
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=31)
    assert [r["version"] for r in M.expired_records(store, "t", later).collect()] == [0, 1]
    M._forget_records(store, "t", later)
    assert store.versions("t") == [0, 1, 2]              # their segments are still there
    with pytest.raises(ValueError):
        store.forget("t", 2)


def test_a_hot_label_is_spread_and_files_overlap_nowhere_else(spark, tmp):
    src, target = SnapshotStore(spark, f"{tmp}/src"), SnapshotStore(spark, f"{tmp}/dst")
    df = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("l"), F.col("id") % 40)).alias("label"))
    for name in M.REQUIRED_TABLES:
        src.overwrite(name, df.repartition(6))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        loaded = {r["table"]: r for r in M.warehouse_export(src, target, dt.date(2024, 1, 2)).collect()}
    finally:
        spark.conf.set(key, "true")
    assert loaded["label_counts"]["target"].endswith("label_counts/ingest_date=2024-01-02")
    assert loaded["label_counts"]["target_version"] == 0 and loaded["label_counts"]["row_count"] == 30_000
    assert M.overlapping_files(target, "label_counts").isEmpty() and M.unordered_files(target, "label_counts").isEmpty()
    placed = M._placed_rows(target, "label_counts", "label").groupBy("file_path").agg(F.collect_set("__v").alias("v"))
    assert sum("hot" in r["v"] for r in placed.collect()) > 1
    shuffled = SnapshotStore(spark, f"{tmp}/mixed")
    shuffled.overwrite("label_counts", df.repartition(6))
    assert not M.overlapping_files(shuffled, "label_counts").isEmpty()
