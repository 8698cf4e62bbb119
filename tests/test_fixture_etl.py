"""End-to-end on the golden 12-row capture: expected values fixed by hand."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from paths import FIXTURE_DIR
from flowlake.operators import aggregates as A
from flowlake.operators import evolution as EV
from flowlake.operators import maintenance as M
from flowlake.operators import validate as V
from flowlake.operators.reconcile import except_all_both_ways
from flowlake.plans.transform import run_transform
from flowlake.sources import csv as S
from flowlake.sources.snapshots import SnapshotStore, TableNotFound


@pytest.fixture(scope="module")
def raw_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    shutil.copy(FIXTURE_DIR / "Monday-fixture.csv", d / "Monday-fixture.csv")
    return str(d)


@pytest.fixture(scope="module")
def run(spark, raw_dir, tmp_path_factory):
    store = SnapshotStore(spark, str(tmp_path_factory.mktemp("delta")))
    report = run_transform(spark, S.csv_scan(spark, f"{raw_dir}/*.csv"), store)
    return store, report


def test_cleaned_rows_and_nulls(run):
    store, report = run
    events = store.read("network_events")
    assert events.count() == 10
    assert report.first()["cleaned_rows"] == 10
    assert events.where(F.col("Flow_Packets/s").isNull()).count() == 2


def test_label_counts(run):
    store, _ = run
    rows = store.read("label_counts").collect()
    assert {r.label: r.flow_count for r in rows} == {"BENIGN": 5, "Bot": 4, "Infiltration": 1}
    assert {str(r.event_date) for r in rows} == {"2017-07-03"}


def test_anomaly_threshold(run):
    store, report = run
    rows = store.read("anomaly_threshold_counts").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.label, r.source_ip, r.anomalous_flow_count, r.threshold_packets_per_sec) == \
        ("Bot", "198.51.100.9", 3, 6.5)
    assert report.first()["threshold_packets_per_sec"] == 6.5


def test_window_counts(run):
    store, _ = run
    rows = store.read("src_ip_window_counts").collect()
    assert sorted((r.source_ip, r.flow_count, r.total_bytes, r.attack_flow_count) for r in rows) == [
        ("198.51.100.7", 3, 42, 0),
        ("198.51.100.8", 1, 3, 0),
        ("198.51.100.8", 1, 7, 1),
        ("198.51.100.8", 1, 111, 0),
        ("198.51.100.9", 1, 10, 1),
        ("198.51.100.9", 3, 285, 3),
    ]
    assert {str(r.window_date) for r in rows} == {"2017-07-03"}


def test_all_null_rates_give_no_anomaly_table(run):
    store, _ = run
    events = store.read("network_events").withColumn("Flow_Packets/s", F.lit(None).cast("double"))
    assert A.anomaly_threshold_counts(events, {"flow_packets_per_sec": "Flow_Packets/s"}) is None


def test_validation_matches(spark, run, raw_dir):
    store, _ = run
    fact = store.read("network_events")
    labels = V.validate_labels(spark, f"{raw_dir}/*.csv", fact).collect()
    assert all(r.match for r in labels)
    assert {r.label: r.raw_flow_count for r in labels} == {"BENIGN": 5, "Bot": 4, "Infiltration": 1}
    structure = V.validate_structure(S.raw_line_count(spark, f"{raw_dir}/*.csv"), fact).first()
    assert (structure.raw_rows, structure.cleaned_rows, structure.passed) == (12, 10, True)


def test_export_twice_is_idempotent(spark, run, tmp):
    src, _ = run
    target = SnapshotStore(spark, tmp)
    first = {r.table: r for r in M.export_tables(src, target).collect()}
    second = {r.table: r for r in M.export_tables(src, target).collect()}
    for name in M.TABLES:
        diff = except_all_both_ways(src.read(name), target.read(name))
        assert diff.isEmpty(), name
        assert first[name].row_count == second[name].row_count
    assert target.latest_version("label_counts") == 1


def test_evolution_and_time_travel(spark, run, tmp):
    src, _ = run
    demo = SnapshotStore(spark, tmp).namespace("demo")
    assert EV.seed_copy(src, demo)
    assert not EV.seed_copy(src, demo)
    info = EV.column_evolution(demo, "network_events", src.read("network_events"))
    check = EV.evolution_check(demo, "network_events", info["before_version"]).first()
    assert (check.before_rows, check.after_rows, check.null_rows) == (10, 13, 10)
    assert check.passed
    old = demo.read("network_events", snapshot_id=info["before_snapshot_id"])
    assert EV.NEW_COLUMN not in old.columns and old.count() == 10
    assert src.read("network_events").count() == 10, "demo mutated the transform output"
    ops = [r.operation for r in demo.history("network_events").collect()]
    assert ops == ["CREATE", "ADD COLUMNS", "APPEND"]


def test_merge_schema_append(spark, run, tmp):
    src, _ = run
    demo = SnapshotStore(spark, tmp)
    EV.seed_copy(src, demo)
    info = EV.merge_evolution(demo, "network_events", demo.read("network_events"))
    assert info["blocked"]
    cur = demo.read("network_events")
    assert cur.count() == 13
    assert cur.where(F.col(EV.NEW_COLUMN).isNull()).count() == 10
    assert EV.NEW_COLUMN not in demo.read("network_events", version=0).columns


def test_stale_optional_tables_removed(spark, raw_dir, tmp):
    store = SnapshotStore(spark, tmp)
    run_transform(spark, S.csv_scan(spark, f"{raw_dir}/*.csv"), store)
    assert store.present("src_ip_window_counts")
    # same capture without source IP and rate columns: optional outputs go
    raw = S.csv_scan(spark, f"{raw_dir}/*.csv").drop("Source IP", "Flow Packets/s")
    run_transform(spark, raw, store)
    for name in ("src_ip_window_counts", "anomaly_threshold_counts"):
        assert not store.present(name)
        with pytest.raises(TableNotFound):
            store.read(name)
    target = SnapshotStore(spark, tmp + "/export")
    report = {r.table: r.present for r in M.export_tables(store, target).collect()}
    assert report == {"network_events": True, "label_counts": True,
                      "src_ip_window_counts": False, "anomaly_threshold_counts": False}


def test_cache_modes_agree(spark, raw_dir, tmp):
    outs = []
    for mode in ("full", "narrow", "none"):
        store = SnapshotStore(spark, f"{tmp}/{mode}")
        report = run_transform(spark, S.csv_scan(spark, f"{raw_dir}/*.csv"), store, cache_mode=mode)
        assert report.first()["cleaned_rows"] == 10
        outs.append(store.read("src_ip_window_counts"))
    assert except_all_both_ways(outs[0], outs[1]).isEmpty()
    assert except_all_both_ways(outs[1], outs[2]).isEmpty()


def test_plan_capture_prunes_columns(spark, run):
    from flowlake.plans.transform import plan_text
    store, _ = run
    df = A.label_counts(store.read("network_events"))
    text = plan_text(df, "formatted")
    assert "ReadSchema: struct<label:string>" in text


def test_unclustered_fact_write_gives_same_tables(spark, run, raw_dir, tmp):
    src, _ = run
    store = SnapshotStore(spark, tmp)
    run_transform(spark, S.csv_scan(spark, f"{raw_dir}/*.csv"), store, cluster_fact=False)
    for name in M.TABLES:
        assert except_all_both_ways(src.read(name), store.read(name)).isEmpty(), name


def test_transform_leaves_session_settings_alone(spark, raw_dir, tmp):
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(key, None)
    run_transform(spark, S.csv_scan(spark, f"{raw_dir}/*.csv"), SnapshotStore(spark, tmp))
    assert spark.conf.get(key, None) == before


def test_plan_capture_with_concurrent_writes_restores_stdout(spark, raw_dir, tmp):
    import sys
    before = sys.stdout
    plans: dict[str, str] = {}
    for i in range(3):
        run_transform(spark, S.csv_scan(spark, f"{raw_dir}/*.csv"),
                      SnapshotStore(spark, f"{tmp}/{i}"), plans=plans)
        assert sys.stdout is before
    assert set(plans) == set(M.TABLES)
    assert all("Physical Plan" in text for text in plans.values())
