"""Plan-shape regressions: pushdown, pruning and partial aggregation."""

from __future__ import annotations

import shutil

import pytest

from paths import FIXTURE_DIR
from flowlake.functions.columns import prepare_columns
from flowlake.operators import aggregates as A
from flowlake.operators.clean import fact_columns
from flowlake.plans.transform import plan_text, run_transform
from flowlake.sources import csv as S
from flowlake.sources.snapshots import SnapshotStore


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw")
    shutil.copy(FIXTURE_DIR / "Monday-fixture.csv", raw / "Monday-fixture.csv")
    store = SnapshotStore(spark, str(tmp_path_factory.mktemp("tables")))
    scan = S.csv_scan(spark, f"{raw}/*.csv")
    run_transform(spark, scan, store)
    _, cols = prepare_columns(scan)
    return store.read("network_events"), fact_columns(cols)


def test_anomaly_threshold_is_a_pushed_filter(fact):
    df, cols = fact
    text = plan_text(A.anomaly_threshold_counts(df, cols, 4.0), "formatted")
    assert "GreaterThan(`Flow_Packets/s`,4.0)" in text
    assert "ReadSchema: struct<Source_IP:string,Flow_Packets/s:double,label:string>" in text
    assert "partial_count" in text


def test_benign_rates_prune_partitions_and_columns(fact):
    df, _ = fact
    text = plan_text(A.benign_rates(df, "Flow_Packets/s"), "formatted")
    assert "PartitionFilters: [isnotnull(attack_category" in text and "= BENIGN)" in text
    assert "ReadSchema: struct<Flow_Packets/s:double>" in text


def test_window_counts_aggregate_partially_before_the_shuffle(fact):
    df, cols = fact
    text = plan_text(A.src_ip_window_counts(df, cols), "formatted")
    # node details are listed bottom-up: partial aggregate, exchange, final aggregate
    assert text.index("partial_count") < text.index("Arguments: hashpartitioning")
    assert "PushedFilters: [IsNotNull(event_time)]" in text


def test_no_python_udfs_in_the_cleaning_plan(spark, tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw2")
    shutil.copy(FIXTURE_DIR / "Monday-fixture.csv", raw / "Monday-fixture.csv")
    from flowlake.plans.facts import build_fact
    clean, _ = build_fact(S.csv_scan(spark, f"{raw}/*.csv"))
    text = plan_text(clean, "formatted")
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "Exchange" not in text  # cleaning never shuffles


def test_cleaning_parses_once_and_runs_no_pattern_over_paths(spark, tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw3")
    shutil.copy(FIXTURE_DIR / "Monday-fixture.csv", raw / "Monday-fixture.csv")
    from flowlake.plans.facts import build_fact
    clean, _ = build_fact(S.csv_scan(spark, f"{raw}/*.csv"))
    physical = plan_text(clean, "extended").split("== Physical Plan ==")[1]
    assert "regexp_extract" not in physical
    assert physical.count("as timestamp_ntz") == 3       # three patterns, each cast in one place
    assert physical.count("substring_index") == 5        # the capture's name, worked out in one place
