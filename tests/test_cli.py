"""The command line drives the same library calls (in-process session)."""

from __future__ import annotations

import json
import shutil

from paths import FIXTURE_DIR
from flowlake.__main__ import main


def test_cli_transform_validate_export_retain_publish(spark, tmp, capsys):
    raw = f"{tmp}/raw"
    shutil.copytree(FIXTURE_DIR, raw)
    root, target = f"{tmp}/tables", f"{tmp}/export"
    assert main(["transform", "--raw", f"{raw}/*.csv", "--root", root,
                 "--plans-dir", f"{tmp}/plans", "--metrics", f"{tmp}/metrics.json"]) == 0
    report = json.loads(capsys.readouterr().out)
    assert json.load(open(f"{tmp}/metrics.json")) == report
    assert "Physical Plan" in open(f"{tmp}/plans/label_counts.txt").read()
    assert report["cleaned_rows"] == 10 and report["threshold_packets_per_sec"] == 6.5
    assert main(["validate", "--raw", f"{raw}/*.csv", "--root", root]) == 0
    assert json.loads(capsys.readouterr().out)["passed"] is True
    assert main(["export", "--root", root, "--target", target]) == 0
    exported = {r["table"]: r["row_count"] for r in json.loads(capsys.readouterr().out)}
    assert exported["network_events"] == 10
    assert main(["warehouse", "--root", root, "--target", f"{tmp}/wh", "--date", "2024-02-01"]) == 0
    loaded = {r["table"]: r["row_count"] for r in json.loads(capsys.readouterr().out)}
    assert loaded["label_counts"] == 3
    assert main(["retain", "--root", root, "--run-id", "r1"]) == 0
    capsys.readouterr()
    assert main(["publish", "--root", root, "--run-id", "r1"]) == 0
    manifest = {r["table"]: r["row_count"] for r in json.loads(capsys.readouterr().out)}
    assert manifest["label_counts"] == 3
    assert main(["evolve", "--root", root, "--demo-root", f"{tmp}/demo"]) == 0
    assert json.loads(capsys.readouterr().out)["passed"] is True


def test_cli_transform_with_declared_types_and_header(spark, tmp, capsys):
    raw = f"{tmp}/raw"
    shutil.copytree(FIXTURE_DIR, raw)
    header = open(f"{raw}/Monday-fixture.csv").readline().rstrip("\n")
    types = {"Flow Duration": "bigint", "Flow Packets/s": "double",
             "Total Length of Fwd Packets": "bigint", "Total Length of Bwd Packets": "bigint"}
    assert main(["transform", "--raw", f"{raw}/*.csv", "--root", f"{tmp}/t",
                 "--types", json.dumps(types), "--header", header]) == 0
    report = json.loads(capsys.readouterr().out)
    assert report["cleaned_rows"] == 10 and report["threshold_packets_per_sec"] == 6.5
