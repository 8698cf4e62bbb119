"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as E  # noqa: E402
from compare import TABLES, digest  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not present")

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return c


def test_registry_is_consistent():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 76


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    assert rows, f"{key} returned no rows"
    if key not in ORACLE:
        return
    res = con.execute(ORACLE[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns) == digest(orows, ocols)


def test_entry_runs(spark):
    out = E.entry(spark)
    assert out.columns == ["event_date", "source_ip", "label", "anomalous_flow_count",
                           "threshold_packets_per_sec"]
    assert out.count() >= 0
