"""Edge fixtures: headers, dirt, timestamps, overflow, quantiles, layouts."""

from __future__ import annotations

import math
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from flowlake.functions.columns import (
    ColumnError, prepare_columns, resolve_aliases, sanitize_names, unique_names,
)
from flowlake.functions import cleaning as C
from flowlake.operators import aggregates as A
from flowlake.operators.clean import clean
from flowlake.operators.quantile import exact_percentile
from flowlake.operators.reconcile import fingerprint
from flowlake.sources import csv as S
from flowlake.sources.snapshots import SchemaMismatch, SnapshotStore

HEADER = " Flow Duration, Source IP, Timestamp, Flow Packets/s, Total Length of Fwd Packets, " \
         "Total Length of Bwd Packets, Label"


def write(dirpath: str, name: str, lines: list[str]) -> str:
    p = Path(dirpath) / name
    p.write_text("\n".join(lines) + "\n")
    return str(p)


def fact_of(spark, pattern):
    df, cols = prepare_columns(S.csv_scan(spark, pattern))
    return clean(df, cols)


def test_stray_header_different_from_file_header(spark, tmp):
    write(tmp, "Tuesday-a.csv", [
        HEADER,
        "1,10.0.0.1,4/7/2017 9:01,5,1,2,BENIGN",
        "Flow Duration,Source IP,Timestamp,Flow Packets/s,Total Length of Fwd Packets,"
        "Total Length of Bwd Packets,Label",
        "2,10.0.0.1,4/7/2017 9:02,Infinity,1,2,BENIGN",
    ])
    raw = S.csv_scan(spark, f"{tmp}/*.csv")
    assert dict(raw.dtypes)["Flow Packets/s"] == "double"
    fact = fact_of(spark, f"{tmp}/*.csv")
    rows = fact.orderBy("Flow_Duration").collect()
    assert [r["Flow_Duration"] for r in rows] == [1, 2]
    assert rows[1]["Flow_Packets/s"] is None


def test_files_with_different_headers_are_read_by_name(spark, tmp):
    write(tmp, "Monday-a.csv", ["Flow Duration,Label,Flow Packets/s", "1,BENIGN,3.5"])
    write(tmp, "Monday-b.csv", ["Flow Packets/s,Flow Duration,Label", "7.5,2,DDoS"])
    rows = {r["Flow Duration"]: r for r in S.csv_scan(spark, f"{tmp}/*.csv").collect()}
    assert rows[1]["Label"] == "BENIGN" and rows[1]["Flow Packets/s"] == 3.5
    assert rows[2]["Label"] == "DDoS" and rows[2]["Flow Packets/s"] == 7.5


def test_one_bad_cell_is_null_and_nothing_else(spark, tmp):
    write(tmp, "Monday-a.csv", [
        HEADER,
        "1234567890123456789,10.0.0.1,3/7/2017 9:01,n/a,1,2,BENIGN",
        "Flow Duration,Src IP,Timestamp,Flow Packets/s,TotLen Fwd Pkts,TotLen Bwd Pkts,Label",
        "2,10.0.0.1,3/7/2017 9:02,-Infinity,12.0,x,BENIGN",
        "3,10.0.0.1,3/7/2017 9:03,2.5,4,5,BENIGN"])
    raw = S.csv_scan(spark, f"{tmp}/*.csv")
    types = dict(raw.dtypes)
    assert (types["Flow Duration"], types["Flow Packets/s"]) == ("bigint", "double")
    rows = {r["Flow_Duration"]: r for r in fact_of(spark, f"{tmp}/*.csv").collect()}
    assert set(rows) == {1234567890123456789, 2, 3}
    assert rows[1234567890123456789]["Flow_Packets/s"] is None and rows[2]["Flow_Packets/s"] is None
    assert rows[2]["Total_Length_of_Fwd_Packets"] == 12 and rows[2]["Total_Length_of_Bwd_Packets"] is None
    assert exact_percentile(raw.select(F.col("Timestamp")), "Timestamp", 0.5) is None


def test_inference_keeps_every_digit(spark, tmp):
    write(tmp, "Monday-a.csv", ["Flow Duration,Label,A,B,C", "1,x,9223372036854775807,9223372036854775808,1e3",
                                "2,x,-5,7,8"])
    types = dict(S.csv_scan(spark, f"{tmp}/*.csv", infer=True).dtypes)
    assert (types["A"], types["B"], types["C"]) == ("bigint", "decimal(38,0)", "double")


def test_empty_captures_and_endless_headers(spark, tmp):
    from flowlake.operators import validate as V
    from flowlake.sources import captures
    Path(tmp, "Friday-empty.csv").write_text("")
    with pytest.raises(ValueError, match="empty"):
        S.csv_scan(spark, f"{tmp}/*.csv")
    write(tmp, "Monday-a.csv", [HEADER, "1,10.0.0.1,3/7/2017 9:01,1,1,1,BENIGN"])
    fact = fact_of(spark, f"{tmp}/*.csv")
    assert [r.match for r in V.validate_labels(spark, f"{tmp}/*.csv", fact).collect()] == [True]
    Path(tmp, "Monday-endless.csv").write_text("a" * (captures.HEADER_BYTES + (1 << 17)))
    with pytest.raises(ValueError, match="no line break"):
        S.csv_scan(spark, f"{tmp}/*.csv")


def test_gate_sees_a_row_in_the_wrong_file(spark, tmp):
    from flowlake.operators import validate as V
    for name in ("Monday-x.csv", "Tuesday-y.csv", "z.csv"):
        write(tmp, name, [HEADER, f"1,10.0.0.1,{'junk' if name == 'z.csv' else '3/7/2017 9:01'},1,1,1,BENIGN"])
    fact = fact_of(spark, f"{tmp}/*.csv")
    good = V.validate_labels(spark, f"{tmp}/*.csv", fact).collect()
    assert {r.source_name for r in good} == {"Monday-x.csv", "Tuesday-y.csv"} and all(r.match for r in good)
    moved = fact.withColumn("_source_file", F.regexp_replace("_source_file", "Monday-x", "Tuesday-y"))
    assert not any(r.match for r in V.validate_labels(spark, f"{tmp}/*.csv", moved).collect())


def test_duplicate_headers_are_suffixed_first_wins():
    names = unique_names(["Label", " Label", "Flow Duration"])
    assert names == ["Label", "Label__1", "Flow Duration"]
    assert resolve_aliases(names)["label"] == "Label"


def test_sanitize_collision_and_missing_required(spark):
    df = spark.createDataFrame([(1, 2, "x")], ["a b", "a_b", "Label"])
    with pytest.raises(ColumnError):
        sanitize_names(df, {})
    with pytest.raises(ColumnError):
        sanitize_names(spark.createDataFrame([(1, 2)], ["A b", "a_b"]), {})
    assert resolve_aliases(["tot fwd pkts", "Total Fwd Packets", "x"]) == {"total_fwd_packets": "Total Fwd Packets"}
    with pytest.raises(ColumnError):
        prepare_columns(spark.createDataFrame([("x",)], ["Label"]))


def test_blank_label_kept_as_attack_and_space_in_file_name(spark, tmp):
    write(tmp, "Monday x+y.csv", [HEADER, "1,10.0.0.1,3/7/2017 9:01,1,1,1,  ",
                                  "2,10.0.0.1,3/7/2017 9:01,1,1,1,BENIGN"])
    fact = fact_of(spark, f"{tmp}/*.csv")
    rows = {r["Flow_Duration"]: r for r in fact.collect()}
    assert rows[1]["label"] == "" and rows[1]["attack_category"] == "ATTACK"
    assert rows[2]["_source_file"].endswith("/Monday x+y.csv")
    assert S.rows_of_source_file(fact, "Monday x+y.csv").count() == 2
    assert S.rows_of_source_file(fact, "x+y.csv").count() == 0


def test_nonfinite_values_become_null(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),), (float("-inf"),), (float("nan"),), (None,)],
                               "r double")
    out = [r[0] for r in df.select(C.nonfinite_to_null(F.col("r"))).collect()]
    assert out == [1.0, None, None, None, None]


def test_timestamp_formats_and_junk(spark):
    values = ["3/7/2017 9:01", "3/7/2017 9:01:05", "7/3/2017 1:02:03 PM", "7/13/2017 13:02",
              "junk", None]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r[0] for r in df.select(C.parse_timestamp_multi(F.col("t"))).collect()]
    assert [str(g) if g else None for g in got] == [
        "2017-07-03 09:01:00", "2017-07-03 09:01:05", "2017-07-03 13:02:03",
        "2017-07-13 13:02:00", None, None]


def test_filename_date_last_keyword_wins(spark):
    df = spark.createDataFrame([("/x/Monday/Friday-a.csv",), ("/x/monday.csv",), ("/x/sat.csv",)],
                               "p string")
    got = [str(r[0]) if r[0] else None for r in df.select(C.date_from_path(F.col("p"))).collect()]
    assert got == ["2017-07-07", "2017-07-03", None]


def test_folder_names_set_no_date(spark):
    df = spark.createDataFrame([("/friday-backfill/Monday-x.csv",), ("/friday/x.csv",),
                                ("/r/capture=Tuesday-friday.csv/part-0.csv",)], "p string")
    got = [str(r[0]) if r[0] else None for r in df.select(C.date_from_path(F.col("p"))).collect()]
    assert got == ["2017-07-03", None, "2017-07-07"]


def test_byte_sum_overflow_is_null_not_failure(spark):
    big = 2 ** 63 - 1
    df = spark.createDataFrame([(big, 1), (1, 2)], "f long, b long")
    got = [r[0] for r in df.select(C.flow_bytes(F.col("f"), F.col("b"))).collect()]
    assert got == [None, 3]


def _brute(values, p):
    xs = sorted(v for v in values if v is not None)
    if not xs:
        return None
    k = min(len(xs), max(1, math.ceil(p * len(xs))))
    return xs[k - 1]


@pytest.mark.parametrize("n", [1, 4, 101, 1000, 5003])
def test_exact_percentile_matches_brute_force(spark, n):
    rnd = random.Random(n)
    values = [round(rnd.paretovariate(1.1), 3) if i % 5 else float(rnd.randint(1, 4))
              for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for p in (0.0, 0.01, 0.25, 0.5, 0.99, 1.0):
        want = _brute(values, p)
        assert exact_percentile(df, "x", p) == want
        assert exact_percentile(df, "x", p, rounds=5, buckets=4) == want
        assert exact_percentile(df, "x", p, rounds=0) == want
        sql = df.selectExpr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY x)").first()[0]
        assert sql == want


def test_percentile_of_empty_and_all_null(spark):
    assert exact_percentile(spark.createDataFrame([(None,)], "x double"), "x", 0.99) is None
    assert exact_percentile(spark.createDataFrame([], "x double"), "x", 0.99) is None


def test_fingerprint_independent_of_partitioning(spark):
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("a"), F.col("id").cast("string").alias("b"))
    prints = {tuple(fingerprint(df.repartition(n)).first()) for n in (1, 3, 7)}
    assert len(prints) == 1


def test_all_null_partition_column_keeps_type(spark, tmp):
    store = SnapshotStore(spark, tmp)
    df = spark.createDataFrame([(1, None), (2, None)], "id long, d date")
    store.overwrite("t", df, ["d"])
    back = store.read("t")
    assert dict(back.dtypes)["d"] == "date"
    assert back.count() == 2


def test_append_with_extra_column(spark, tmp):
    store = SnapshotStore(spark, tmp)
    store.overwrite("t", spark.createDataFrame([(1,), (2,)], "id long"))
    extra = spark.createDataFrame([(3, 0.5)], "id long, score double")
    with pytest.raises(SchemaMismatch):
        store.append("t", extra)
    assert store.latest_version("t") == 0
    store.append("t", extra, merge_schema=True)
    rows = sorted(tuple(r) for r in store.read("t").collect())
    assert rows == [(1, None), (2, None), (3, 0.5)]
    assert store.read("t", version=0).columns == ["id"]


def test_window_counts_group_null_source_ip(spark):
    rows = [(None, "BENIGN", "2024-01-01 00:01:00", 1, 1, "BENIGN"),
            (None, "BENIGN", "2024-01-01 00:02:00", 1, 1, "BENIGN")]
    df = spark.createDataFrame(rows, "ip string, label string, t string, f long, b long, "
                                     "cat string").select(
        "ip", "label", F.col("t").cast("timestamp_ntz").alias("event_time"), "f", "b",
        F.col("cat").alias("attack_category"))
    out = A.src_ip_window_counts(df, {"source_ip": "ip", "total_len_fwd_packets": "f",
                                      "total_len_bwd_packets": "b"}).collect()
    assert len(out) == 1 and out[0].source_ip is None and out[0].flow_count == 2


def test_quoted_commas_and_missing_columns(spark, tmp):
    from flowlake.operators import validate as V
    write(tmp, "Monday-a.csv", ['Flow Duration,Source IP,Label',
                                '1,10.0.0.1,"Web Attack, Brute Force"',
                                '2,10.0.0.2,BENIGN'])
    write(tmp, "Monday-b.csv", ["Flow Duration,Label", "3,BENIGN"])
    raw = S.csv_scan(spark, f"{tmp}/*.csv")
    rows = {r["Flow Duration"]: r for r in raw.collect()}
    assert rows[1]["Label"] == "Web Attack, Brute Force"
    assert rows[3]["Source IP"] is None
    fact = fact_of(spark, f"{tmp}/*.csv")
    checked = {(r.source_name, r.label): (r.raw_flow_count, r.fact_flow_count, r.match)
               for r in V.validate_labels(spark, f"{tmp}/*.csv", fact).collect()}
    assert checked == {("Monday-a.csv", "Web Attack, Brute Force"): (1, 1, True),
                       ("Monday-a.csv", "BENIGN"): (1, 1, True), ("Monday-b.csv", "BENIGN"): (1, 1, True)}


def test_inferred_types_ignore_stray_headers(spark, tmp):
    write(tmp, "Monday-a.csv", ["Flow Duration,Rate,Name,Label",
                                "1,2.5,a,BENIGN", "Flow Duration,Rate,Name,Label",
                                "2,NaN,b,BENIGN"])
    assert dict(S.csv_scan(spark, f"{tmp}/*.csv").dtypes)["Rate"] == "string"
    types = dict(S.csv_scan(spark, f"{tmp}/*.csv", infer=True).dtypes)
    assert types == {"Flow Duration": "bigint", "Rate": "double", "Name": "string",
                     "Label": "string", "_source_file": "string"}


def test_declared_header_skips_header_reads(spark, tmp):
    write(tmp, "Monday-a.csv", [HEADER, "1,10.0.0.1,3/7/2017 9:01,1,1,1,BENIGN"])
    declared = S.csv_scan(spark, f"{tmp}/*.csv", header=HEADER).drop("_source_file")
    grouped = S.csv_scan(spark, f"{tmp}/*.csv").drop("_source_file")
    assert declared.collect() == grouped.collect()


def test_difference_counts_match_except_all(spark):
    from flowlake.operators.reconcile import (
        difference_counts, except_all_both_ways, multiset_equal, table_equality,
    )
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (2, None), (2, None), (4, "d")], "k int, v string")
    diff = {(r.k, r.v): (r.left_rows, r.right_rows) for r in difference_counts(left, right).collect()}
    assert diff == {(1, "a"): (2, 1), (2, None): (1, 2), (3, "c"): (1, 0), (4, "d"): (0, 1)}
    rows = except_all_both_ways(left, right).collect()
    assert sorted((r.side, r.k) for r in rows) == [("left", 1), ("left", 3), ("right", 2), ("right", 4)]
    eq = table_equality(left, right).first()
    assert (eq.only_left, eq.only_right, eq.equal) == (2, 2, False)
    assert multiset_equal(left, left.orderBy("k"))
    assert table_equality(left, left).first().equal


def test_gzipped_captures(spark, tmp):
    import gzip
    body = "\n".join([HEADER, "1,10.0.0.1,3/7/2017 9:01,1.5,1,1,BENIGN",
                      "2,10.0.0.2,3/7/2017 9:02,2.5,1,1,DDoS"]) + "\n"
    with gzip.open(Path(tmp) / "Monday-a.csv.gz", "wt") as f:
        f.write(body)
    raw = S.csv_scan(spark, f"{tmp}/*.csv.gz")
    assert dict(raw.dtypes)["Flow Packets/s"] == "double"
    fact = fact_of(spark, f"{tmp}/*.csv.gz")
    assert sorted(r.label for r in fact.collect()) == ["BENIGN", "DDoS"]
    assert S.raw_line_count(spark, f"{tmp}/*.csv.gz").first()[0] == 2


def test_exact_percentile_mixed_signs_and_ties(spark):
    rnd = random.Random(7)
    values = ([rnd.choice([-1.0, 1.0]) * rnd.paretovariate(0.8) for _ in range(700)]
              + [0.0] * 50 + [-3.5] * 120 + [1e-300, -1e-300, 2.0 ** 70])
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for p in (0.0, 0.1, 0.37, 0.5, 0.9, 1.0):
        want = _brute(values, p)
        assert exact_percentile(df, "x", p) == want
        assert exact_percentile(df, "x", p, rounds=4, buckets=3) == want


def test_byte_order_mark_in_header(spark, tmp):
    p = Path(tmp) / "Monday-bom.csv"
    p.write_text("\ufeff" + HEADER + "\n1,10.0.0.1,3/7/2017 9:01,1,1,1,BENIGN\n", encoding="utf-8")
    fact = fact_of(spark, f"{tmp}/*.csv")
    assert [r["Flow_Duration"] for r in fact.collect()] == [1]


def test_guards_raise(spark, tmp):
    from flowlake.sources.snapshots import TableNotFound
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        exact_percentile(df, "x", 1.5)
    with pytest.raises(ValueError):
        exact_percentile(df, "x", 0.5, buckets=1)
    store = SnapshotStore(spark, tmp)
    with pytest.raises(TableNotFound):
        store.append("missing", df)
    with pytest.raises(SchemaMismatch):
        store.overwrite("t", spark.createDataFrame([(1,)], "segment long"))
