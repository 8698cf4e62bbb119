"""The captures table and header reads by Spark tasks."""

from __future__ import annotations

import datetime as dt
import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from flowlake.sources import captures as cap
from flowlake.sources import csv as S

HEADER = " Flow Duration, Label"


def test_ten_thousand_small_captures_are_grouped_by_tasks(spark, tmp, monkeypatch):
    for i in range(10_000):
        Path(tmp, f"Monday-{i:05d}.csv").write_text(f"{HEADER}{', Extra' if i % 1000 == 7 else ''}\n{i},BENIGN\n")
    groups = S.header_groups(spark, f"{tmp}/*.csv")
    assert {h: len(files) for h, files in groups.items()} == {HEADER: 9_990, f"{HEADER}, Extra": 10}
    assert sorted(p for files in groups.values() for p in files) == [f"file:{tmp}/Monday-{i:05d}.csv" for i in range(10_000)]


def test_long_and_short_files_give_the_same_lines(spark, tmp):
    texts = {"a,b.csv": "x,y\n1,2\n" * 50, "Friday c d+e%.csv": "﻿p\r\nq\r\n" * 9, "empty.csv": "", "one.csv": "alone"}
    for name, text in texts.items():
        Path(tmp, name).write_text(text)
    with gzip.open(f"{tmp}/z.csv.gz", "wt") as f:
        f.write("zipped\n" * 100)
    found = {}
    for limit in (20, cap.HEADER_BYTES):             # all but "one.csv" are long for the first
        rows = cap.captures(spark, f"{tmp}/*", header_bytes=limit).collect()
        found[limit] = {r["capture"]: (r["header"] or "").lstrip("﻿") for r in rows}
    assert found[20] == found[cap.HEADER_BYTES] == {
        "a,b.csv": "x,y", "Friday c d+e%.csv": "p", "empty.csv": "", "one.csv": "alone", "z.csv.gz": "zipped"}
    with pytest.raises(cap.NoHeader):
        cap.captures(spark, f"{tmp}/a,b*.csv", header_bytes=2)


def test_rows_meet_their_file(spark, tmp):
    Path(tmp, "capture=Tuesday x+%y.csv").mkdir()
    Path(tmp, "capture=Tuesday x+%y.csv", "part-0.csv").write_text(f"{HEADER}\n1,A\n2,B\n")
    Path(tmp, "other.csv").mkdir()
    Path(tmp, "other.csv", "Friday.csv").write_text(f"{HEADER}\n3,A\n")
    files = cap.captures(spark, f"{tmp}/*/*.csv")
    got = {r["capture"]: (r["capture_date"], r["file_size"], r["header"]) for r in files.collect()}
    assert got == {"Tuesday x+%y.csv": (dt.date(2017, 7, 4), 30, HEADER), "Friday.csv": (dt.date(2017, 7, 7), 26, HEADER)}
    counted = S.raw_line_counts(spark, f"{tmp}/*/*.csv")
    assert {r["capture"]: r["raw_rows"] for r in cap.by_file(counted, files).collect()} == {
        "Tuesday x+%y.csv": 2, "Friday.csv": 1}
    raw = S.csv_scan(spark, f"{tmp}/*/*.csv")
    assert S.rows_of_source_file(raw, "Tuesday x+%y.csv").count() == 2
    assert raw.join(files, raw["_source_file"].endswith(F.col("capture"))).count() == 1
    smallest = S.smallest_file(spark, f"{tmp}/*/*.csv").first()
    assert (smallest["capture"], smallest["file_size"]) == ("Friday.csv", 26)


def test_quoted_line_feeds_are_one_record(spark, tmp):
    texts = {"a.csv": 'x,y\n1,"two\nlines"\n2,"q \\" and\n\n three\\\\"\n\n3,plain\n4,"doubled "" quote\nhere"\n',
             "b.csv": 'x,y\n1,"never closed\n2,b\n3,c\n', "c.csv": "x,y\n", "d.csv": "x,y\n1,2\n  \n\n3,4\n"}
    for name, text in texts.items():
        Path(tmp, name).write_text(text)
    got = {r["file_path"].rsplit("/", 1)[1]: (r["raw_rows"], r["records"])
           for r in S.raw_record_counts(spark, f"{tmp}/*.csv").collect()}
    assert got == {"a.csv": (9, 4), "b.csv": (3, 1), "c.csv": (0, 0), "d.csv": (4, 2)}


def test_records_are_counted_across_splits(spark, tmp):
    Path(tmp, "big.csv").write_text("x,y\n" + "".join(f'{i},"a\n{"b" * (i % 40)}\nc"\n' for i in range(4000)))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000")
    try:
        assert tuple(S.raw_record_count(spark, f"{tmp}/*.csv").first()) == (12_000, 4000)
        assert S.raw_record_counts(spark, f"{tmp}/*.csv").count() == 1
    finally:
        spark.conf.set(key, before)
