"""File sources: slices of scans, pending work, CSV files, and streams of files."""

import pytest

from folioframe.sources import csv, scans
from folioframe.streaming.ingest import ingest


def test_slices_of_scans(spark, tmp_path):
    for k in (3, 1, 2, 0, 4):
        (tmp_path / f"s{k}.jpg").write_bytes(bytes([k]))
    (tmp_path / "other.txt").write_bytes(b"x")
    got = lambda **o: sorted(bytes(r.content)[0] for r in scans.scans(spark, str(tmp_path), **o).collect())
    assert got() == [0, 1, 2, 3, 4] and got(start=1, end=3) == [1, 2] and got(start=2) == [2, 3, 4]
    assert got(start=1, limit=2) == [1, 2] and got(start=1, end=4, limit=9) == [1, 2, 3] and got(start=2, end=2) == [] and got(limit=0) == []
    for wrong in ({"start": -1}, {"start": 2, "end": 1}):
        with pytest.raises(ValueError):
            got(**wrong)


def test_pending_work(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "sample_id string")
    assert sorted(r.sample_id for r in scans.pending(ids("a", "b", "c", "c"), ids("b", "b")).collect()) == ["a", "c", "c"]


def test_csv_in_parts_and_with_a_mark(spark, tmp_path):
    df = spark.range(40).selectExpr("cast(id as string) a", "'x' b").repartition(4)
    csv.write_csv(df, f"{tmp_path}/many", ["a", "b"], files=None)
    assert len(list((tmp_path / "many").glob("part-*"))) == 4
    assert csv.read_csv(spark, f"{tmp_path}/many", ["a", "b"]).count() == 40
    (tmp_path / "bom.csv").write_bytes("﻿a,b\n1,é\n".encode())
    assert [tuple(r) for r in csv.read_csv(spark, f"{tmp_path}/bom.csv", ["a", "b"]).collect()] == [("1", "é")]


def test_stream_reads_each_file_once(spark, tmp_path):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n"
    rows = "".join(f"5\t1\t1\t1\t1\t{k}\t{10 * k}\t4\t8\t20\t91\tw{k}\n" for k in range(1, 4))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.tsv").write_text(head + rows)
    run = lambda: ingest(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/check")
    run()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3
    (tmp_path / "in" / "b.tsv").write_text(head + "5\t2\t1\t1\t1\t1\t7\t4\t8\t20\t91\tnew\n4\t2\t1\t1\t1\t1\t7\t4\t8\t20\t91\tno\n")
    run()
    run()
    assert sorted(r.text for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["new", "w1", "w2", "w3"]
