"""Runs that go on, cached readings, resolved crops, image files with commit, and slices that read nothing else."""

import pytest
from pyspark.sql import functions as F

from folioframe.sources import csv, image_sink, imaging, resume, scans

import numpy as np


def ids(spark, *x):
    return spark.createDataFrame([(i, k) for k, i in enumerate(x)], "sample_id string, n int")


KINDS = {"structured": "sample_id string, n int", "cleaned": "sample_id string, m int"}


def test_a_second_run_makes_what_is_missing(spark, tmp_path):
    runs, seen = resume.Runs(spark, f"{tmp_path}/out", KINDS), []

    def make(todo):
        seen.append(sorted(r.sample_id for r in todo.collect()))
        return {"structured": todo.select("sample_id", "n"), "cleaned": todo.select("sample_id", (F.col("n") * 2).alias("m"))}

    assert runs.read("cleaned").count() == 0
    first = runs.run(ids(spark, "a", "b"), make)
    assert first and runs.run(ids(spark, "a", "b"), make) is None and runs.run(ids(spark, "c"), make, "only") is None
    runs.run(ids(spark, "a", "b", "c"), make)
    assert seen == [["a", "b"], ["c"]]
    assert sorted((r.sample_id, r.m) for r in runs.read("cleaned").collect()) == [("a", 0), ("b", 2), ("c", 4)]
    runs.run(ids(spark, "b"), make, "again")
    assert seen[-1] == ["b"] and sorted((r.sample_id, r.n) for r in runs.read("structured").collect()) == [("a", 0), ("b", 0), ("c", 2)]
    with pytest.raises(ValueError):
        runs.run(ids(spark, "b"), make, "other")


def test_half_written_samples_are_made_again(spark, tmp_path):
    runs = resume.Runs(spark, f"{tmp_path}/out", KINDS)

    def broken(todo):
        return {"structured": todo.select("sample_id", "n"), "cleaned": todo.select("sample_id", F.raise_error(F.lit("stopped")).cast("int").alias("m"))}

    with pytest.raises(Exception, match="stopped"):
        runs.run(ids(spark, "a"), broken)
    assert (tmp_path / "out" / "structured").exists() and runs.read("structured").count() == 0
    runs.run(ids(spark, "a"), lambda todo: {"structured": todo.select("sample_id", "n"), "cleaned": todo.select("sample_id", F.col("n").alias("m"))})
    assert runs.read("structured").count() == 1 and runs.read("cleaned").count() == 1


def test_cached_readings_are_made_once(spark, tmp_path):
    seen = []

    def make(todo):
        seen.append(sorted(r.row_index for r in todo.collect()))
        return todo.where("row_index <> 9").withColumn("text", F.concat(F.lit("text "), F.col("row_index").cast("string")))

    read = lambda *k: sorted(r.text for r in resume.cached(spark.createDataFrame([(i,) for i in k], "row_index int"), f"{tmp_path}/c", make, "row_index int, text string", ["row_index"]).collect())
    assert read() == [] and read(1, 2) == ["text 1", "text 2"] and read(1, 2) == ["text 1", "text 2"]
    assert read(1, 3, 9) == ["text 1", "text 2", "text 3"] and read(9) == ["text 1", "text 2", "text 3"]
    assert seen == [[1, 2], [3, 9], [9]]


def test_crops_are_found_in_the_first_listing(spark):
    pages = spark.createDataFrame([("p1", "a.jpg", "p1.jpg"), ("p2", "b.jpg", "p2.jpg"), ("p3", None, "p3.jpg")], "sample_id string, manifest_name string, kept_name string")
    files = lambda *x: spark.createDataFrame([(n, f"{d}/{n}") for d, n in x], "name string, path string")
    got = resume.resolved(pages, [("manifest", files(("m", "a.jpg"), ("n", "a.jpg"))), ("kept", files(("k", "p1.jpg"), ("k", "p2.jpg")))])
    assert sorted((r.sample_id, r.crop_path, r.crop_source) for r in got.collect()) == [("p1", "m/a.jpg", "manifest"), ("p2", "k/p2.jpg", "kept"), ("p3", None, "made_from_scan")]


def test_images_are_written_once_and_listed(spark, tmp_path):
    out = tmp_path / "img"
    page = np.arange(200 * 50, dtype=np.int64).reshape(200, 50).astype(np.uint8)
    images = spark.createDataFrame([("s1", page.tobytes(), 50), ("s2", page.tobytes(), 50), ("s9", page.tobytes(), 50)], "sample_id string, pixels binary, width int")
    rows = spark.createDataFrame([(k, f"s{k % 3}", 10 * k, 20 + 60 * k, 80 + 60 * k) for k in range(6)], "n int, sample_id string, row_index int, top int, bottom int")
    rows = rows.withColumn("name", image_sink.snippet_name(F.col("n"), F.col("sample_id"), F.col("row_index")))
    found = image_sink.snippets(rows, images)
    image_sink.write_images(found, str(out))
    names = {str(p.relative_to(out)) for p in out.rglob("*.png")}
    assert names == {"snippets/001_s1_row_10.png", "snippets/002_s2_row_20.png", "snippets/004_s1_row_40.png", "snippets/005_s2_row_50.png"}
    assert sorted(p.name for p in out.iterdir()) == ["_images.json", "snippets"]
    assert (out / "snippets/001_s1_row_10.png").read_bytes() == imaging.png(image_sink.framed(page, 80, 140))
    with pytest.raises(Exception, match="share the name"):
        image_sink.write_images(found.union(found), str(out))
    with pytest.raises(Exception, match="not a name"):
        image_sink.write_images(spark.createDataFrame([("../x", b"")], "name string, content binary"), str(out))
    assert sorted(p.name for p in out.iterdir()) == ["_images.json", "snippets"] and {str(p.relative_to(out)) for p in out.rglob("*.png")} == names
    image_sink.write_images(spark.createDataFrame([("b.png", b"y")], "name string, content binary"), str(out), "overwrite")
    assert {str(p.relative_to(out)) for p in out.rglob("*.png")} == {"b.png"}


def test_slices_open_no_other_file(spark, tmp_path):
    for k in range(5):
        (tmp_path / f"s{k}.jpg").write_bytes(bytes([k]))
    names = scans.named(spark, str(tmp_path))
    assert "content" not in scans.sliced(names, 1, 3)._jdf.queryExecution().executedPlan().toString()
    kept = scans.sliced(names, 1, 3)
    (tmp_path / "s4.jpg").chmod(0)
    assert sorted(bytes(r.content)[0] for r in scans.with_content(kept).collect()) == [1, 2]
    assert [r.path[-6:] for r in scans.manifest_rows(names.withColumn("kind", F.lit("x")), "kind", "x", ["path"], 2).collect()] == ["s0.jpg", "s1.jpg"]


def test_csv_with_a_mark_comes_back(spark, tmp_path):
    csv.write_csv(spark.createDataFrame([("1", "é")], "a string, b string"), f"{tmp_path}/m", ["a", "b"], mark=True)
    part = next((tmp_path / "m").glob("part-*")).read_bytes()
    assert part.startswith(b"\xef\xbb\xbfa,b")
    assert [tuple(r) for r in csv.read_csv(spark, f"{tmp_path}/m", ["a", "b"]).collect()] == [("1", "é")]
