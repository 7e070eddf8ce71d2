"""Zones, crops and reports on worked cases."""

import numpy as np
from pyspark.sql import functions as F

from folioframe.operators import layout as L
from folioframe.operators import reports

PAGE = "n int, width int, height int, table struct<x0:int,y0:int,x1:int,y1:int>"


def test_zones_are_repaired_or_made(spark):
    rows = [(1, 1000, 1000, (20, 100, 980, 850)), (2, 1000, 1000, (150, 100, 980, 600)), (3, 1000, 1000, None), (4, 1000, 1000, (20, 10, 980, 990)), (5, None, None, None)]
    got = {}
    for r in spark.createDataFrame(rows, PAGE).select("n", F.inline(L.zones(F.col("table"), F.col("width"), F.col("height")))).collect():
        got.setdefault(r.n, []).append((r.zone_type[7:], r.x0, r.y0, r.x1, r.y1))
    assert got[1] == [("table", 20, 100, 980, 850), ("header", 20, 0, 980, 100), ("footer", 20, 850, 980, 1000)]
    assert got[2] == [("table", 35, 100, 980, 855), ("header", 35, 0, 980, 100), ("footer", 35, 855, 980, 1000)]
    assert got[3] == [("table", 35, 85, 965, 855), ("header", 35, 25, 965, 85), ("footer", 35, 855, 965, 965)]
    assert got[4] == [("table", 20, 10, 980, 990)]


def test_words_come_back_from_every_crop(spark):
    pages = spark.createDataFrame([(1, 1237, 1733)], "n int, width int, height int")
    words = L.variants(pages).withColumns({c: F.lit(v) for c, v in (("left_", 700), ("right_", 733), ("top", 811), ("bottom", 835))})
    for scale in (1.0, 2.0, 3.0):
        back = L.to_page(L.to_crop(words, scale), scale).collect()
        assert len(back) == 6 and all((r.left_, r.right_, r.top, r.bottom) == (700, 733, 811, 835) for r in back)
    unknown = L.to_page(words.where("variant = 'original_full'").withColumns({"x0": F.lit(None).cast("int"), "y0": F.lit(None).cast("int")})).first()
    assert unknown.left_ == 700
    gray = np.full((40, 80), 230, np.uint8)
    gray[20, :] = 5
    assert L.crop(gray, 10, 5, 70, 35, False)[15].max() == 5 and L.crop(gray, 10, 5, 70, 35, True)[15].min() > 200 and L.crop(gray, 10, 5, 70, 35, True).shape == (30, 60)


def test_documents_of_pages_and_runs(spark):
    rows = spark.createDataFrame([("p 1", 2, "b|c", None), ("p 1", 1, "<a>\nx", "é"), ("q", 1, "", "&")], "page string, n int, text string, note string")
    md = {r.name: bytes(r.content).decode() for r in reports.page_documents(rows, "page", "n", ["n", "text", "note"]).collect()}
    assert md == {"reports/p_1.md": "# p 1\n\n| n | text | note |\n|---|---|---|\n| 1 | <a> x | é |\n| 2 | b\\|c |  |\n", "reports/q.md": "# q\n\n| n | text | note |\n|---|---|---|\n| 1 |  | & |\n"}
    html = {r.name: bytes(r.content).decode() for r in reports.page_documents(rows, "page", "n", ["text"], html=True).collect()}
    assert html["reports/p_1.html"] == "<h1>p 1</h1>\n<table>\n<tr><th>text</th></tr>\n<tr><td>&lt;a&gt;\nx</td></tr>\n<tr><td>b|c</td></tr>\n</table>\n"
    none = spark.createDataFrame([], "page_type string, flag string")
    assert reports.run_summary(none, none, "T").first().content == "# T\n\n## Pages by type\n\n- none\n\n## Flags\n\n- none\n"
    assert reports.page_documents(rows.limit(0), "page", "n", ["n"]).count() == 0
