import datetime
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioframe.functions.dates import typed_date
from folioframe.functions.text import clean_cell, display_text, is_large_amount, letters_only, plain_letters
from folioframe.operators import anchors as A
from folioframe.operators import review as R
from folioframe.operators import words as W
from folioframe.operators.sections import backup_merged, fuzzy_sections
from folioframe.plans import cell_queries, equity, word_queries
from folioframe.sources import csv, vision
from folioframe.sources.scans import scan_date
from folioframe.sources.tsv import parse_tsv
from folioframe.sources.views import words

WORD = "page long, line_num int, word_num int, block_num int, psm string, text string, left_ int, right_ int, top int, bottom int, conf int"


def test_rows_follow_a_running_mean(spark):
    rng = np.random.default_rng(3)
    rows = [(p, 1, i, 1, "6", "x", int(rng.integers(0, 500)), 510, y := int(rng.integers(0, 400)), y + 24, 50) for p in range(3) for i in range(80)]
    got = {(r.page, r.word_num): r.row for r in W.cluster_rows(spark.createDataFrame(rows, WORD)).collect()}
    for page in range(3):
        mine = sorted(((r[8] + r[9]) // 2, r[6], r[2]) for r in rows if r[0] == page)
        groups: list[list[int]] = []
        for y, _, word in mine:
            if groups and abs(y - round(sum(groups[-1]) / len(groups[-1]))) <= 20:
                groups[-1].append(y)
            else:
                groups.append([y])
            assert got[page, word] == len(groups)


def test_glued_numbers_go_to_several_columns(spark):
    rows = [(1, 1, 1, 1, "6", "31.250.000/3000.—", 0, 360, 0, 20, 90), (1, 1, 2, 1, "6", "Fiat", 1400, 1500, 0, 20, 90)]
    found = W.overlap_cells(spark.createDataFrame(rows, WORD), [("capital", 0, 180), ("shares", 180, 370), ("issuer", 1325, 1945)]).orderBy("word_num", "at").collect()
    assert [(r.column, r.part) for r in found] == [("capital", "31.250.000"), ("shares", "3000.—"), ("issuer", "Fiat")]


def test_snap_keeps_edges_and_order(spark):
    one = spark.range(1).select(W.snapped(F.expr("array(0, 100, 110, 200)"), F.expr("array(95, 130)")).alias("x"), W.merged_close(F.expr("array(10, 25, 90)")).alias("y")).first()
    assert one.x == [0, 95, 103, 200] and one.y == [18, 90]


def test_tsv_edges(spark):
    lines = ["level\tpage_num", "5\t1\t1\t1\t1\t1\t5\t3\t3\t1\t96.5\ta\tb", "4\t1\t1\t1\t1\t1\t5\t3\t3\t1\t96\tx", "5\t1\t1\t1\t1\t1\t5\t3\t3\t1\t-1\tx", "5\t1\t1\t1\t1\t1\tq\t3\t3\t1\t9\tx", "5\t1\t1\t1\t1\t1\t5\t3\t3\t1\t9\t  ", "5\t1"]
    got = parse_tsv(spark.createDataFrame([(x,) for x in lines], "value string"), 2.0).collect()
    assert [(r.left_, r.top, r.right_, r.bottom, r.conf, r.text) for r in got] == [(2, 2, 4, 2, 96.5, "a\tb")]


def test_equity_rescues(spark):
    rows = [
        (1, 1, "", "1.400.000 2.800.000", "500", "Sviluppo Imprese", "98,50", "—", "1.400.000 2.800.000 500 Sviluppo Imprese 98,50", "security_main_row", "80"),
        (1, 2, "", "", "", "» privileg", "", "", "»", "security_continuation_row", "50"),
        (1, 3, "", "", "", "", "", "", "Finanziari", "other", "90"),
    ]
    schema = "sample_id long, row_index long, capital_subscribed_raw string, shares_outstanding_raw string, nominal_value_raw string, issuer_name_raw string, price_close_raw string, quantity_traded_raw string, raw_row_text string, row_role string, mean_conf string"
    cleaned = equity.clean(spark.createDataFrame(rows, schema).withColumn("section", F.lit("A")), ["sample_id", "row_index"])
    a, b, c = equity.context(cleaned).orderBy("row_index").collect()
    assert (a.capital_subscribed, a.shares_outstanding, a.nominal_value, a.price_close) == ("1400000", "2800000", "500", "98.50")
    assert "left_numeric_shift_rescued" in a.validation_flags and "quantity_likely_printed_blank" in a.validation_flags
    assert b.capital_subscribed == "1400000" and "identity_inherited_from_previous_row" in b.validation_flags
    assert c.row_role == "section_heading"


def test_damaged_sections(spark):
    got = fuzzy_sections(spark.createDataFrame([("Trasportl",), ("Chimici",), ("zzz",), (None,)], "text string")).collect()
    assert [r.section for r in got] == ["Trasporti", "Chimici", "", ""]


def test_backup_cells(spark):
    m = backup_merged(F.col("c"), [("a", F.col("x")), ("b", F.col("y"))], True)
    got = spark.createDataFrame([("", "12", "34"), ("5", "1.234.567", ""), ("77", "8", "")], "c string, x string, y string").select(m.alias("m")).collect()
    assert [(r.m.value, r.m.source) for r in got] == [("12", "a"), ("1.234.567", "a"), ("77", "main")]


def test_partitioning_never_shows(spark):
    rows = [(1, 1, i, 1, "6", f"w{i}", 10 * (i % 3), 10 * (i % 3) + 5, 0, 10, i) for i in range(30)]
    one, many = (W.lines(spark.createDataFrame(rows, WORD).repartition(n), ["page", "line_num"]).collect() for n in (1, 7))
    assert one == many


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 'q"x', None), ("line\nbreak", "", "z")], "a string, b string, c string")
    csv.write_csv(df, f"{tmp_path}/x", ["a", "b", "c"])
    back = csv.read_csv(spark, f"{tmp_path}/x", ["a", "b", "c"]).orderBy("a").collect()
    assert [tuple(r) for r in back] == [("a,b", 'q"x', None), ("line\nbreak", None, "z")]
    assert csv.read_csv(spark, f"{tmp_path}/none", ["a"], missing_ok=True).count() == 0
    with pytest.raises(ValueError):
        csv.write_csv(df, f"{tmp_path}/y", ["a"], strict=True)


def test_images():
    page = np.full((200, 300), 230, np.uint8)
    page[:, 148:152] = 20
    assert abs(vision.gutter(page) - 150) <= 6
    page[40:44, 10:290] = 0
    assert (vision.without_rules(page)[41, 20:140] == 255).all()
    assert vision.runs(np.array([0, 1, 1, 0, 0, 1], bool)) == [(1, 2), (5, 5)]
    assert vision.halves(page)["left"][0] == 0


def test_last_correction_wins(spark):
    rows = spark.createDataFrame([(1, 1, "m", "5", ["missing_capital"])], "sample_id long, row_index long, row_role string, capital_subscribed string, validation_flags array<string>").withColumns({"shares_outstanding": F.lit(""), "nominal_value": F.lit(""), "issuer_name_clean": F.lit("")})
    fixes = spark.createDataFrame([(1, 1, 0, "exclude", "", ""), (1, 1, 1, " Keep", "7", "")], "sample_id long, row_index long, seq int, review_action string, corrected_capital_subscribed string, merge_target_row_index string").withColumns({c: F.lit("") for c in ("corrected_shares_outstanding", "corrected_nominal_value", "corrected_issuer_name")})
    got = R.corrected(rows, fixes, ["seq"]).first()
    assert (got.capital_subscribed, got.row_role, got.log.status) == ("7", "m", "applied") and got.validation_flags == ["manual_corrected", "manual_corrected_capital_subscribed"]


def test_clean_cell(spark):
    assert spark.range(1).select(clean_cell(F.lit(" {a}\n[b] | c "))).first()[0] == "a b c"


def test_page_queries_read_every_line(spark, tmp_path):
    rng = np.random.default_rng(11)
    lines = lambda n: "\n".join(" ".join("x" * int(rng.integers(1, 9)) for _ in range(int(rng.integers(1, 7)))) for _ in range(n))
    spark.createDataFrame([(1, lines(57)), (2, lines(12)), (3, lines(2))], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = words(spark, str(tmp_path)).collect()
    nearest, asof, bands, merged = {}, {}, {}, {}
    for page in (1, 2, 3):
        mine = [w for w in found if w.page == page]
        tops = sorted({w.top for w in mine if w.word_num == 1})
        odd = sorted({w.top for w in mine if w.word_num == 1 and w.line_num % 2})
        for w in mine:
            at = min(range(len(odd)), key=lambda i: (abs(odd[i] - w.top), i))
            at = at if abs(odd[at] - w.top) <= 28 else -1  # 1.15 times the height of 24, rounded
            nearest[page, at] = nearest.get((page, at), 0) + 1
            at = max([i for i, t in enumerate(tops) if t <= w.top - 6], default=0)
            asof[page, at] = asof.get((page, at), 0) + 1
        for row in {w.line_num for w in mine}:
            top, bottom = min(w.top for w in mine if w.line_num == row), max(w.bottom for w in mine if w.line_num == row)
            pad = max(3, int((bottom - top) * 0.25))
            bands[page, row] = sum(w.bottom >= top - pad and w.top <= bottom + pad for w in mine)
        kept = []
        for x in sorted(w.left_ for w in mine):
            if kept and x - kept[-1] <= 20:
                kept[-1] = round((kept[-1] + x) / 2)
            else:
                kept.append(x)
        merged[page] = ",".join(map(str, kept))
    run = lambda name: word_queries.QUERIES[name](spark, str(tmp_path)).collect()
    assert {(r.page, r.anchor): r.n_words for r in run("nearest_anchor")} == nearest
    assert {(r.page, r.anchor): r.n_words for r in run("asof_anchor")} == asof
    assert {(r.page, r.row): r.n_words for r in run("strip_band_join")} == bands
    assert {r.page: r.rules for r in run("merged_rules")} == merged


def test_cell_queries_keep_every_row(spark, tmp_path):
    rng = np.random.default_rng(4)
    names = ["Fiat", "Ansaldo Genova", "Ilva", "Privilegiate", "Terni Acciai", "Edison"]
    spark.createDataFrame(list(enumerate(names)), "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    items = [(o, n, int(rng.integers(0, 6)), int(rng.integers(0, 50)), float(rng.integers(1, 40)), 1234.5 + n, "AN"[n % 2], datetime.date(1995, 3, 4)) for o in range(70) for n in range(1, 8)]
    spark.createDataFrame(items, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate date").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = sorted(cell_queries.plain_rows(spark, str(tmp_path)).collect(), key=lambda r: (r.sample_id, r.row_index))
    run = lambda name: {(r.sample_id, r.row_index): r for r in cell_queries.QUERIES[name](spark, str(tmp_path)).collect()}
    got, last, short = run("continuation_inherit"), {}, 0
    assert len(got) == len(rows) == len(items)
    fields = ("capital_subscribed", "shares_outstanding", "nominal_value")
    for r in rows:
        name, values, before = r.issuer_name_clean, [r[f] for f in fields], last.get((r.sample_id, r.section))
        if r.row_role == "security_continuation_row" and before:
            short += name in ("Fiat", "Ilva")
            if len(name) <= 4 or re.match(r"b\)|»|\)|\(|privileg|ordinar", name.lower()):
                name = f"{before[0]} {name}" if name and name not in before[0] else before[0]
            values = [v or b for v, b in zip(values, before[1:], strict=True)]
        elif r.row_role == "security_main_row" and name:
            last[r.sample_id, r.section] = (name, *values)
        mine = got[r.sample_id, r.row_index]
        assert (mine.issuer_name_clean, *[mine[f] for f in fields]) == (name, *values)
    assert short
    got = run("identity_integers")
    assert {len(r.nominal_value) for r in rows} == {0, 2, 3} and len(got) == len(rows)
    for r in rows:
        k, n = r.sample_id % 60 + 1, r.nominal_value  # only three digits may belong to the number before them
        assert got[r.sample_id, r.row_index].value == (str(k) if len(n) < 3 else n if k <= 30 else f"{k}{n}")


def test_bucketed_bands_equal_a_plain_join(spark):
    rng = np.random.default_rng(5)
    ws = [(int(rng.integers(1, 3)), k, int(t), int(t + rng.integers(1, 200))) for k, t in enumerate(rng.integers(0, 900, 150))]
    rs = [(int(rng.integers(1, 3)), k, int(t), int(t + rng.integers(1, 150))) for k, t in enumerate(rng.integers(0, 900, 40))]
    w = spark.createDataFrame(ws, "page long, n int, top int, bottom int")
    r = spark.createDataFrame(rs, "page long, row int, band_top int, band_bottom int")
    got = sorted((x.n, x.row) for x in W.band_words(w, r, F.lit(7)).select("w.n", "r.row").collect())
    assert got == sorted((b, d) for a, b, t, u in ws for c, d, x, y in rs if a == c and u >= x - 7 and t <= y + 7)


def test_counters_cost_no_pass_of_their_own(spark):
    rows = spark.createDataFrame([("security_main_row", ["a"]), ("security_continuation_row", []), ("section_heading", ["manual_corrected"])], "row_role string, validation_flags array<string>")
    out, seen = R.counted(rows)
    assert out.count() == 3
    assert seen.get == {"records": 3, "candidates": 2, "flagged": 2, "corrected": 1}


def test_diagnostics_in_the_order_of_need(spark):
    rows = [("issuer_name_clean", 1, 0, 0), ("price_close", 5, 0, 0), ("capital_subscribed", 5, 0, 2), ("nominal_value", 1, 0, 0)]
    df = spark.createDataFrame(rows, "field string, field_review_rows int, raw_present_clean_empty int, empty_clean int")
    assert [r.field for r in R.by_need(df).collect()] == ["capital_subscribed", "price_close", "issuer_name_clean", "nominal_value"]


def test_words_of_a_crop_and_of_samples(spark):
    w = spark.createDataFrame([("a\\b.jpg", "s1", 10), ("a/b.jpg", "s1", 200), ("c.jpg", "s2", 300)], "crop_file string, sample_id string, top int")
    assert W.of_crop(w, "a\\b.jpg").count() == W.of_crop(w, "a/b.jpg").count() == 2
    assert [r.top for r in W.without_header(w).orderBy("top").collect()] == [200, 300]
    samples = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "sample_id string")
    got = W.samples_with(samples, W.keyed(w, {"psm": F.lit("6")}), w.where("top > 100")).orderBy("sample_id").collect()
    assert [tuple(r) for r in got] == [("s1", 2, 1), ("s2", 1, 1), ("s3", 0, 0)]


def test_nearest_of_equals_a_search_of_all():
    rng = np.random.default_rng(7)
    for n in (1, 2, 30):
        centers, ys = rng.integers(0, 60, n), rng.integers(-5, 70, 200)
        near, away = A.nearest_of(ys, centers)
        all_ = np.abs(ys[:, None] - centers[None, :])
        assert (near == all_.argmin(1)).all() and (away == all_.min(1)).all()


def test_text_functions_without_a_query(spark):
    t = lambda c: spark.range(1).select(c).first()[0]
    assert t(display_text(F.lit("|a__b [c]|"))) == "a b c" and t(is_large_amount(F.lit("12.500"))) and not t(is_large_amount(F.lit("125")))
    assert t(typed_date(F.lit("1950-02-28"))) == datetime.date(1950, 2, 28) and t(typed_date(F.lit("1950-02-30"))) is None
    assert t(scan_date(F.lit("1950-M3-7_12.JPG"))) == "1950-03-07" and t(scan_date(F.lit("x"))) == ""
    texts = [None, "", "Élan ÀÈ-ß", "ﬁne Ｗｉｄｅ", "İstanbul", "Ångström 12 x", "日本 abc", "K Å", "ǅ"]
    got = spark.createDataFrame([(x,) for x in texts], "x string").select(letters_only(F.col("x")).alias("y")).collect()
    assert [r.y for r in got] == [plain_letters(x or "") for x in texts]


def test_tables_by_type_and_combined(spark, tmp_path):
    a, b = spark.createDataFrame([("x", 1)], "page_type string, n int"), spark.createDataFrame([("y", "q")], "page_type string, t string")
    both = csv.combined([a, b], ["t", "missing"])
    assert both.columns == ["t", "page_type", "n"] and both.count() == 2
    csv.write_by_type(both, f"{tmp_path}/typed")
    assert sorted(p.name for p in (tmp_path / "typed").glob("page_type=*")) == ["page_type=x", "page_type=y"]


def test_measures_rules_and_zones_of_images(spark):
    page = np.full((300, 200), 30, np.uint8)
    page[20:280, 20:180] = 235
    page[60:240, [40, 41, 100, 101, 160]] = 10
    ruled = np.full((300, 200), 235, np.uint8)
    ruled[60:240, [40, 41, 100, 101, 160]] = 10
    assert vision.vertical_rules(vision.ink(ruled)) == [40, 100, 160]
    x0, y0, x1, y1 = vision.table_zone(page)
    assert x0 <= 40 and x1 >= 160 and y0 <= 62 and y1 >= 238
    image = ("file:p", 300, 200, 1, 0, bytearray(page.tobytes()))
    df = spark.createDataFrame([(image,), (("file:bad", 3, 3, 1, 0, bytearray(b"x")),)], "image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>")
    got = {r.origin: r for r in vision.page_measures(df).collect()}
    assert got["file:p"].error is None and 0.6 < got["file:p"].content_ratio < 1 and got["file:bad"].error


def test_the_engine_runs_only_where_it_is(monkeypatch):
    calls = []

    class Done:
        stdout = "level"

    run = lambda args, **_: calls.append(args) or Done
    monkeypatch.setattr(vision.shutil, "which", lambda _: None)
    assert vision.tesseract("a.png", "6", run=run) == "" and not calls
    monkeypatch.setattr(vision.shutil, "which", lambda _: "/x")
    assert vision.tesseract("a.png", "6", run=run) == "level" and calls[0][1] == "a.png" and "6" in calls[0]
