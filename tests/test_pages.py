"""Small page operators on worked cases."""

from pyspark.sql import functions as F

from folioframe.operators import pages as P


def test_names_boxes_and_lines(spark):
    box = spark.createDataFrame([(5, 8, 90, 95, 100, 98)], "x0 int, y0 int, x1 int, y1 int, w int, h int")
    assert tuple(box.select(P.padded_box(10, F.col("w"), F.col("h")).alias("b")).first().b) == (0, 0, 100, 98)
    assert spark.range(1).select(P.sample_id(F.lit("1950-01-05"), F.lit("3"), F.lit("left"))).first()[0] == "1950-01-05_3_left"
    lines = [("anything", 100), ("Capitale  sociale", 500), ("ALIMENTARI e Tessili", 500), ("Fiat 12", 500), ("Fiat", 500), (None, 500)]
    got = spark.createDataFrame(lines, "t string, top int").select(P.line_type(F.col("t"), F.col("top")).alias("k")).collect()
    assert [r.k for r in got] == ["header_or_column_label", "header_or_column_label", "section_heading", "candidate_data_line", "text_line", "text_line"]


def test_parse_summary(spark):
    rows = [("a", "candidate_record", ["x"]), ("a", "text_block", []), ("a", "section_heading", None), ("b", "text_line", ["y", "z"])]
    got = P.parse_summary(spark.createDataFrame(rows, "page string, record_type string, validation_flags array<string>"), ["page"]).orderBy("page").collect()
    assert [tuple(r) for r in got] == [("a", 3, 1, 1, 1), ("b", 1, 0, 1, 1)]
