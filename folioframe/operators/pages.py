"""Operators on pages: labels, routing, samples, headings and body regions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.dimensions import BODY, HEADING_PATTERNS, LINE_HEADER_TERMS, LINE_SECTION_TERMS, PAGE_OVERRIDES, PAGE_TYPES, frame
from folioframe.functions.text import heading_text, squeeze, text_of


def default_type(picture: Column, side: Column) -> Column:
    """struct(page_type, confidence) of a page without an override."""
    of = lambda t, c: F.struct(F.lit(t).alias("page_type"), F.lit(c).alias("confidence"))
    left = side == "left"
    return F.when(picture.isin(1, 5) & left, of("dividendi_in_pagamento", "high")).when(picture.isin(1, 5), of("cover_valori_stato", "high")).when(picture == 2, of("regular_obbligazioni", "high")).when(picture == 3, of("regular_azioni", "high")).when((picture == 4) & left, of("comunicati_notizie", "high")).when(picture == 4, of("special_market_lists", "medium")).otherwise(of("unknown_review", "low"))


def labelled(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """pages with page_type, confidence and needs_review; the overrides are fifteen rows."""
    known = F.broadcast(frame(spark, PAGE_OVERRIDES, "date string, picture int, side string, _type string, _conf string"))
    rule = default_type(F.col("picture"), F.col("side"))
    out = pages.join(known, ["date", "picture", "side"], "left")
    out = out.withColumns({"page_type": F.coalesce("_type", rule["page_type"]), "confidence": F.coalesce("_conf", rule["confidence"])}).drop("_type", "_conf")
    return out.withColumn("needs_review", F.when(F.col("confidence") == "high", "no").otherwise("yes"))


def routed(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """pages with the state of their parser and the way they go: table, text, skip or generic."""
    dim = F.broadcast(frame(spark, [(t, s) for t, s, _ in PAGE_TYPES], "page_type string, _status string"))
    unknown = next(s for t, s, _ in PAGE_TYPES if t == "unknown_review")
    t = F.col("page_type")
    route = F.when(t.isin("regular_azioni", "regular_obbligazioni", "cover_valori_stato", "dividendi_in_pagamento", "special_market_lists"), "table").when(t.isin("comunicati_notizie", "advertisement_notice"), "text").when(t == "blank_or_divider", "skip").otherwise("generic")
    return pages.join(dim, "page_type", "left").withColumns({"strategy_status": F.coalesce("_status", F.lit(unknown)), "route": route}).drop("_status")


def sampled(pages: DataFrame, per_type: int, order: str, limit: int | None = None) -> DataFrame:
    """The first pages of each type in an order, and of those the first in all."""
    w = Window.partitionBy("page_type").orderBy(order)
    out = pages.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= per_type).drop("_n") if per_type > 0 else pages
    return out.orderBy(order).limit(limit) if limit is not None else out


def heading_hits(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, page_type and heading_pattern for every pattern of its type that a page's text matches."""
    dim = F.broadcast(frame(spark, HEADING_PATTERNS, "page_type string, heading_pattern string"))
    return pages.withColumn("_t", heading_text(F.col("text"))).join(dim, "page_type").where(F.expr("_t RLIKE heading_pattern")).select("page_id", "page_type", "heading_pattern")


def body_words(words: DataFrame) -> DataFrame:
    """Words (page, page_type, page_height, top, bottom) in the body of their page's type; all of a page without any."""
    kind = F.col("page_type")
    share = lambda k: reduce(lambda acc, x: F.when(kind == x[0], F.lit(x[1][k])).otherwise(acc), [x for x in BODY.items() if x[0]], F.lit(BODY[""][k]))
    y = F.floor((F.col("top") + F.col("bottom")) / 2)
    ok = words.withColumn("_ok", (y >= F.floor(F.col("page_height") * share(0))) & (y <= F.floor(F.col("page_height") * share(1))))
    some = F.count_if(F.col("_ok")).over(Window.partitionBy("page"))
    return ok.withColumn("_n", some).where(F.col("_ok") | (F.col("_n") == 0)).drop("_ok", "_n")


def quality_flag(content: Column, dark: Column, lines: Column) -> Column:
    """Flag of a page image from its share of content, of dark pixels inside, and of lines; '' if nothing is odd."""
    return F.when(content < 0.30, "low_content_or_blank").when((dark < 0.005) & (lines < 0.002), "possible_blank_page").when(dark < 0.08, "low_text_density_review").when(dark > 0.38, "possible_occlusion_or_shadow").otherwise("")


def scaled_box(v: Column, scale: float, limit: int) -> Column:
    """A coordinate scaled, halves to even, and kept inside the image."""
    return F.greatest(F.lit(0), F.least(F.lit(limit), F.bround(v * scale).cast("int")))


def sample_id(date: Column, picture: Column, side: Column) -> Column:
    """The name of a page side."""
    return F.concat_ws("_", date, picture, side)


def padded_box(pad: int, width: Column, height: Column) -> Column:
    """struct(x0, y0, x1, y1) of a box wider by a pad on all sides, inside its page."""
    low = lambda c: F.greatest(F.lit(0), F.col(c) - pad).alias(c)
    return F.struct(low("x0"), low("y0"), F.least(width, F.col("x1") + pad).alias("x1"), F.least(height, F.col("y1") + pad).alias("y1"))


def page_width(words: DataFrame, key: str = "page") -> DataFrame:
    """The width of a page whose image isn't there: one more than its words reach."""
    return words.groupBy(key).agg((F.max("right_") + 1).alias("width"))


def line_type(text: Column, top: Column) -> Column:
    """What a line is, by its place and words: header_or_column_label, section_heading, candidate_data_line or text_line."""
    t = F.lower(squeeze(text_of(text)))
    holds = lambda terms: F.exists(F.array(*map(F.lit, terms)), lambda x: F.contains(t, x))
    return F.when((top < 190) | holds(LINE_HEADER_TERMS), "header_or_column_label").when(holds(LINE_SECTION_TERMS), "section_heading").when(t.rlike("[0-9]"), "candidate_data_line").otherwise("text_line")


def parse_summary(records: DataFrame, keys: list[str]) -> DataFrame:
    """Records of each page by kind, and those with flags."""
    kind = F.col("record_type")
    return records.groupBy(*keys).agg(F.count("*").alias("records"), F.count_if(kind == "candidate_record").alias("candidate_records"), F.count_if(kind.isin("text_block", "text_line")).alias("text_records"), F.count_if(F.size("validation_flags") > 0).alias("flagged_records"))
