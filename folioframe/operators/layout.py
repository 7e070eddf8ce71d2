"""Zones of equity pages, the crops that are read of them, and the way back from a crop's coordinates to the page's.

Edge cases: a page without a zone gets the fallback's; a null or zero width or height gives zones of no size; a word of an
unknown variant keeps its coordinates; further columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Shares of a page's width and height.
#: A table that begins further right than this share, or is narrower than the next, has lost columns on its left.
FAR_LEFT, NARROW, LEFT_EDGE = 0.10, 0.78, 0.035
#: A table that ends above the first share is drawn down to the second.
SHORT, BOTTOM_EDGE = 0.72, 0.855
#: Zone of a page in which none was found: x0, y0, x1, y1.
FALLBACK = (0.035, 0.085, 0.965, 0.855)
FALLBACK_PAGE = (0.025, 0.965)
#: Crops that are read of a page: name, x0, y0, x1, y1, and whether rules are taken out first.
VARIANTS = [
    ("original_full", 0.0, 0.0, 1.0, 1.0, False),
    ("line_removed_full", 0.0, 0.0, 1.0, 1.0, True),
    ("body_line_removed", 0.0, 0.075, 1.0, 0.90, True),
    ("numeric_columns_body", 0.0, 0.075, 0.52, 0.90, True),
    ("issuer_column_body", 0.48, 0.075, 0.80, 0.90, True),
    ("price_quantity_columns_body", 0.78, 0.075, 1.0, 0.90, True),
]
# End of fixed values.

ZONES = "array<struct<zone_type:string,x0:int,y0:int,x1:int,y1:int,confidence:double>>"


def _part(of: Column, share: float) -> Column:
    return F.floor(of * share).cast("int")


def zones(table: Column, width: Column, height: Column) -> Column:
    """The zones of a page (array of structs): table, and header and footer where there is room, from the table that was
    found (struct x0, y0, x1, y1; null for none), repaired where it has plainly lost columns or its end."""
    zone = lambda kind, x0, y0, x1, y1, c: F.struct(F.lit(kind).alias("zone_type"), x0.cast("int").alias("x0"), y0.cast("int").alias("y0"), x1.cast("int").alias("x1"), y1.cast("int").alias("y1"), F.lit(c).alias("confidence"))
    lost = (table["x0"] > width * FAR_LEFT) | (table["x1"] - table["x0"] < width * NARROW)
    x0 = F.when(lost, F.least(table["x0"], _part(width, LEFT_EDGE))).otherwise(table["x0"])
    y1 = F.when(table["y1"] < height * SHORT, _part(height, BOTTOM_EDGE)).otherwise(table["y1"])
    found = F.array_compact(F.array(
        zone("azioni_table", x0, table["y0"], table["x1"], y1, 0.82),
        F.when(table["y0"] > height * 0.04, zone("azioni_header", x0, F.lit(0), table["x1"], table["y0"], 0.55)),
        F.when(y1 < height * 0.94, zone("azioni_footer", x0, F.greatest(F.lit(0), y1), table["x1"], height, 0.55)),
    ))
    a, b, c, d = (_part(of, s) for of, s in zip((width, height, width, height), FALLBACK, strict=True))
    top, bottom = (_part(height, s) for s in FALLBACK_PAGE)
    other = F.array_compact(F.array(zone("azioni_table", a, b, c, d, 0.55), F.when(b > top, zone("azioni_header", a, top, c, b, 0.45)), F.when(d < bottom, zone("azioni_footer", a, F.greatest(top, d), c, bottom, 0.45))))
    return F.when(table.isNotNull(), found.cast(ZONES)).otherwise(other.cast(ZONES))


def variants(pages: DataFrame) -> DataFrame:
    """A row for each page (width, height) and crop that is read of it: variant, x0, y0, x1, y1 on the page, without_rules."""
    w, h = F.col("width"), F.col("height")
    each = F.array(*[F.struct(F.lit(n).alias("variant"), _part(w, a).alias("x0"), _part(h, b).alias("y0"), _part(w, c).alias("x1"), _part(h, d).alias("y1"), F.lit(r).alias("without_rules")) for n, a, b, c, d, r in VARIANTS])
    return pages.select(*pages.columns, F.inline(each))


def to_crop(words: DataFrame, scale: float = 1.0) -> DataFrame:
    """Words in a page's coordinates (with x0, y0 of a crop) in those of the crop, made so many times as large."""
    put = lambda c, o: F.bround((F.col(c) - F.col(o)) * scale).cast("int")
    return words.withColumns({"left_": put("left_", "x0"), "right_": put("right_", "x0"), "top": put("top", "y0"), "bottom": put("bottom", "y0")})


def to_page(words: DataFrame, scale: float = 1.0) -> DataFrame:
    """Words as a crop's reading gives them (with x0, y0 of the crop) in the coordinates of their page."""
    put = lambda c, o: (F.bround(F.col(c) / scale) + F.coalesce(F.col(o), F.lit(0))).cast("int")
    return words.withColumns({"left_": put("left_", "x0"), "right_": put("right_", "x0"), "top": put("top", "y0"), "bottom": put("bottom", "y0")})


def crop(gray, x0: int, y0: int, x1: int, y1: int, without_rules: bool):
    """The pixels of a variant, from a page's."""
    from folioframe.sources.vision import without_rules as removed

    return (removed(gray) if without_rules else gray)[y0:y1, x0:x1]
