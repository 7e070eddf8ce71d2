"""Word tables as an OCR engine writes them: tab separated, a line for each element of the page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_tsv(rows: DataFrame, scale: float = 1.0) -> DataFrame:
    """Words of rows (column value, a line each): lines of twelve parts at level 5 with text, a confidence from zero
    on and whole coordinates; other lines go. Coordinates are divided by scale, halves to even."""
    whole = lambda k: F.bround(F.get("_p", F.lit(k)).try_cast("int") / scale).cast("int")
    part = lambda k: F.get("_p", F.lit(k))
    # a generator after the parts and one after their values keep filters from being copied into them with all that they are made of
    split = rows.select(F.inline(F.array(F.struct(F.split("value", "\t", 12).alias("_p")))))
    found = split.where((F.size("_p") == 12) & (part(0) == "5"))
    out = found.select(F.inline(F.array(F.struct(*[part(k).try_cast("int").alias(n) for k, n in ((1, "page_num"), (2, "block_num"), (3, "par_num"), (4, "line_num"), (5, "word_num"))], part(10).try_cast("double").alias("conf"), whole(6).alias("left_"), whole(7).alias("top"), whole(8).alias("width"), whole(9).alias("height"), F.regexp_replace(part(11), r"(?U)^\s+|\s+$", "").alias("text")))))
    out = out.where((F.col("text") != "") & (F.col("conf") >= 0) & F.col("left_").isNotNull() & F.col("top").isNotNull() & F.col("width").isNotNull() & F.col("height").isNotNull())
    return out.withColumns({"right_": F.col("left_") + F.col("width"), "bottom": F.col("top") + F.col("height")})
