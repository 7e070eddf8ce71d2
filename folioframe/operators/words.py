"""Operators on words of pages: filters, lines, rows, columns and cells.

A word has page, line_num, word_num, block_num, psm, text, left_, right_, top, bottom and conf. Orders carry the word's
own place as the last key, so equal coordinates have a defined order and partitioning never shows in a result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.dimensions import HEADER_BOTTOM
from folioframe.functions.text import clean_cell, is_noise, is_symbols, letter_count, numeric_parts

PLACE = ["line_num", "word_num"]
CELLS = "array<struct<column:string,at:int,part:string>>"


def let(value: Column, body) -> Column:
    """body of a value that is computed once for a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def mid(a: str, b: str) -> Column:
    return F.floor((F.col(a) + F.col(b)) / 2).cast("int")


def with_centers(words: DataFrame) -> DataFrame:
    return words.withColumns({"mid_x": mid("left_", "right_"), "mid_y": mid("top", "bottom")})


def useful(kind: str) -> Column:
    """Whether a word is worth keeping: equity, generic or debug rules."""
    wide, high = F.col("right_") - F.col("left_"), F.col("bottom") - F.col("top")
    if kind == "equity":
        return ~is_noise(F.col("text")) & (F.col("conf") >= 12) & (wide > 1) & (high > 1)
    if kind == "generic":
        return ~is_noise(F.col("text")) & (F.col("conf") >= 8) & (wide > 0) & (high > 0)
    return ~is_symbols(F.col("text")) & ~F.col("text").rlike(r"(?U)^[\s_\-—–|{}\[\]().,;:!]+$") & (F.col("conf") >= 15)


def in_band(top: Column | int, bottom: Column | int) -> Column:
    return (F.col("bottom") >= top) & (F.col("top") <= bottom)


def is_tall(height: int = 66, width: int = 260) -> Column:
    """Artifacts of rules: higher than a row and not wide."""
    return (F.col("bottom") - F.col("top") > height) & (F.col("right_") - F.col("left_") < width)


def primary(words: DataFrame, keys: list[str]) -> DataFrame:
    """Useful words of a page's lexically least mode among 6, 11 and 12; all useful words of pages without any."""
    w = Window.partitionBy(*keys)
    kept = words.where(useful("generic")).withColumn("_psm", F.min(F.when(F.col("psm").isin("6", "11", "12"), F.col("psm"))).over(w))
    return kept.where(F.col("_psm").isNull() | (F.col("psm") == F.col("_psm"))).drop("_psm")


def joined(order: list[str], text: str = "text", sep: str = " ") -> Column:
    """Texts of a group in an order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, text))), lambda s: s[text]), sep)


def two_places(c: Column) -> Column:
    """A number with two decimals, halves to even as in the exact decimal value of the double."""
    return F.call_function("format_number", c, F.lit("0.00"))


def lines(words: DataFrame, keys: list[str], positive_only: bool = False) -> DataFrame:
    """Boxes, mean confidence and text of each line; with positive_only, words below zero don't count for the mean."""
    conf = F.when(F.col("conf") >= 0, F.col("conf")) if positive_only else F.col("conf")
    return words.groupBy(*keys).agg(F.min("left_").alias("left_"), F.min("top").alias("top"), F.max("right_").alias("right_"), F.max("bottom").alias("bottom"), F.count("*").alias("word_count"), F.coalesce(two_places(F.avg(conf)), F.lit("")).alias("mean_conf"), joined(["left_", "top", *PLACE]).alias("text"))


def page_text(words: DataFrame, key: str = "page") -> DataFrame:
    return words.groupBy(key).agg(joined(["top", "left_", *PLACE]).alias("text"))


def quality(words: DataFrame, key: str = "page") -> DataFrame:
    """Counts of words, noise, numbers and letters, and the mean confidence, of each page."""
    has = lambda c: F.count_if(c)
    return words.groupBy(key).agg(F.count("*").alias("word_count"), two_places(F.avg("conf")).alias("mean_conf"), has(is_symbols(F.col("text"))).alias("noise_count"), has(F.col("text").rlike("[0-9]")).alias("numeric_count"), has(letter_count(F.col("text")) > 0).alias("alpha_count"))


def islands(rows: DataFrame, keys: list[str], value: str, gap: int, order: list[str]) -> DataFrame:
    """rows with island: it grows by one where a value is more than gap above the one before."""
    w = Window.partitionBy(*keys).orderBy(value, *order)
    step = F.when(F.col(value) - F.lag(value).over(w) > gap, 1).otherwise(0)
    return rows.withColumn("_step", step).withColumn("island", (F.sum("_step").over(w) + 1).cast("long")).drop("_step")


def column_candidates(words: DataFrame, key: str = "page", gap: int = 35, least: int = 4) -> DataFrame:
    """Islands of word centers with enough words; numbers count the islands that are dropped too."""
    found = islands(with_centers(words), [key], "mid_x", gap, PLACE)
    out = found.groupBy(key, "island").agg(F.min("mid_x").alias("x_min"), F.max("mid_x").alias("x_max"), F.call_function("format_number", F.avg("mid_x"), F.lit("0.0")).alias("x_mean"), F.count("*").alias("word_count"))
    return out.where(F.col("word_count") >= least)


def median_height(words: DataFrame, key: str = "page") -> DataFrame:
    return words.groupBy(key).agg(F.median(F.col("bottom") - F.col("top")).alias("median_height"))


def percentile_bounds(words: DataFrame, key: str = "page", pad: int = 12) -> DataFrame:
    """Left and right edge of a page's table from the first and last percentile of the words' edges."""
    return words.groupBy(key).agg(F.greatest(F.lit(0), F.round(F.percentile("left_", 0.01), 6).cast("int") - pad).alias("x0"), (F.round(F.percentile("right_", 0.99), 6).cast("int") + pad).alias("x1"))


def cluster_rows(words: DataFrame, key: str = "page", share: float = 0.85, least: int = 18) -> DataFrame:
    """words with row: a word joins the running row if its center is near the row's mean center, halves to even.

    The mean moves with every word, so rows are a fold and not gaps and islands. One page is one group: pages have a
    few thousand words at most, whatever the number of pages.
    """
    schema = "page bigint, line_num int, word_num int, mid_y int, row int"

    def each(words: pa.Table) -> pa.Table:
        heights = words.column("bottom").to_numpy() - words.column("top").to_numpy()
        gap = max(least, round(float(np.median(heights)) * share))
        words = words.sort_by([(c, "ascending") for c in ("mid_y", "left_", *PLACE)])
        rows, row, total, n, center = [], 0, 0, 0, 0
        for y in words.column("mid_y").to_pylist():
            if n == 0 or abs(y - center) > gap:
                row, total, n, center = row + 1, y, 1, y
            else:
                total, n = total + y, n + 1
                center = round(total / n)
            rows.append(row)
        return words.select(["page", "line_num", "word_num", "mid_y"]).append_column("row", pa.array(rows, pa.int32()))

    slim = with_centers(words).select(F.col(key).cast("long").alias("page"), *PLACE, "mid_y", "left_", "top", "bottom")
    return slim.groupBy("page").applyInArrow(each, schema)


def row_bands(rows: DataFrame, key: str = "page", row: str = "row", top: int = 0, bottom: int = 1 << 30, edge: int = 18) -> DataFrame:
    """Band of each row between the middles to its neighbours' centers; rows are words with mid_y and row."""
    centers = rows.groupBy(key, row).agg(F.bround(F.median("mid_y")).cast("int").alias("center"))
    w = Window.partitionBy(key).orderBy(row)
    before, after = F.lag("center").over(w), F.lead("center").over(w)
    half = lambda x: F.bround((x + F.col("center")) / 2).cast("int")
    lo = F.when(before.isNull(), F.greatest(F.lit(top), F.col("center") - edge)).otherwise(half(before))
    hi = F.when(after.isNull(), F.least(F.lit(bottom), F.col("center") + edge)).otherwise(half(after))
    return centers.select(key, row, "center", lo.alias("band_top"), hi.alias("_b")).withColumn("band_bottom", F.greatest(F.col("_b"), F.col("band_top") + 1)).drop("_b")


def bands(columns: list[tuple[str, int, int]]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(a).alias("x0"), F.lit(b).alias("x1"), F.lit(i).alias("pos")) for i, (n, a, b) in enumerate(columns)])


def scaled(columns: list[tuple[str, float, float]], x0: int, x1: int) -> list[tuple[str, int, int]]:
    """Bands in pixels from shares of the width."""
    return [(n, round(x0 + a * max(1, x1 - x0)), round(x0 + b * max(1, x1 - x0))) for n, a, b in columns]


def point_column(x: Column, columns: list[tuple[str, int, int]], nearest: bool = True) -> Column:
    """The first band that holds x; else the one with the nearest edge, or the last."""
    cols = bands(columns)
    inside = F.get(F.filter(cols, lambda c: (x >= c["x0"]) & (x < c["x1"])), F.lit(0))["name"]
    if not nearest:
        return F.coalesce(inside, F.lit(columns[-1][0]))
    near = F.array_min(F.transform(cols, lambda c: F.struct(F.least(F.abs(x - c["x0"]), F.abs(x - c["x1"])).alias("d"), c["pos"].alias("p"), c["name"].alias("name"))))["name"]
    return F.coalesce(inside, near)


def word_cells(word: Column, columns: Column, least: int = 8) -> Column:
    """The cells that a word (struct of left_, right_, mid_x and text) belongs to: structs column, at and part.

    A word goes to the band of its center, else to the widest overlap. A number that spans several bands and looks
    glued is split, its parts going to the bands from left to right, what is over to the last. columns: bands().
    """
    text, mid_x = F.btrim(word["text"]), word["mid_x"]
    width = lambda c: F.least(word["right_"], c["x1"]) - F.greatest(word["left_"], c["x0"])
    over = F.transform(F.filter(columns, lambda c: width(c) > 0), lambda c: F.struct(c["pos"].alias("pos"), c["name"].alias("name"), c["x0"].alias("x0"), c["x1"].alias("x1"), width(c).alias("w")))
    # of the few words that may be split alone are the parts looked for
    marked = F.contains(text, F.lit("/")) | text.rlike(r"\d\s+\d")
    numeric = text.rlike("[0-9]") & ~text.rlike("[A-Za-z]{3,}")

    def chosen(o: Column) -> Column:
        wide = F.filter(o, lambda s: s["w"] >= least)
        return let(F.when(F.size(wide) > 0, wide).otherwise(o), lambda m: let(F.struct(o.alias("o"), m.alias("m"), F.when((F.size(m) > 1) & marked & numeric, numeric_parts(text)).otherwise(F.array().cast("array<string>")).alias("p")), placed))

    def placed(b: Column) -> Column:
        center = F.get(F.filter(b["o"], lambda s: (mid_x >= s["x0"]) & (mid_x < s["x1"])), F.lit(0))["name"]
        widest = F.array_max(F.transform(b["m"], lambda s: F.struct(s["w"].alias("w"), (-s["pos"]).alias("p"), s["name"].alias("name"))))["name"]
        split = F.size(b["p"]) >= 2
        parts = F.transform(b["p"], lambda p, i: F.struct(F.get(b["m"], F.least(i, F.size(b["m"]) - 1))["name"].alias("column"), (word["left_"] + i).alias("at"), p.alias("part")))
        one = F.array(F.struct(F.coalesce(center, widest).alias("column"), word["left_"].alias("at"), text.alias("part")))
        return F.when(F.size(b["o"]) == 0, F.array().cast(CELLS)).otherwise(F.when(split, parts.cast(CELLS)).otherwise(one.cast(CELLS)))

    return let(over, chosen)


def overlap_cells(words: DataFrame, columns: list[tuple[str, int, int]], least: int = 8) -> DataFrame:
    """Words with the column, place and part of each cell they belong to, one row for each."""
    word = F.struct("left_", "right_", mid("left_", "right_").alias("mid_x"), "text")
    return words.withColumn("_c", F.explode(word_cells(word, bands(columns), least))).select(*words.columns, "_c.column", "_c.at", "_c.part")


def cells(assigned: DataFrame, keys: list[str], columns: list[str], at: str = "at", part: str = "part") -> DataFrame:
    """One row for each row of a page, a text for each column; columns are given, so that no pass looks for them."""
    text = lambda c: clean_cell(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("column") == c, F.struct(at, *PLACE, part)))), lambda s: s[part]), " "))
    return assigned.groupBy(*keys).agg(*[text(c).alias(c) for c in columns])


def nearest(x: Column, values: Column) -> Column:
    """The value nearest to x, the first of equally near ones."""
    return F.array_min(F.transform(values, lambda v, i: F.struct(F.abs(v - x).alias("d"), i.alias("i"), v.alias("v"))))["v"]


def snapped(boundaries: Column, rules: Column, tolerance: int = 38, step: int = 8) -> Column:
    """Inner boundaries moved to rules near them; then each at least a step beyond the one before."""
    n = F.size(boundaries)
    moved = F.transform(boundaries, lambda b, i: F.when((i == 0) | (i == n - 1) | (F.size(rules) == 0), b).otherwise(F.when(F.abs(nearest(b, rules) - b) <= tolerance, nearest(b, rules)).otherwise(b)))
    return F.aggregate(moved, F.array().cast("array<int>"), lambda acc, b: F.concat(acc, F.array(F.when(F.size(acc) == 0, b).otherwise(F.greatest(b, F.element_at(acc, -1) + step)).cast("int"))))


def merged_close(values: Column, gap: int = 20) -> Column:
    """Values in order, one within gap of the last kept one being averaged into it."""
    def step(acc, v):
        last = F.element_at(acc, -1)
        near = (F.size(acc) > 0) & (v - last <= gap)
        return F.when(near, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.bround((last + v) / 2).cast("int")))).otherwise(F.concat(acc, F.array(v.cast("int"))))

    return F.aggregate(F.array_sort(values), F.array().cast("array<int>"), step)


def shifted(words: DataFrame, dx: int, dy: int) -> DataFrame:
    """Words of a crop in the coordinates of its page."""
    return words.withColumns({"left_": F.col("left_") + dx, "right_": F.col("right_") + dx, "top": F.col("top") + dy, "bottom": F.col("bottom") + dy})


#: Height of the buckets in which words and bands of a page meet.
BUCKET = 64


def bucketed(top: Column, bottom: Column) -> Column:
    """The buckets that a band touches."""
    k = lambda c: F.floor(c / BUCKET)
    return F.sequence(k(top), F.greatest(k(top), k(bottom)))


def band_words(words: DataFrame, rows: DataFrame, pad: Column) -> DataFrame:
    """Words that touch a row's band and a pad around it; a word may belong to several rows.

    Page and bucket are equal keys, so a word meets the rows near it alone and not all of its page. A word and a row
    that share several buckets meet in the first of them.
    """
    w = words.withColumn("_k", F.explode(bucketed(F.col("top"), F.col("bottom")))).alias("w")
    r = rows.withColumn("_pad", pad).withColumn("_k", F.explode(bucketed(F.col("band_top") - F.col("_pad"), F.col("band_bottom") + F.col("_pad")))).alias("r")
    first = F.expr(f"w._k = greatest(floor(w.top / {BUCKET}), floor((r.band_top - r._pad) / {BUCKET}))")
    return w.join(r, F.expr("w.page = r.page AND w._k = r._k AND w.bottom >= r.band_top - r._pad AND w.top <= r.band_bottom + r._pad") & first)


def keyed(words: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """words with the keys of their page, file, variant and mode; a key that words have already is replaced."""
    return words.withColumns(keys)


def without_header(lines: DataFrame, bottom: int = HEADER_BOTTOM) -> DataFrame:
    """Lines (column top) below a page's header."""
    return lines.where(F.col("top") >= bottom)


def of_crop(words: DataFrame, crop: str, column: str = "crop_file") -> DataFrame:
    """Words of one crop, whichever slashes its path is written with."""
    plain = lambda c: F.translate(c, "\\", "/")
    return words.where(plain(F.col(column)) == plain(F.lit(crop)))


def samples_with(samples: DataFrame, words: DataFrame, lines: DataFrame, key: str = "sample_id") -> DataFrame:
    """samples with the numbers of their words and lines, 0 for none; both are counted before they are joined."""
    count = lambda df, n: df.groupBy(key).agg(F.count("*").alias(n))
    out = samples.join(count(words, "n_words"), key, "left").join(count(lines, "n_lines"), key, "left")
    return out.withColumns({n: F.coalesce(n, F.lit(0)) for n in ("n_words", "n_lines")})
