"""Queries on words of pages, each with its DuckDB form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.dimensions import BASE_WIDTH, BOND_BANDS, COVER_BANDS, DIVIDEND_BANDS, EQUITY_BANDS, HEADER_BOTTOM, LINE_HEADER_TERMS, LINE_SECTION_TERMS, OCR_TERMS, SPECIAL_BANDS
from folioframe.functions import text as T
from folioframe.operators import anchors as A
from folioframe.operators import pages as P
from folioframe.operators import words as W
from folioframe.operators.rescue import backup_texts
from folioframe.sources.rendering import components_of, rendered
from folioframe.sources.tsv import parse_tsv
from folioframe.sources.views import WORDS, words

QUERIES, ORACLES = {}, {}
_RULES = r"^[\s_\-|{}\[\]().,;:!]*$"
_BOND_PIXELS = W.scaled(BOND_BANDS, 0, 2000)


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = f"WITH {WORDS}{sql}" if sql.startswith(",") else f"WITH {WORDS}\n{sql}"
        return f

    return add


def _values(columns) -> str:
    return ", ".join(f"('{n}', {a}, {b}, {i})" for i, (n, a, b) in enumerate(columns))


@query("SELECT page, line_num, word_num, block_num, psm, text, left_, right_, top, bottom, conf FROM v_words")
def words_from_text(spark: SparkSession, d: str) -> DataFrame:
    return words(spark, d)


@query("""SELECT page, line_num, word_num, (conf - 3)::DOUBLE AS conf, round_even(left_ / 2.0, 0)::INTEGER AS left_, round_even(top / 2.0, 0)::INTEGER AS top,
  round_even(left_ / 2.0, 0)::INTEGER + round_even((right_ - left_) / 2.0, 0)::INTEGER AS right_, round_even(top / 2.0, 0)::INTEGER + round_even((bottom - top) / 2.0, 0)::INTEGER AS bottom, text
FROM v_words WHERE word_num % 7 <> 0 AND conf >= 3""")
def tsv_word_parse(spark: SparkSession, d: str) -> DataFrame:
    w = words(spark, d)
    level = F.when(F.col("word_num") % 7 == 0, "4").otherwise("5")
    line = F.concat_ws("\t", level, F.col("page").cast("string"), F.lit("1"), F.lit("1"), F.col("line_num").cast("string"), F.col("word_num").cast("string"), F.col("left_").cast("string"), F.col("top").cast("string"), (F.col("right_") - F.col("left_")).cast("string"), (F.col("bottom") - F.col("top")).cast("string"), (F.col("conf") - 3).cast("string"), F.col("text"))
    return parse_tsv(w.select(line.alias("value")), scale=2.0).select(F.col("page_num").cast("long").alias("page"), "line_num", "word_num", "conf", "left_", "top", "right_", "bottom", "text")


@query(f"""SELECT page, count(*) FILTER (WHERE NOT regexp_matches(text, '{_RULES}') AND conf >= 12) AS n_equity, count(*) FILTER (WHERE NOT regexp_matches(text, '{_RULES}') AND conf >= 8) AS n_generic,
  count(*) FILTER (WHERE regexp_matches(text, '[\\pL\\pN]') AND conf >= 15) AS n_debug FROM v_words GROUP BY page""")
def useful_words(spark: SparkSession, d: str) -> DataFrame:
    return words(spark, d).groupBy("page").agg(*[F.count_if(W.useful(k)).alias(f"n_{k}") for k in ("equity", "generic", "debug")])


@query("SELECT page, line_num, word_num, text FROM v_words WHERE NOT regexp_matches(text, '[\\pL\\pN]')")
def noise_tokens(spark: SparkSession, d: str) -> DataFrame:
    return words(spark, d).where(T.is_symbols(F.col("text"))).select("page", *W.PLACE, "text")


@query("SELECT page, count(*) AS n_words, min(top) AS first_top FROM v_words WHERE bottom >= 90 AND top <= 300 AND conf > 0 GROUP BY page")
def body_band_words(spark: SparkSession, d: str) -> DataFrame:
    return words(spark, d).where(W.in_band(90, 300) & (F.col("conf") > 0)).groupBy("page").agg(F.count("*").alias("n_words"), F.min("top").alias("first_top"))


@query("SELECT page, count(*) FILTER (WHERE NOT tall) AS kept, count(*) FILTER (WHERE tall) AS removed FROM (SELECT page, (24 + conf % 60 > 66 AND right_ - left_ < 260) AS tall FROM v_words) GROUP BY page")
def tall_artifacts_removed(spark: SparkSession, d: str) -> DataFrame:
    w = words(spark, d).withColumn("bottom", F.col("top") + 24 + F.col("conf") % 60)
    return w.groupBy("page").agg(F.count_if(~W.is_tall()).alias("kept"), F.count_if(W.is_tall()).alias("removed"))


@query(f"""SELECT page, psm, count(*) AS n_words FROM (SELECT *, min(psm) OVER (PARTITION BY page) AS best FROM (SELECT page, conf, text, ['6', '11', '12', '3'][word_num % 4 + 1] AS psm FROM v_words)
  WHERE NOT regexp_matches(text, '{_RULES}') AND conf >= 8 QUALIFY coalesce(psm = min(CASE WHEN psm IN ('6', '11', '12') THEN psm END) OVER (PARTITION BY page), TRUE)) GROUP BY page, psm""")
def primary_psm_words(spark: SparkSession, d: str) -> DataFrame:
    psm = F.element_at(F.array(*map(F.lit, ("6", "11", "12", "3"))), F.col("word_num") % 4 + 1)
    return W.primary(words(spark, d).withColumn("psm", psm), ["page"]).groupBy("page", "psm").agg(F.count("*").alias("n_words"))


@query("""SELECT page, count(*) AS n_words FROM (SELECT *, count(*) FILTER (WHERE ok) OVER (PARTITION BY page) AS n_ok FROM (SELECT page, my >= floor(h * lo) AND my <= floor(h * hi) AS ok FROM
  (SELECT page, (top + bottom) // 2 AS my, max(bottom) OVER (PARTITION BY page) AS h, CASE page % 3 WHEN 0 THEN 0.135 WHEN 1 THEN 0.07 ELSE 0.06 END AS lo, CASE page % 3 WHEN 0 THEN 0.895 WHEN 1 THEN 0.9 ELSE 0.93 END AS hi FROM v_words))) WHERE ok OR n_ok = 0 GROUP BY page""")
def body_fraction_words(spark: SparkSession, d: str) -> DataFrame:
    from folioframe.operators.pages import body_words

    kind = F.when(F.col("page") % 3 == 0, "regular_obbligazioni").when(F.col("page") % 3 == 1, "regular_azioni").otherwise("special_market_lists")
    w = words(spark, d, together=True).withColumns({"page_type": kind, "page_height": F.max("bottom").over(Window.partitionBy("page"))})
    return body_words(w).groupBy("page").agg(F.count("*").alias("n_words"))


_LINES = """SELECT page, line_num, min(left_) AS left_, min(top) AS top, max(right_) AS right_, max(bottom) AS bottom, count(*) AS word_count, printf('%.2f', avg(conf)) AS mean_conf, string_agg(text, ' ' ORDER BY left_, top, line_num, word_num) AS text FROM v_words GROUP BY page, line_num"""


@query(_LINES)
def words_to_lines(spark: SparkSession, d: str) -> DataFrame:
    return W.lines(words(spark, d, together=True), ["page", "line_num"])


@query("""SELECT page, line_num, psm, count(*) AS word_count, coalesce(printf('%.2f', avg(conf) FILTER (WHERE conf >= 0)), '') AS mean_conf FROM (SELECT page, line_num, psm, conf - 20 AS conf FROM v_words) GROUP BY page, line_num, psm""")
def words_to_lines_variant(spark: SparkSession, d: str) -> DataFrame:
    w = words(spark, d).withColumn("conf", F.col("conf") - 20)
    return W.lines(w, ["page", "line_num", "psm"], positive_only=True).select("page", "line_num", "psm", "word_count", "mean_conf")


@query("SELECT page, string_agg(text, ' ' ORDER BY top, left_, line_num, word_num) AS text FROM v_words GROUP BY page")
def page_text(spark: SparkSession, d: str) -> DataFrame:
    return W.page_text(words(spark, d, together=True))


_QUALITY = "SELECT page, count(*) AS word_count, printf('%.2f', avg(conf)) AS mean_conf, count(*) FILTER (WHERE NOT regexp_matches(text, '[\\pL\\pN]')) AS noise_count, count(*) FILTER (WHERE regexp_matches(text, '[0-9]')) AS numeric_count, count(*) FILTER (WHERE regexp_matches(text, '\\pL')) AS alpha_count FROM v_words GROUP BY page"


@query(_QUALITY)
def page_quality(spark: SparkSession, d: str) -> DataFrame:
    return W.quality(words(spark, d))


@query("SELECT page, concat_ws(';', CASE WHEN word_count < 30 THEN 'low_word_count' END, CASE WHEN mc < 45 THEN 'low_mean_ocr_confidence' END) AS review_flags FROM (SELECT page, count(*) AS word_count, avg(conf) AS mc FROM v_words GROUP BY page)")
def page_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    q = words(spark, d).groupBy("page").agg(F.count("*").alias("n"), F.avg("conf").alias("c"))
    flags = F.array_compact(F.array(F.when(F.col("n") < 30, "low_word_count"), F.when(F.col("c") < 45, "low_mean_ocr_confidence")))
    return q.select("page", F.array_join(flags, ";").alias("review_flags"))


@query("""SELECT page, island, min(mid_x) AS x_min, max(mid_x) AS x_max, printf('%.1f', avg(mid_x)) AS x_mean, count(*) AS word_count FROM (SELECT page, mid_x, sum(step) OVER (PARTITION BY page ORDER BY mid_x, line_num, word_num)::BIGINT + 1 AS island FROM
  (SELECT page, mid_x, line_num, word_num, CASE WHEN mid_x - lag(mid_x) OVER (PARTITION BY page ORDER BY mid_x, line_num, word_num) > 35 THEN 1 ELSE 0 END AS step FROM (SELECT *, (left_ + right_) // 2 AS mid_x FROM v_words))) GROUP BY page, island HAVING count(*) >= 4""")
def column_candidates(spark: SparkSession, d: str) -> DataFrame:
    return W.column_candidates(words(spark, d))


# a recursive statement of this fold takes minutes in SQL; tests hold it against a plain loop
@query(None)
def row_cluster(spark: SparkSession, d: str) -> DataFrame:
    return W.cluster_rows(words(spark, d, together=True))


@query("""SELECT page, line_num AS "row", center, band_top, greatest(hi, band_top + 1) AS band_bottom FROM (SELECT page, line_num, center, coalesce(round_even((lag(center) OVER o + center) / 2.0, 0)::INTEGER, greatest(60, center - 18)) AS band_top, coalesce(round_even((lead(center) OVER o + center) / 2.0, 0)::INTEGER, least(2000, center + 18)) AS hi
  FROM (SELECT page, line_num, round_even(median((top + bottom) // 2), 0)::INTEGER AS center FROM v_words GROUP BY page, line_num) WINDOW o AS (PARTITION BY page ORDER BY line_num))""")
def row_bands(spark: SparkSession, d: str) -> DataFrame:
    return W.row_bands(W.with_centers(words(spark, d)).withColumnRenamed("line_num", "row"), top=60, bottom=2000)


@query("SELECT page, line_num, count(*) AS word_count, min(left_) AS \"left\", max(right_) AS \"right\", min(top) AS word_top, max(bottom) AS word_bottom, printf('%.2f', avg(conf)) AS mean_conf, string_agg(text, ' ' ORDER BY left_, word_num) AS raw_text FROM v_words GROUP BY page, line_num")
def row_records(spark: SparkSession, d: str) -> DataFrame:
    return words(spark, d, together=True).groupBy("page", "line_num").agg(F.count("*").alias("word_count"), F.min("left_").alias("left"), F.max("right_").alias("right"), F.min("top").alias("word_top"), F.max("bottom").alias("word_bottom"), W.two_places(F.avg("conf")).alias("mean_conf"), W.joined(["left_", "word_num"]).alias("raw_text"))


@query("SELECT page, median(right_ - left_)::DOUBLE AS median_width, max(right_) AS page_width FROM v_words GROUP BY page")
def median_sizes(spark: SparkSession, d: str) -> DataFrame:
    return words(spark, d).groupBy("page").agg(F.median(F.col("right_") - F.col("left_")).alias("median_width"), F.max("right_").alias("page_width"))


@query("SELECT page, greatest(0, trunc(round(quantile_cont(left_, 0.01), 6))::INTEGER - 12) AS x0, trunc(round(quantile_cont(right_, 0.99), 6))::INTEGER + 12 AS x1 FROM v_words GROUP BY page")
def percentile_bounds(spark: SparkSession, d: str) -> DataFrame:
    return W.percentile_bounds(words(spark, d))


@query(f"""SELECT page, "column", count(*) AS n_words FROM (SELECT page, coalesce((SELECT name FROM (VALUES {_values(_BOND_PIXELS)}) c(name, x0, x1, pos) WHERE mx >= x0 AND mx < x1 ORDER BY pos LIMIT 1),
  (SELECT name FROM (VALUES {_values(_BOND_PIXELS)}) c(name, x0, x1, pos) ORDER BY least(abs(mx - x0), abs(mx - x1)), pos LIMIT 1)) AS "column" FROM (SELECT page, (left_ + right_) // 2 AS mx FROM v_words)) GROUP BY page, "column" """)
def assign_point_columns(spark: SparkSession, d: str) -> DataFrame:
    w = W.with_centers(words(spark, d)).withColumn("column", W.point_column(F.col("mid_x"), _BOND_PIXELS))
    return w.groupBy("page", "column").agg(F.count("*").alias("n_words"))


_OVERLAP = f"""oc AS (SELECT page, line_num, word_num, left_, text, (left_ + right_) // 2 AS mx, name, x0, x1, pos, least(right_, x1) - greatest(left_, x0) AS w FROM v_words JOIN (VALUES {_values(EQUITY_BANDS)}) c(name, x0, x1, pos) ON least(right_, x1) - greatest(left_, x0) > 0),
ok AS (SELECT *, max(w) OVER (PARTITION BY page, line_num, word_num) >= 8 AS any_wide FROM oc),
best AS (SELECT page, line_num, word_num, left_, text, coalesce(min(CASE WHEN mx >= x0 AND mx < x1 THEN name END), arg_max(CASE WHEN w >= 8 OR NOT any_wide THEN name END, w * 100 - pos)) AS "column" FROM ok GROUP BY ALL)"""


def _best_sql(tail: str) -> str:
    # group by the word's own columns only
    return "oc AS (" + _OVERLAP.split("oc AS (", 1)[1].replace("GROUP BY ALL", "GROUP BY page, line_num, word_num, left_, text") + "\n" + tail


@query(None)
def assign_overlap_columns(spark: SparkSession, d: str) -> DataFrame:
    c = W.overlap_cells(words(spark, d), EQUITY_BANDS)
    return c.groupBy("page", "column").agg(F.count("*").alias("n_words"), F.sum(F.length("part")).alias("n_chars"))


# prose holds no glued numbers, so that every word stays whole here; tests cover the split
ORACLES["assign_overlap_columns"] = f"WITH {WORDS},\n" + _best_sql('SELECT page, "column", count(*) AS n_words, sum(length(text))::BIGINT AS n_chars FROM best GROUP BY page, "column"')


@query(f"""SELECT page, line_num, {", ".join(f"coalesce(trim(regexp_replace(translate(string_agg(text, ' ' ORDER BY left_, line_num, word_num) FILTER (WHERE pos = {k}), '{{}}[]|', '     '), '\\s+', ' ', 'g')), '') AS {n}" for k, (n, _, _) in enumerate(_BOND_PIXELS))}
FROM (SELECT *, coalesce((SELECT pos FROM (VALUES {_values(_BOND_PIXELS)}) c(name, x0, x1, pos) WHERE mx >= x0 AND mx < x1 ORDER BY pos LIMIT 1), (SELECT pos FROM (VALUES {_values(_BOND_PIXELS)}) c(name, x0, x1, pos) ORDER BY least(abs(mx - x0), abs(mx - x1)), pos LIMIT 1)) AS pos
  FROM (SELECT *, (left_ + right_) // 2 AS mx FROM v_words)) GROUP BY page, line_num""")
def cells_pivot(spark: SparkSession, d: str) -> DataFrame:
    w = W.with_centers(words(spark, d, together=True)).withColumn("column", W.point_column(F.col("mid_x"), _BOND_PIXELS)).withColumns({"at": F.col("left_"), "part": F.col("text")})
    return W.cells(w, ["page", "line_num"], [n for n, _, _ in _BOND_PIXELS])


# the page's first line stands for its detected rules
_FITTED = f"""pg AS (SELECT page, min(left_) AS tx0, max(right_) AS tx1, coalesce(list(DISTINCT left_ ORDER BY left_) FILTER (WHERE line_num = 1), []) AS rules FROM v_words GROUP BY page),
ex AS (SELECT page, tx0, tx1, rules, c.name, pos, round_even(tx0 + c.x0 * ((tx1 - tx0) / {BASE_WIDTH}), 0)::INTEGER AS a, round_even(tx0 + c.x1 * ((tx1 - tx0) / {BASE_WIDTH}), 0)::INTEGER AS b FROM pg, (VALUES {_values(EQUITY_BANDS)}) c(name, x0, x1, pos)),
nr AS (SELECT *, (SELECT r FROM unnest(rules) u(r) ORDER BY abs(r - a), r LIMIT 1) AS ra, (SELECT r FROM unnest(rules) u(r) ORDER BY abs(r - b), r LIMIT 1) AS rb FROM ex),
mv AS (SELECT *, CASE WHEN abs(ra - a) <= 35 AND ra BETWEEN tx0 - 15 AND tx1 + 15 THEN ra ELSE a END AS c, CASE WHEN abs(rb - b) <= 35 AND rb BETWEEN tx0 - 15 AND tx1 + 15 THEN rb ELSE b END AS d FROM nr),
fitted AS (SELECT page, name AS "column", greatest(0, CASE WHEN d <= c + 10 THEN a ELSE c END) AS x0, CASE WHEN d <= c + 10 THEN b ELSE d END AS x1 FROM mv)"""


def page_columns(w: DataFrame) -> DataFrame:
    pages = w.groupBy("page").agg(F.min("left_").alias("x0"), F.max("right_").alias("x1"), F.array_sort(F.collect_set(F.when(F.col("line_num") == 1, F.col("left_")))).alias("rules"))
    return A.fitted_columns(pages, EQUITY_BANDS, BASE_WIDTH)


@query(f""", {_FITTED}
SELECT page, "column", x0, x1 FROM fitted""")
def nearest_rule_snap(spark: SparkSession, d: str) -> DataFrame:
    return page_columns(words(spark, d))


_EDGES = [_BOND_PIXELS[0][1], *[b for _, _, b in _BOND_PIXELS]]


@query(f""", pr AS (SELECT page, list(DISTINCT left_ ORDER BY left_) AS rules FROM v_words GROUP BY page),
mv AS (SELECT page, list_transform({_EDGES}, lambda b, i: CASE WHEN i IN (1, {len(_EDGES)}) THEN b ELSE coalesce(list_transform(list_sort(list_transform(list_filter(rules, lambda r: abs(r - b) <= 38), lambda r: {{'d': abs(r - b), 'r': r}})), lambda s: s.r)[1], b) END) AS moved FROM pr)
SELECT page, array_to_string(list_reduce(list_transform(moved, lambda x: [x]), lambda a, b: list_append(a, greatest(b[1], a[-1] + 8))), ',') AS edges FROM mv""")
def monotone_snap(spark: SparkSession, d: str) -> DataFrame:
    rules = words(spark, d).groupBy("page").agg(F.array_sort(F.collect_set("left_")).alias("rules"))
    edges = F.array(*[F.lit(x) for x in [_BOND_PIXELS[0][1], *[b for _, _, b in _BOND_PIXELS]]])
    return rules.select("page", F.array_join(W.snapped(edges, F.col("rules")), ",").alias("edges"))


@query("""SELECT page, array_to_string(list_reduce(list_transform(x, lambda v: [v]), lambda a, b: CASE WHEN b[1] - a[-1] <= 20 THEN list_append(a[:-2], round_even((a[-1] + b[1]) / 2.0, 0)::INTEGER) ELSE list_append(a, b[1]) END), ',') AS rules FROM (SELECT page, list(left_ ORDER BY left_) AS x FROM v_words GROUP BY page)""")
def merged_rules(spark: SparkSession, d: str) -> DataFrame:
    return words(spark, d, together=True).groupBy("page").agg(F.collect_list("left_").alias("x")).select("page", F.array_join(W.merged_close(F.col("x")), ",").alias("rules"))


@query("""SELECT page, anchor, count(*) AS n_words FROM (SELECT page, CASE WHEN (CASE WHEN lo IS NULL THEN hi - top WHEN hi IS NULL THEN top - lo ELSE least(top - lo, hi - top) END) <= tol THEN CASE WHEN lo IS NOT NULL AND (hi IS NULL OR top - lo <= hi - top) THEN i - 1 ELSE i END ELSE -1 END::BIGINT AS anchor
FROM (SELECT page, top, tol, i, tops[i] AS lo, tops[i + 1] AS hi FROM (SELECT w.page, w.top, tops, tol, len(list_filter(tops, lambda t: t <= w.top)) AS i FROM v_words w JOIN (SELECT page, list(DISTINCT top ORDER BY top) FILTER (WHERE word_num = 1 AND line_num % 2 = 1) AS tops, greatest(26, round_even(median(bottom - top) * 1.15, 0)) AS tol FROM v_words GROUP BY page) USING (page)))) GROUP BY page, anchor""")
def nearest_anchor(spark: SparkSession, d: str) -> DataFrame:
    w = words(spark, d, together=True)
    # words of one top have one anchor, and a page's median is that of its counted heights
    tops = w.groupBy("page", "top", (F.col("bottom") - F.col("top")).alias("h")).agg(F.count("*").alias("n"), F.bool_or((F.col("word_num") == 1) & (F.col("line_num") % 2 == 1)).alias("is_anchor"))
    tops = tops.withColumn("median_height", F.percentile("h", F.lit(0.5), F.col("n")).over(Window.partitionBy("page")))
    at = A.nearest_anchors(tops.drop("h", "is_anchor"), tops.where("is_anchor"), A.anchor_tolerance(F.col("median_height")))
    return at.groupBy("page", F.coalesce("anchor", F.lit(-1)).alias("anchor")).agg(F.sum("n").alias("n_words"))


@query("""SELECT page, anchor, count(*) AS n_words FROM (SELECT w.page, CASE WHEN tops IS NOT NULL THEN greatest(len(list_filter(tops, lambda t: t <= w.top - 6)) - 1, 0) ELSE -1 END::BIGINT AS anchor FROM v_words w JOIN (SELECT page, list(DISTINCT top ORDER BY top) FILTER (WHERE word_num = 1) AS tops FROM v_words GROUP BY page) USING (page)) GROUP BY page, anchor""")
def asof_anchor(spark: SparkSession, d: str) -> DataFrame:
    w = words(spark, d, together=True)
    tops = w.groupBy("page", "top").agg(F.count("*").alias("n"))  # words of one top have one anchor
    return A.asof_anchors(tops, w.where("word_num = 1"), 6).groupBy("page", F.coalesce("anchor", F.lit(-1)).alias("anchor")).agg(F.sum("n").alias("n_words"))


@query(None)
def issuer_anchor_rows(spark: SparkSession, d: str) -> DataFrame:
    issuer = next((a, b) for n, a, b in EQUITY_BANDS if n == "issuer_name_raw")
    return A.issuer_anchor_rows(words(spark, d, together=True).where(W.useful("equity") & ~W.is_tall()), issuer)


@query(None)
def bond_anchor_split(spark: SparkSession, d: str) -> DataFrame:
    """Two lines of a page are one merged row."""
    band = {n: (a, b) for n, a, b in _BOND_PIXELS}
    w = words(spark, d, together=True).withColumn("row", F.floor((F.col("line_num") + 1) / 2).cast("int"))
    return A.bond_anchor_parts(w, [band["capital_in_circulation_raw"], band["nominal_value_raw"], band["maturity_year_raw"]], band["security_name_raw"])


@query(f""", {_FITTED},
rb AS (SELECT page, line_num AS row_index, min(top) AS band_top, max(bottom) AS band_bottom FROM v_words GROUP BY page, line_num),
bw AS (SELECT page, line_num, word_num, left_, text, (left_ + right_) // 2 AS mx, (top + bottom) // 2 AS my FROM v_words WHERE NOT regexp_matches(text, '{_RULES}') AND conf >= 12)
SELECT w.page, row_index, "column", trim(regexp_replace(translate(string_agg(text, ' ' ORDER BY left_, line_num, word_num), '{{}}[]|', '     '), '\\s+', ' ', 'g')) AS text FROM bw w JOIN rb r ON w.page = r.page AND my >= band_top AND my < band_bottom JOIN fitted c ON c.page = w.page AND mx >= c.x0 AND mx < c.x1 GROUP BY w.page, row_index, "column" """)
def backup_cell_texts(spark: SparkSession, d: str) -> DataFrame:
    w = words(spark, d, together=True)
    rows = w.groupBy("page", F.col("line_num").alias("row_index")).agg(F.min("top").alias("band_top"), F.max("bottom").alias("band_bottom"))
    return backup_texts(rows, page_columns(w), w)


@query("""SELECT r.page, r.line_num AS "row", count(*) AS n_words FROM (SELECT page, line_num, min(top) AS band_top, max(bottom) AS band_bottom, greatest(3, ((max(bottom) - min(top)) * 0.25)::DECIMAL(18, 4)::DOUBLE) AS pad FROM v_words GROUP BY page, line_num) r
  JOIN v_words w ON w.page = r.page AND w.bottom >= r.band_top - floor(pad) AND w.top <= r.band_bottom + floor(pad) GROUP BY r.page, r.line_num""")
def strip_band_join(spark: SparkSession, d: str) -> DataFrame:
    w = words(spark, d, together=True)
    rows = w.groupBy("page", F.col("line_num").alias("row")).agg(F.min("top").alias("band_top"), F.max("bottom").alias("band_bottom"))
    pad = F.greatest(F.lit(3), F.floor((F.col("band_bottom") - F.col("band_top")) * 0.25))
    return W.band_words(w, rows, pad).groupBy("r.page", "r.row").agg(F.count("*").alias("n_words"))


@query(f"""SELECT page, line_num, list_filter({[t.lower() for t in OCR_TERMS]!r}, lambda t: contains(lower(txt), t)) <> [] AS has_terms, length(regexp_replace(txt, '[^0-9]', '', 'g'))::INTEGER AS digits, length(regexp_replace(txt, '[^\\pL]', '', 'g'))::INTEGER AS letters,
  CASE WHEN length(regexp_replace(txt, '[^\\pL]', '', 'g')) > 0 AND length(regexp_replace(txt, '[^\\p{{Lu}}]', '', 'g')) / greatest(length(regexp_replace(txt, '[^\\pL]', '', 'g')), 1) > 0.55 AND length(txt) < 120 THEN 'heading' ELSE 'paragraph' END AS record_role
  FROM (SELECT page, line_num, string_agg(text, ' ' ORDER BY left_, word_num) AS txt FROM v_words GROUP BY page, line_num)""")
def text_page_rows(spark: SparkSession, d: str) -> DataFrame:
    t = words(spark, d, together=True).groupBy("page", "line_num").agg(W.joined(["left_", "word_num"]).alias("t"))
    return t.select("page", "line_num", (F.size(T.terms_in(F.col("t"), OCR_TERMS)) > 0).alias("has_terms"), T.digit_count(F.col("t")).alias("digits"), T.letter_count(F.col("t")).alias("letters"), T.heading_role(F.col("t")).alias("record_role"))


@query("""SELECT page, line_num, n < 3 OR alnum < greatest(2, 0.25 * n) AS row_noise, regexp_matches(txt, '[0-9]|[A-ZÀ-Ý][a-zà-ÿ]{2}') AS data_signal FROM (SELECT page, line_num, txt, length(regexp_replace(txt, '\\s', '', 'g')) AS n, length(regexp_replace(txt, '[^\\pL\\pN]', '', 'g')) AS alnum FROM (SELECT page, line_num, string_agg(text, ' ' ORDER BY left_, word_num) AS txt FROM v_words GROUP BY page, line_num))""")
def row_noise_signal(spark: SparkSession, d: str) -> DataFrame:
    t = words(spark, d, together=True).groupBy("page", "line_num").agg(W.joined(["left_", "word_num"]).alias("t"))
    n, alnum = F.length(F.regexp_replace("t", r"\s", "")), F.regexp_count("t", F.lit(r"[\p{L}\p{N}]"))
    return t.select("page", "line_num", ((n < 3) | (alnum < F.greatest(F.lit(2.0), 0.25 * n))).alias("row_noise"), F.col("t").rlike("[0-9]|[A-ZÀ-Ý][a-zà-ÿ]{2}").alias("data_signal"))


# the summaries of a page

_LINES = """ln AS (SELECT page, line_num, min(top) AS top, string_agg(text, ' ' ORDER BY left_, word_num) AS txt FROM v_words GROUP BY page, line_num)"""


def page_lines(w: DataFrame) -> DataFrame:
    return w.groupBy("page", "line_num").agg(F.min("top").alias("top"), W.joined(["left_", "word_num"]).alias("txt"))


@query("SELECT page, max(right_) + 1 AS width FROM v_words GROUP BY page")
def page_width(spark: SparkSession, d: str) -> DataFrame:
    return P.page_width(words(spark, d))


_LOWER = "lower(trim(regexp_replace(txt, '\\s+', ' ', 'g')))"


@query(f""", {_LINES}
SELECT page, line_num, CASE WHEN top < 190 OR {" OR ".join(f"contains({_LOWER}, '{t}')" for t in LINE_HEADER_TERMS)} THEN 'header_or_column_label' WHEN {" OR ".join(f"contains({_LOWER}, '{t}')" for t in LINE_SECTION_TERMS)} THEN 'section_heading' WHEN regexp_matches({_LOWER}, '[0-9]') THEN 'candidate_data_line' ELSE 'text_line' END AS line_type FROM ln""")
def line_types(spark: SparkSession, d: str) -> DataFrame:
    return page_lines(words(spark, d, together=True)).select("page", "line_num", P.line_type(F.col("txt"), F.col("top")).alias("line_type"))


@query(f""", {_LINES}
SELECT page, count(*) AS records, count(*) FILTER (WHERE regexp_matches(txt, '[0-9]')) AS candidate_records, count(*) FILTER (WHERE NOT regexp_matches(txt, '[0-9]')) AS text_records, count(*) FILTER (WHERE length(txt) < 20) AS flagged_records FROM ln GROUP BY page""")
def parse_summary(spark: SparkSession, d: str) -> DataFrame:
    """A line with a digit is a candidate, and one of under 20 characters is flagged as a fragment."""
    lines = page_lines(words(spark, d, together=True))
    kind = F.when(F.col("txt").rlike("[0-9]"), "candidate_record").otherwise("text_line")
    flags = F.when(F.length("txt") < 20, F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    return P.parse_summary(lines.select("page", kind.alias("record_type"), flags.alias("validation_flags")), ["page"])


_TYPED = {"cover_valori_stato": W.scaled(COVER_BANDS, 0, 2000), "dividendi_in_pagamento": W.scaled(DIVIDEND_BANDS, 0, 2000), "special_market_lists": W.scaled(SPECIAL_BANDS, 0, 2000)}


def _point_sql(columns) -> str:
    inside = f"(SELECT name FROM (VALUES {_values(columns)}) c(name, x0, x1, pos) WHERE mx >= x0 AND mx < x1 ORDER BY pos LIMIT 1)"
    near = f"(SELECT name FROM (VALUES {_values(columns)}) c(name, x0, x1, pos) ORDER BY least(abs(mx - x0), abs(mx - x1)), pos LIMIT 1)"
    return f"coalesce({inside}, {near})"


@query(f"""SELECT page, line_num, page_type, "column", string_agg(text, ' ' ORDER BY left_, word_num) AS text FROM (SELECT page, line_num, word_num, left_, text, page_type, CASE page_type {" ".join(f"WHEN '{t}' THEN {_point_sql(c)}" for t, c in _TYPED.items())} END AS "column"
  FROM (SELECT *, (left_ + right_) // 2 AS mx, {list(_TYPED)!r}[page % 3 + 1] AS page_type FROM v_words)) GROUP BY page, line_num, page_type, "column" """)
def typed_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of cover, dividend and special pages, each by the bands of its type."""
    kind = F.element_at(F.array(*map(F.lit, _TYPED)), (F.col("page") % 3 + 1).cast("int"))
    w = W.with_centers(words(spark, d, together=True)).withColumn("page_type", kind)
    column = F.coalesce(*[F.when(F.col("page_type") == t, W.point_column(F.col("mid_x"), c)) for t, c in _TYPED.items()])
    return w.groupBy("page", "line_num", "page_type", column.alias("column")).agg(W.joined(["left_", "word_num"]).alias("text"))


@query(f"""SELECT page, line_num, printf('page-%d', page) AS sample_id, count(*) AS n_words, min(psm) AS psm, min(ocr_variant) AS ocr_variant FROM (SELECT *, CASE WHEN page % 2 = 0 THEN 'original_full' ELSE 'line_removed_full' END AS ocr_variant, min(top) OVER (PARTITION BY page, line_num) AS first FROM v_words) WHERE first >= {HEADER_BOTTOM} GROUP BY page, line_num""")
def keyed_lines(spark: SparkSession, d: str) -> DataFrame:
    """Words with their page's keys, in lines without those of the header."""
    variant = F.when(F.col("page") % 2 == 0, "original_full").otherwise("line_removed_full")
    keyed = W.keyed(words(spark, d), {"sample_id": F.concat_ws("-", F.lit("page"), F.col("page").cast("string")), "ocr_variant": variant, "psm": F.col("psm")})
    lines = keyed.groupBy("page", "line_num", "sample_id").agg(F.count("*").alias("n_words"), F.min("psm").alias("psm"), F.min("ocr_variant").alias("ocr_variant"), F.min("top").alias("top"))
    return W.without_header(lines).drop("top")


@query("SELECT page, count(*) AS n_components, sum((right_ - left_) // 10 * (bottom - top))::BIGINT AS ink, min(left_) // 10 AS x0, max(right_) // 10 AS x1, min(top) AS y0, max(bottom) AS y1 FROM v_words GROUP BY page")
def page_components(spark: SparkSession, d: str) -> DataFrame:
    """Connected components of each page's image, in which a word is a dark box."""
    return components_of(rendered(words(spark, d, together=True)))
