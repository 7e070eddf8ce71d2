"""Queries on pages: labels, routing, samples, headings, flags, scan names and boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.dimensions import HEADING_PATTERNS, PAGE_OVERRIDES, PAGE_TYPES
from folioframe.operators import layout as L
from folioframe.operators import pages as P
from folioframe.operators import reports
from folioframe.operators.sections import table_row_type
from folioframe.sources.resume import resolved
from folioframe.sources.scans import manifest_rows, scan_name
from folioframe.sources.views import PAGES, pages, read

QUERIES, ORACLES = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = f"WITH {PAGES}{sql}" if sql.startswith(",") else f"WITH {PAGES}\n{sql}"
        return f

    return add


_OVER = ", ".join(str(o) for o in PAGE_OVERRIDES)
_LABELS = f""",
lb AS (SELECT page_id, v.date, v.picture, v.side, url, html, coalesce(o.t, CASE WHEN v.picture IN (1, 5) AND v.side = 'left' THEN 'dividendi_in_pagamento' WHEN v.picture IN (1, 5) THEN 'cover_valori_stato' WHEN v.picture = 2 THEN 'regular_obbligazioni' WHEN v.picture = 3 THEN 'regular_azioni' WHEN v.picture = 4 AND v.side = 'left' THEN 'comunicati_notizie' WHEN v.picture = 4 THEN 'special_market_lists' ELSE 'unknown_review' END) AS page_type,
  coalesce(o.c, CASE WHEN v.picture IN (1, 2, 3, 5) OR (v.picture = 4 AND v.side = 'left') THEN 'high' WHEN v.picture = 4 THEN 'medium' ELSE 'low' END) AS confidence FROM v_pages v LEFT JOIN (VALUES {_OVER}) o(date, picture, side, t, c) USING (date, picture, side))"""


def labels(spark: SparkSession, d: str) -> DataFrame:
    return P.labelled(spark, pages(spark, d))


@query(_LABELS + "\nSELECT page_id, date, picture, side, page_type, confidence, CASE WHEN confidence = 'high' THEN 'no' ELSE 'yes' END AS needs_review FROM lb")
def page_type_labels(spark: SparkSession, d: str) -> DataFrame:
    return labels(spark, d).select("page_id", "date", "picture", "side", "page_type", "confidence", "needs_review")


@query(_LABELS + "\nSELECT page_type, count(*) AS n FROM lb GROUP BY page_type")
def page_type_counts(spark: SparkSession, d: str) -> DataFrame:
    return labels(spark, d).groupBy("page_type").agg(F.count("*").alias("n"))


@query(_LABELS + "\nSELECT page_id, page_type FROM (SELECT page_id, page_type FROM lb QUALIFY row_number() OVER (PARTITION BY page_type ORDER BY page_id) <= 2) ORDER BY page_id LIMIT 11")
def sample_per_type(spark: SparkSession, d: str) -> DataFrame:
    return P.sampled(labels(spark, d), 2, "page_id", 11).select("page_id", "page_type")


_STATUS = "CASE page_type " + " ".join(f"WHEN '{t}' THEN '{s}'" for t, s, _ in PAGE_TYPES) + " END"


@query(_LABELS + f"\nSELECT page_id, {_STATUS} AS strategy_status, CASE WHEN page_type IN ('regular_azioni', 'regular_obbligazioni', 'cover_valori_stato', 'dividendi_in_pagamento', 'special_market_lists') THEN 'table' WHEN page_type IN ('comunicati_notizie', 'advertisement_notice') THEN 'text' WHEN page_type = 'blank_or_divider' THEN 'skip' ELSE 'generic' END AS route FROM lb")
def page_router(spark: SparkSession, d: str) -> DataFrame:
    return P.routed(spark, labels(spark, d)).select("page_id", "strategy_status", "route")


_TEXT = "(['Titoli azionari', 'OBBLIGAZIONI: valori di stato', 'Listino ufficiale, borsa di Milano', 'dividendi', 'Comunicati e notizie', 'ordine di chiamata'])[page_id % 6 + 1]"
_PATTERNS = ", ".join(f"('{t}', '{p}')" for t, p in HEADING_PATTERNS)


@query(_LABELS + f"\nSELECT page_id, page_type, heading_pattern FROM (SELECT page_id, page_type, trim(regexp_replace(lower({_TEXT}), '[^a-z0-9]+', ' ', 'g')) AS t FROM lb) JOIN (VALUES {_PATTERNS}) h(page_type, heading_pattern) USING (page_type) WHERE regexp_matches(t, heading_pattern)")
def heading_hits(spark: SparkSession, d: str) -> DataFrame:
    texts = F.array(*map(F.lit, ("Titoli azionari", "OBBLIGAZIONI: valori di stato", "Listino ufficiale, borsa di Milano", "dividendi", "Comunicati e notizie", "ordine di chiamata")))
    return P.heading_hits(spark, labels(spark, d).withColumn("text", F.get(texts, (F.col("page_id") % 6).cast("int"))))


@query("SELECT page_id, CASE WHEN c < 0.30 THEN 'low_content_or_blank' WHEN k < 0.005 AND l < 0.002 THEN 'possible_blank_page' WHEN k < 0.08 THEN 'low_text_density_review' WHEN k > 0.38 THEN 'possible_occlusion_or_shadow' ELSE '' END AS flag FROM (SELECT page_id, (page_id % 100) / 100 AS c, (page_id % 50) / 100 AS k, (page_id % 7) / 1000 AS l FROM v_pages)")
def manifest_flag(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("page_id")
    return pages(spark, d).select("page_id", P.quality_flag((p % 100) / 100, (p % 50) / 100, (p % 7) / 1000).alias("flag"))


@query("SELECT page_id, date, picture::VARCHAR AS picture, side FROM v_pages")
def scan_names(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.regexp_replace("date", "-0", "-M"), F.lit("_"), F.col("picture").cast("string"), F.lit("_"), F.col("side"), F.lit("_table.jpg"))
    named = pages(spark, d).select("page_id", scan_name(F.regexp_replace(name, "-M", "-0")).alias("s"))
    return named.select("page_id", "s.date", "s.picture", "s.side")


@query("SELECT page_id, greatest(0, least(1000, round_even(length(html) * 0.37, 0)::INTEGER)) AS x FROM v_pages")
def scaled_boxes(spark: SparkSession, d: str) -> DataFrame:
    return pages(spark, d).select("page_id", P.scaled_box(F.length("html"), 0.37, 1000).alias("x"))


@query("""SELECT doc_id, CASE WHEN sec AND n <= 2 THEN 'section_heading' WHEN n = 0 AND w <= 8 THEN 'heading_or_label' WHEN n > 0 AND regexp_matches(text, '\\pL') THEN 'candidate_record' ELSE 'other_text' END AS record_type FROM (SELECT doc_id, text, len(regexp_extract_all(text, '[0-9][0-9.,]*')) AS n, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS w,
  regexp_matches(lower(text), 'finanzi|assic|trasport|tessil|miner|chimic|diversi|garanzie statali|reddito fisso|partecipazione|titoli di stati esteri|obbligazioni|fondiari|equiparati|comunali|provinciali|elettrici') AS sec FROM documents)""")
def classify_rows(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", table_row_type(F.col("text"), F.lit("")).alias("record_type"))



_SIZE = "page_id, url, 1000 + page_id % 700 AS w, 1400 + page_id % 900 AS h, length(html) AS n"


def _sized(spark: SparkSession, d: str) -> DataFrame:
    """Pages with a size, and a table zone that stands for a detected one: none for some, too far right or too short for others."""
    p, n = F.col("page_id"), F.length("html")
    w, h = (1000 + p % 700).cast("int"), (1400 + p % 900).cast("int")
    table = F.when(p % 11 != 0, F.struct((20 + n % 200).cast("int").alias("x0"), (30 + n % 120).cast("int").alias("y0"), (w - n % 90).cast("int").alias("x1"), (h - 50 - n % 700).cast("int").alias("y1")))
    return pages(spark, d).select("page_id", w.alias("width"), h.alias("height"), table.alias("table"))


@query(f""", sz AS (SELECT {_SIZE} FROM v_pages), tb AS (SELECT page_id, w, h, page_id % 11 <> 0 AS found, 20 + n % 200 AS x0, 30 + n % 120 AS y0, w - n % 90 AS x1, h - 50 - n % 700 AS y1 FROM sz),
rp AS (SELECT page_id, w, h, found, y0, x1, CASE WHEN x0 > w * 0.1 OR x1 - x0 < w * 0.78 THEN least(x0, floor(w * 0.035)) ELSE x0 END AS x0, CASE WHEN y1 < h * 0.72 THEN floor(h * 0.855) ELSE y1 END AS y1 FROM tb),
zn AS (SELECT page_id, 'azioni_table' AS zone_type, x0, y0, x1, y1 FROM rp WHERE found UNION ALL SELECT page_id, 'azioni_header', x0, 0, x1, y0 FROM rp WHERE found AND y0 > h * 0.04 UNION ALL SELECT page_id, 'azioni_footer', x0, y1, x1, h FROM rp WHERE found AND y1 < h * 0.94
 UNION ALL SELECT page_id, 'azioni_table', floor(w * 0.035), floor(h * 0.085), floor(w * 0.965), floor(h * 0.855) FROM rp WHERE NOT found UNION ALL SELECT page_id, 'azioni_header', floor(w * 0.035), floor(h * 0.025), floor(w * 0.965), floor(h * 0.085) FROM rp WHERE NOT found UNION ALL SELECT page_id, 'azioni_footer', floor(w * 0.035), floor(h * 0.855), floor(w * 0.965), floor(h * 0.965) FROM rp WHERE NOT found)
SELECT page_id, zone_type, x0::INTEGER AS x0, y0::INTEGER AS y0, x1::INTEGER AS x1, y1::INTEGER AS y1 FROM zn""")
def equity_zones(spark: SparkSession, d: str) -> DataFrame:
    """Table, header and footer of each page, repaired or from the fallback."""
    z = _sized(spark, d).select("page_id", F.inline(L.zones(F.col("table"), F.col("width"), F.col("height"))))
    return z.select("page_id", "zone_type", "x0", "y0", "x1", "y1")


_VAR = ", ".join(f"('{n}', {a}, {b}, {c}, {e})" for n, a, b, c, e, _ in L.VARIANTS)


@query(f""", sz AS (SELECT {_SIZE} FROM v_pages) SELECT page_id, variant, floor(w * a)::INTEGER AS x0, floor(h * b)::INTEGER AS y0, floor(w * c)::INTEGER AS x1, floor(h * d)::INTEGER AS y1, n % w AS left_, n % h AS top FROM sz, (VALUES {_VAR}) v(variant, a, b, c, d)""")
def variant_boxes(spark: SparkSession, d: str) -> DataFrame:
    """The crops that are read of each page, and a word's place on the page, as it comes back from each crop's coordinates."""
    n = F.length("html")
    sized = pages(spark, d).select("page_id", (1000 + F.col("page_id") % 700).alias("width"), (1400 + F.col("page_id") % 900).alias("height"), n.alias("n"))
    words = L.variants(sized).withColumns({"left_": F.col("n") % F.col("width"), "right_": F.col("n") % F.col("width") + 20, "top": F.col("n") % F.col("height"), "bottom": F.col("n") % F.col("height") + 20})
    back = L.to_page(L.to_crop(words, 3.0), 3.0)
    return back.select("page_id", "variant", "x0", "y0", "x1", "y1", F.col("left_").cast("long").alias("left_"), F.col("top").cast("long").alias("top"))


@query(_LABELS + """
SELECT 'reports/' || page_type || '.md' AS name, '# ' || page_type || chr(10) || chr(10) || '| page_id | date | picture | side | confidence |' || chr(10) || '|---|---|---|---|---|' || chr(10) || string_agg('| ' || page_id || ' | ' || date || ' | ' || picture || ' | ' || side || ' | ' || confidence || ' |', chr(10) ORDER BY page_id) || chr(10) AS content FROM lb GROUP BY page_type""")
def type_reports(spark: SparkSession, d: str) -> DataFrame:
    """A document for each page type: its pages in order."""
    found = reports.page_documents(labels(spark, d), "page_type", "page_id", ["page_id", "date", "picture", "side", "confidence"])
    return found.select("name", F.col("content").cast("string").alias("content"))


@query(_LABELS + """,
t AS (SELECT string_agg('- `' || page_type || '`: ' || n, chr(10) ORDER BY page_type) AS t FROM (SELECT page_type, count(*) AS n FROM lb GROUP BY page_type)),
f AS (SELECT string_agg('- `' || confidence || '`: ' || n, chr(10) ORDER BY confidence) AS f FROM (SELECT confidence, count(*) AS n FROM lb WHERE confidence <> 'high' GROUP BY confidence))
SELECT '# Run' || chr(10) || chr(10) || '## Pages by type' || chr(10) || chr(10) || coalesce(t, '- none') || chr(10) || chr(10) || '## Flags' || chr(10) || chr(10) || coalesce(f, '- none') || chr(10) AS content FROM t, f""")
def run_report(spark: SparkSession, d: str) -> DataFrame:
    """What a run has labelled; labels that aren't certain count as flags."""
    found = labels(spark, d)
    return reports.run_summary(found, found.where("confidence <> 'high'").select(F.col("confidence").alias("flag")), "Run")


@query(_LABELS + "\nSELECT page_id, date, side FROM lb WHERE page_type = 'regular_azioni' ORDER BY date, page_id LIMIT 500")
def labelled_targets(spark: SparkSession, d: str) -> DataFrame:
    """The pages of one type that the next stage takes, the first 500 in order."""
    return manifest_rows(labels(spark, d), "page_type", "regular_azioni", ["date", "page_id"], 500).select("page_id", "date", "side")


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'm/' || page_id || '.jpg' WHEN page_id % 5 = 0 THEN 'k/' || page_id || '.jpg' END AS crop_path, CASE WHEN page_id % 3 = 0 THEN 'manifest' WHEN page_id % 5 = 0 THEN 'kept' ELSE 'made_from_scan' END AS crop_source FROM v_pages""")
def crop_paths(spark: SparkSession, d: str) -> DataFrame:
    """Where each page's crop is: in the manifest's folder, in the kept one, or to be made from its scan."""
    p = pages(spark, d).select("page_id", F.concat(F.col("page_id").cast("string"), F.lit(".jpg")).alias("name"))
    files = lambda folder, every: p.where(F.col("page_id") % every == 0).select("name", F.concat(F.lit(f"{folder}/"), "name").alias("path"))
    wanted = p.select("page_id", F.col("name").alias("manifest_name"), F.col("name").alias("kept_name"))
    return resolved(wanted, [("manifest", files("m", 3)), ("kept", files("k", 5))]).select("page_id", "crop_path", "crop_source")
