"""Deterministic page tables over the driver's tables, in Spark and in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Parts that the pages of one split of a file are dealt to, so that a part's words, of many times its size, fit a task.
SHARES = 8


def words(spark: SparkSession, sf_dir: str, together: bool = False) -> DataFrame:
    """A word for each non-empty piece of a document's lines, with a place on the page and a confidence.

    together: documents are shuffled by page before they are taken apart, so that grouping the words, whose rows are many
    times as long as their texts, by page or by page and line shuffles none of them.
    """
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("page"), "text")
    if together:
        docs = docs.repartition(SHARES * docs.rdd.getNumPartitions(), "page")
    lines = docs.select("page", F.posexplode(F.split("text", "\n")).alias("l", "line"))
    # each piece with the length of what stands before it on its line, so that places need no shuffle
    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("at"))
    places = F.aggregate("_p", start, lambda a, x: F.struct((a["n"] + F.length(x) + 1).alias("n"), F.concat(a["at"], F.array(a["n"])).alias("at")), lambda a: a["at"])
    pieces = lines.select("page", (F.col("l") + 1).alias("line_num"), F.split("line", " ").alias("_p"))
    pieces = pieces.select("page", "line_num", F.posexplode(F.arrays_zip(F.col("_p").alias("text"), places.alias("at"))).alias("w", "x"))
    at = pieces.select("page", "line_num", "w", "x.text", (10 * F.col("x.at")).cast("int").alias("left_")).where("text != ''")
    word = F.col("w") + 1
    top = 40 * F.col("line_num") + (7 * word) % 11
    return at.select(
        "page",
        "line_num",
        word.alias("word_num"),
        ((F.col("line_num") + word) % 4 + 1).alias("block_num"),
        F.element_at(F.array(F.lit("6"), F.lit("11"), F.lit("12")), (F.col("page") % 3 + 1).cast("int")).alias("psm"),
        "text",
        "left_",
        (F.col("left_") + 10 * F.length("text")).alias("right_"),
        top.cast("int").alias("top"),
        (top + 24).cast("int").alias("bottom"),
        ((31 * F.col("page") + 17 * F.col("line_num") + 13 * word) % 101).cast("int").alias("conf"),
    )


WORDS = """
v_line AS (SELECT doc_id AS page, generate_subscripts(ls, 1)::INTEGER AS line_num, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
v_piece AS (SELECT page, line_num, generate_subscripts(ps, 1)::INTEGER AS word_num, unnest(ps) AS text FROM (SELECT page, line_num, string_split(line, ' ') AS ps FROM v_line)),
v_at AS (SELECT *, (10 * coalesce(sum(length(text) + 1) OVER (PARTITION BY page, line_num ORDER BY word_num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::INTEGER AS left_ FROM v_piece),
v_words AS (SELECT page, line_num, word_num, (line_num + word_num) % 4 + 1 AS block_num, ['6', '11', '12'][page % 3 + 1] AS psm, text, left_, (left_ + 10 * length(text))::INTEGER AS right_,
  (40 * line_num + (7 * word_num) % 11)::INTEGER AS top, (40 * line_num + (7 * word_num) % 11 + 24)::INTEGER AS bottom, ((31 * page + 17 * line_num + 13 * word_num) % 101)::INTEGER AS conf FROM v_at WHERE text <> '')"""


def _dotted(n) -> F.Column:
    return F.replace(F.format_number(n, 0), F.lit(","), F.lit("."))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of raw equity cells in Italian notation, with blanks, dashes and cells of two values."""
    items = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    k = F.col("l_linenumber") + F.col("l_partkey") + 3 * F.col("l_suppkey")
    rows = items.withColumns({"row_index": F.row_number().over(order).cast("long"), "k": k, "cents": F.floor(100 * F.col("l_extendedprice") + 0.5).cast("long"), "q": F.col("l_quantity").cast("long")})
    every = lambda m: F.col("k") % m == 0
    cents, q = F.col("cents"), F.col("q")
    return rows.select(
        F.col("l_orderkey").alias("sample_id"),
        "row_index",
        F.col("l_returnflag").alias("section"),
        F.when(every(4), "security_continuation_row").otherwise("security_main_row").alias("row_role"),
        F.when(every(5), "").otherwise(F.col("p_name")).alias("issuer_raw"),
        F.when(every(7), "").otherwise(_dotted(cents)).alias("capital_raw"),
        F.when(every(11), "").when(every(17), F.concat_ws(" ", _dotted(1000 * q), _dotted(cents))).otherwise(_dotted(1000 * q)).alias("shares_raw"),
        F.when(every(3), "").otherwise((25 * (F.col("k") % 8 + 1)).cast("string")).alias("nominal_raw"),
        F.when(every(13), "").when(every(6), "—").otherwise(F.concat(_dotted(F.expr("cents div 100")), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))).alias("close_raw"),
        F.when(every(9), "").otherwise(q.cast("string")).alias("quantity_raw"),
        F.concat_ws("-", F.dayofmonth("l_shipdate").cast("string"), F.month("l_shipdate").cast("string"), F.date_format("l_shipdate", "yy")).alias("cedola_raw"),
        (40 + F.col("k") % 60).cast("long").alias("conf"),
    )


CELLS = """
v_items AS (SELECT *, l_linenumber + l_partkey + 3 * l_suppkey AS k, floor(100 * l_extendedprice + 0.5)::BIGINT AS cents, l_quantity::BIGINT AS q,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS row_index FROM lineitem JOIN part ON l_partkey = p_partkey),
v_cells AS (SELECT l_orderkey AS sample_id, row_index, l_returnflag AS section, CASE WHEN k % 4 = 0 THEN 'security_continuation_row' ELSE 'security_main_row' END AS row_role,
  CASE WHEN k % 5 = 0 THEN '' ELSE p_name END AS issuer_raw, CASE WHEN k % 7 = 0 THEN '' ELSE replace(format('{:,}', cents), ',', '.') END AS capital_raw,
  CASE WHEN k % 11 = 0 THEN '' WHEN k % 17 = 0 THEN replace(format('{:,}', 1000 * q), ',', '.') || ' ' || replace(format('{:,}', cents), ',', '.') ELSE replace(format('{:,}', 1000 * q), ',', '.') END AS shares_raw,
  CASE WHEN k % 3 = 0 THEN '' ELSE (25 * (k % 8 + 1))::VARCHAR END AS nominal_raw,
  CASE WHEN k % 13 = 0 THEN '' WHEN k % 6 = 0 THEN '—' ELSE replace(format('{:,}', cents // 100), ',', '.') || ',' || lpad((cents % 100)::VARCHAR, 2, '0') END AS close_raw,
  CASE WHEN k % 9 = 0 THEN '' ELSE q::VARCHAR END AS quantity_raw,
  day(l_shipdate)::VARCHAR || '-' || month(l_shipdate)::VARCHAR || '-' || strftime(l_shipdate, '%y') AS cedola_raw, (40 + k % 60)::BIGINT AS conf FROM v_items)"""


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text in five shapes, some of days that no month has."""
    o = read(spark, sf_dir, "orders")
    d, m, y = F.dayofmonth("o_orderdate").cast("string"), F.month("o_orderdate").cast("string"), F.date_format("o_orderdate", "yyyy")
    k = F.col("o_orderkey") % 5
    raw = F.when(k == 0, F.concat_ws("-", d, m, F.substring(y, 3, 2))).when(k == 1, F.concat(d, F.lit(" / "), m, F.lit(" / "), y)).when(k == 2, F.concat_ws("-", F.lit("31"), m, y)).when(k == 3, F.concat_ws("/", d, F.lit("13"), y)).otherwise(F.concat(F.lit("dal "), d, F.lit(" "), F.element_at(F.array(*map(F.lit, ("genn", "feb", "marzo", "apr", "mag", "giugno", "luglio", "agosto", "sett", "ottobre", "nov", "dic"))), F.month("o_orderdate"))))
    return o.select("o_orderkey", raw.alias("raw"))


DATES = """
v_dates AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN d || '-' || m || '-' || right(y, 2) WHEN 1 THEN d || ' / ' || m || ' / ' || y WHEN 2 THEN '31-' || m || '-' || y WHEN 3 THEN d || '/13/' || y
  ELSE 'dal ' || d || ' ' || ['genn', 'feb', 'marzo', 'apr', 'mag', 'giugno', 'luglio', 'agosto', 'sett', 'ottobre', 'nov', 'dic'][m::INTEGER] END AS raw
  FROM (SELECT o_orderkey, day(o_orderdate)::VARCHAR AS d, month(o_orderdate)::VARCHAR AS m, year(o_orderdate)::VARCHAR AS y FROM orders))"""


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date, picture and side for each web page, by its number."""
    p = F.col("page_id")
    return read(spark, sf_dir, "pages").select(
        "page_id",
        F.concat(F.lit("1950-0"), (p % 6 + 1).cast("string"), F.lit("-"), F.lpad(F.element_at(F.array(*map(F.lit, (5, 17, 14, 21, 28, 19, 30))), (p % 7 + 1).cast("int")).cast("string"), 2, "0")).alias("date"),
        (p % 6 + 1).cast("int").alias("picture"),
        F.when(p % 2 == 0, "left").otherwise("right").alias("side"),
        "url",
        "html",
    )


PAGES = """
v_pages AS (SELECT page_id, '1950-0' || (page_id % 6 + 1)::VARCHAR || '-' || lpad(([5, 17, 14, 21, 28, 19, 30][page_id % 7 + 1])::VARCHAR, 2, '0') AS date, (page_id % 6 + 1)::INTEGER AS picture,
  CASE WHEN page_id % 2 = 0 THEN 'left' ELSE 'right' END AS side, url, html FROM pages)"""


#: Where the strips of the second readings begin on a page of a width and height.
STRIP_X, STRIP_Y = 0.78, 0.075


def page_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of price-list pages in several readings, from the orders' lines: a page for 8 order numbers, a row for a line.

    Each row's cells stand in their bands; the main reading loses, misreads and glues some of them, and has tall marks of
    rules; the other readings are better but not whole, and stand in the coordinates of their strips. Some pages have
    detected rules beside the bands' edges, and some rows are section headings with misread letters.
    """
    from folioframe.dimensions import EQUITY_BANDS, SECTION_ALIASES

    band = {n: a for n, a, _ in EQUITY_BANDS}
    # rows are shuffled by page before they become words, of which each gives dozens
    c = cells(spark, sf_dir).withColumn("page", F.floor(F.col("sample_id") / 8))
    c = c.repartition(SHARES * read(spark, sf_dir, "lineitem").rdd.getNumPartitions(), "page")
    k = F.col("row_index") + 5 * F.col("sample_id")
    every = lambda m, r=0: k % m == r
    y = (280 + 28 * (12 * (F.col("sample_id") % 8) + F.col("row_index"))).cast("int")
    alias = F.element_at(F.array(*[F.initcap(F.lit(a)) for a, _ in SECTION_ALIASES]), (k % len(SECTION_ALIASES) + 1).cast("int"))
    glued = F.when(every(19), F.concat_ws("/", "shares_raw", "nominal_raw")).otherwise(F.col("shares_raw"))
    cell = lambda n, text, on=F.lit(True): F.struct(F.lit(n).alias("name"), F.lit(band[n] + 8).alias("x"), F.when(on, text).otherwise("").alias("t"))
    heading = every(9, 4)
    price = F.col("close_raw")
    on = ~heading
    all_cells = F.array(
        cell("capital_subscribed_raw", F.col("capital_raw"), on), cell("shares_outstanding_raw", glued, on), cell("nominal_value_raw", F.when(every(19), "").otherwise(F.col("nominal_raw")), on), cell("cedola_date_raw", F.col("cedola_raw"), on & every(3)),
        cell("issuer_name_raw", F.when(heading, alias).otherwise(F.col("issuer_raw"))), cell("price_min_raw", price, on & every(4)), cell("price_max_raw", price, on & every(5)), cell("price_close_raw", price, on), cell("quantity_traded_raw", F.col("quantity_raw"), on),
    )
    rows = c.select("page", k.alias("k"), y.alias("y"), "conf", (12 * (F.col("sample_id") % 8) + F.col("row_index")).cast("int").alias("line_num"), F.inline(all_cells))
    rows = rows.where("t != ''").select("*", F.posexplode(F.split("t", " ")).alias("i", "text"))
    n = rows.withColumns({"h": F.pmod(F.xxhash64("page", "line_num", "name", "i"), F.lit(100)).cast("int"), "word_num": (F.col("x") / 10 + F.col("i")).cast("int"), "left_": (F.col("x") + 90 * F.col("i") % 540).cast("int")})
    h, text = F.col("h"), F.col("text")
    digits = text.rlike("[0-9]")
    numeric, right = F.col("x") < 1325, F.col("x") >= 1945
    main = F.when(h % 10 == 3, F.translate(text, "0123456789", "oizeasgtbq")).otherwise(text)
    word = lambda r, on, t, dx, dy, conf: F.when(on, F.struct(F.lit(r).alias("reading"), t.alias("text"), (F.col("left_") + dx).cast("int").alias("left_"), (F.col("y") + dy).cast("int").alias("top"), F.lit(24).alias("high"), conf.cast("int").alias("conf")))
    width, height = 2600 + (F.col("page") % 3).cast("int") * 20, F.lit(3000)
    x0, y0 = F.floor(width * STRIP_X).cast("int"), F.floor(height * STRIP_Y).cast("int")
    jitter = (h % 5 - 2) + F.col("line_num") % 3
    readings = F.array_compact(F.array(
        word("main", h % 7 != 1, main, 0, jitter, F.col("conf") - F.when(h % 29 == 5, 60).otherwise(0)),
        word("full", h % 11 != 2, text, 2, jitter + 1, F.lit(70)),
        word("numeric", numeric & (h % 13 != 3), text, 1, jitter - y0, F.lit(75)),
        word("price", right & (h % 13 != 4), text, 1 - x0, jitter - y0, F.lit(75)),
        *[word(f, (F.col("name") == f) & digits & (h % 17 != 5), F.when(h % 23 == 6, F.concat(text, F.lit(" x"))).otherwise(text), 1, jitter, F.lit(80)) for f in ("capital_subscribed_raw", "shares_outstanding_raw", "nominal_value_raw")],
        F.when(h == 50, F.struct(F.lit("main").alias("reading"), F.lit("l").alias("text"), (F.col("left_") + 5).cast("int").alias("left_"), F.col("y").alias("top"), F.lit(90).alias("high"), F.lit(40).alias("conf"))),
        F.when((h % 20 == 7) & (F.col("page") % 2 == 0), F.struct(F.lit("rule").alias("reading"), F.lit("").alias("text"), (F.col("x") - 8 + h % 9).cast("int").alias("left_"), F.lit(0).alias("top"), F.lit(3000).alias("high"), F.lit(0).alias("conf"))),
    ))
    return n.select("page", "line_num", "word_num", width.alias("width"), F.inline(readings)).select("page", "reading", "line_num", "word_num", "text", "left_", (F.col("left_") + F.greatest(F.lit(9), 9 * F.length("text"))).cast("int").alias("right_"), "top", (F.col("top") + F.col("high")).cast("int").alias("bottom"), "conf", "width", height.alias("height"))
