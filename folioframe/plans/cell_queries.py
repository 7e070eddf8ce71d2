"""Queries on raw and cleaned cells, each with its DuckDB form where SQL can state it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.dimensions import FIELDS, GENERIC_FLAGS, ISSUERS, NOMINALS, SECTION_ALIASES
from folioframe.functions import dates as D
from folioframe.functions import numbers as N
from folioframe.functions import text as T
from folioframe.operators import review as R
from folioframe.plans import bond, equity
from folioframe.sources.views import CELLS, DATES, cells, dates, read

QUERIES, ORACLES = {}, {}


def query(sql: str | None, view: str = CELLS):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = f"WITH {view}{sql}" if sql.startswith(",") else f"WITH {view}\n{sql}"
        return f

    return add


_K = "sample_id, row_index"
_GRAMMAR = r"\d{1,3}(?:[.,]\d{3})+(?:,\d+)?|\d{1,3} \d{3}(?:[.,]\d{3})+(?:,\d+)?|\d{4,}(?:\.\d{3})+(?:,\d+)?|\d{1,3}(?: \d{3})+(?:,\d+)?|\d+(?:,\d+)?"
_TOKENS = lambda c: f"regexp_extract_all({c}, '(?:^|[^0-9])({_GRAMMAR})', 1)"


@query(f"SELECT {_K}, array_to_string({_TOKENS('shares_raw')}, '|') AS shares_tokens, array_to_string({_TOKENS('close_raw')}, '|') AS close_tokens FROM v_cells")
def number_tokens(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).select("sample_id", "row_index", F.array_join(N.number_tokens(F.col("shares_raw")), "|").alias("shares_tokens"), F.array_join(N.number_tokens(F.col("close_raw")), "|").alias("close_tokens"))


@query(f"SELECT {_K}, array_to_string(list_transform(regexp_extract_all(shares_raw || ' ' || close_raw, '[0-9][0-9.,]*'), lambda t: trim(t, '.,')), '|') AS tokens FROM v_cells")
def plain_number_tokens(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).select("sample_id", "row_index", F.array_join(N.plain_tokens(F.concat_ws(" ", "shares_raw", "close_raw")), "|").alias("tokens"))


@query(f"""SELECT {_K}, regexp_replace(capital_raw, '\\D', '', 'g') AS capital, CASE WHEN contains(close_raw, ',') THEN regexp_replace(split_part(close_raw, ',', 1), '\\D', '', 'g') || '.' || split_part(close_raw, ',', 2) ELSE '' END AS close, regexp_replace(close_raw, '\\D', '', 'g') AS close_whole FROM v_cells""")
def parse_amounts(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).select("sample_id", "row_index", N.parse_number(F.col("capital_raw")).alias("capital"), N.parse_number(F.col("close_raw"), True).alias("close"), N.parse_bond_number(F.col("close_raw")).alias("close_whole"))


@query(f"""SELECT {_K}, coalesce((SELECT v FROM (SELECT regexp_replace(unnest(ts), '\\D', '', 'g') AS v, generate_subscripts(ts, 1) AS i) ORDER BY length(v) DESC, v::HUGEINT DESC, i LIMIT 1), '') AS shares, coalesce(regexp_replace(ts[1], '\\D', '', 'g'), '') AS first_shares, coalesce(regexp_replace(ts[-1], '\\D', '', 'g'), '') AS last_shares
FROM (SELECT {_K}, {_TOKENS('shares_raw')} AS ts FROM v_cells)""")
def first_numeric(spark: SparkSession, d: str) -> DataFrame:
    values = N.parsed(F.col("shares_raw"))
    return cells(spark, d).select("sample_id", "row_index", N.first_numeric(F.col("shares_raw"), prefer_large=True).alias("shares"), N.first_of(values).alias("first_shares"), N.last_of(values).alias("last_shares"))


# only three digits join the number before them; a number up to 30 before a nominal is a row's number
@query(f"""SELECT {_K}, CASE WHEN length(nominal_raw) <> 3 THEN k::VARCHAR WHEN k <= 30 THEN nominal_raw ELSE k::VARCHAR || nominal_raw END AS value FROM (SELECT {_K}, nominal_raw, sample_id % 60 + 1 AS k FROM v_cells)""")
def identity_integers(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    text = F.concat_ws(" ", (F.col("sample_id") % 60 + 1).cast("string"), "nominal_raw")
    return c.select("sample_id", "row_index", N.first_of(N.identity_values(text)).alias("value"))


@query(f"""SELECT {_K}, c >= 10000 AS large, coalesce(n IN ({", ".join(map(str, NOMINALS))}) OR (n BETWEEN 25 AND 20000 AND n % 25 = 0), FALSE) AS nominal, coalesce(n >= 1000, FALSE) AS identity_amount, coalesce(q BETWEEN 1 AND 30, FALSE) AS suspicious, coalesce(q BETWEEN 1 AND 500000, FALSE) AS quantity, coalesce(p > 0 AND p <= 300000, FALSE) AS price
FROM (SELECT {_K}, coalesce(TRY_CAST(regexp_replace(capital_raw, '\\D', '', 'g') AS BIGINT), 0) AS c, TRY_CAST(nominal_raw AS BIGINT) AS n, TRY_CAST(quantity_raw AS BIGINT) AS q, TRY_CAST(replace(replace(close_raw, '.', ''), ',', '.') AS DECIMAL(18, 2)) AS p FROM v_cells)""")
def validators(spark: SparkSession, d: str) -> DataFrame:
    n, q = F.col("nominal_raw"), F.col("quantity_raw")
    return cells(spark, d).select("sample_id", "row_index", N.is_large(N.parse_number(F.col("capital_raw"))).alias("large"), N.is_nominal(n).alias("nominal"), N.is_identity_amount(n).alias("identity_amount"), N.is_suspicious(q).alias("suspicious"), N.is_quantity(q).alias("quantity"), N.is_price(N.parse_number(F.col("close_raw"), True)).alias("price"))


@query(f"""SELECT {_K}, CASE WHEN length(v) >= 9 AND v[3] <> '0' THEN v[3:] ELSE v END AS value FROM (SELECT {_K}, regexp_replace(capital_raw, '\\D', '', 'g') || '00' AS v FROM v_cells)""")
def row_markers(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).select("sample_id", "row_index", N.without_row_marker(F.concat(N.parse_number(F.col("capital_raw")), F.lit("00"))).alias("value"))


_NOM = lambda x: f"({x} IN ({', '.join(map(str, NOMINALS))}) OR ({x} BETWEEN 25 AND 20000 AND {x} % 25 = 0))"


@query("SELECT " + _K + ", CASE " + " ".join(f"WHEN length(v) >= 7 AND TRY_CAST(left(v, length(v) - {k}) AS BIGINT) >= 1000 AND {_NOM(f'TRY_CAST(right(v, {k}) AS BIGINT)')} THEN left(v, length(v) - {k}) || '/' || right(v, {k})" for k in (4, 3, 2)) + " ELSE v || '/' END AS parts FROM (SELECT " + _K + ", regexp_replace(shares_raw, '\\D', '', 'g') || nominal_raw AS v FROM v_cells)")
def glued_split(spark: SparkSession, d: str) -> DataFrame:
    g = N.glued(F.concat(F.regexp_replace("shares_raw", r"\D", ""), F.col("nominal_raw")))
    return cells(spark, d).select("sample_id", "row_index", F.concat_ws("/", g["value"], g["nominal"]).alias("parts"))


@query(None)
def small_extras(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat_ws(" ; ", "nominal_raw", "quantity_raw")
    return cells(spark, d).select("sample_id", "row_index", N.only_small_extras(N.number_tokens(text), F.col("nominal_raw")).alias("leakage"))


ORACLES["small_extras"] = f"WITH {CELLS}\nSELECT {_K}, nominal_raw <> '' AND quantity_raw <> '' AND coalesce(TRY_CAST(quantity_raw AS BIGINT) <= 31, FALSE) AS leakage FROM v_cells"


@query(None)
def identity_fallbacks(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d).select("sample_id", "row_index", N.number_tokens(F.concat_ws(" ; ", "capital_raw", "shares_raw", "nominal_raw")).alias("_t"))
    # a column for each step, so that each is computed once
    c = c.withColumns({"_v": N.over_thirty(N.values_of(F.col("_t"))), "_k": N.without_markers(N.values_of_pairs(N.identity_pairs(F.col("_t"))))})
    c = c.withColumns({"_l": F.filter("_v", N.is_large), "_p": N.places(F.col("_v"), N.is_identity_amount), "_kl": N.places(F.col("_k"), N.is_large)})
    c = c.withColumn("_s", N.suffix_of(F.col("_v"), F.col("_p"))).withColumn("_n", N.nominal_values(F.array_join("_s", " ")))
    c = c.withColumns({"a": N.sequence_of(F.col("_v"), F.col("_l")), "b": N.row_pattern_of(F.col("_v"), F.col("_p"), F.col("_s"), F.col("_n")), "c": N.fallback_of(F.col("_k"), F.col("_kl"))})
    return c.select("sample_id", "row_index", *[F.col(f"{x}.{f}").alias(f"{n}_{f}") for x, n in (("a", "sequence"), ("b", "row"), ("c", "right")) for f in ("capital", "shares", "nominal")])


@query(f"""SELECT {_K}, CASE WHEN p <> '' AND q <> '' THEN p ELSE coalesce(nullif(q, ''), p) END AS price, CASE WHEN p <> '' AND q <> '' THEN q ELSE '' END AS quantity FROM (SELECT {_K}, CASE WHEN contains(close_raw, ',') AND replace(replace(close_raw, '.', ''), ',', '.')::DECIMAL(18, 2) <= 300000 THEN replace(replace(close_raw, '.', ''), ',', '.') ELSE '' END AS p, quantity_raw AS q FROM v_cells)""")
def price_quantity_fallback(spark: SparkSession, d: str) -> DataFrame:
    f = N.price_quantity(F.col("close_raw"), F.col("quantity_raw"))
    return cells(spark, d).select("sample_id", "row_index", f["price"].alias("price"), f["quantity"].alias("quantity"))


@query(None)
def best_identity_value(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat_ws(" ", "issuer_raw", "shares_raw")
    return cells(spark, d).select("sample_id", "row_index", N.best_identity("shares_outstanding_raw", t).alias("shares"), N.best_identity("nominal_value_raw", F.col("nominal_raw")).alias("nominal"))


@query(f"SELECT {_K}, coalesce(TRY_CAST(nullif(nominal_raw, '') AS DOUBLE), -1)::BIGINT AS value FROM v_cells")
def robust_numbers(spark: SparkSession, d: str) -> DataFrame:
    return cells(spark, d).select("sample_id", "row_index", N.as_double(F.col("nominal_raw")).cast("long").alias("value"))


@query("""SELECT o_orderkey, CASE WHEN m BETWEEN 1 AND 12 AND dd BETWEEN 1 AND 31 THEN printf('%04d-%02d-%02d', CASE WHEN y < 100 THEN y + 1900 ELSE y END, m, dd) ELSE '' END AS parsed FROM (SELECT o_orderkey, TRY_CAST(nullif(g[1], '') AS INTEGER) AS dd, TRY_CAST(nullif(g[2], '') AS INTEGER) AS m, TRY_CAST(nullif(g[3], '') AS INTEGER) AS y FROM
  (SELECT o_orderkey, [regexp_extract(raw, p, 1), regexp_extract(raw, p, 2), regexp_extract(raw, p, 3)] AS g FROM (SELECT *, '([0-9]{1,2})\\s*[-/]\\s*([0-9]{1,2})\\s*[-/]\\s*([0-9]{2,4})' AS p FROM v_dates)))""", DATES)
def parse_date(spark: SparkSession, d: str) -> DataFrame:
    return dates(spark, d).select("o_orderkey", D.parse_date(F.col("raw")).alias("parsed"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN printf('--%02d-%02d', list_position(['ge', 'fe', 'ma', 'ap', 'mg', 'gi', 'lu', 'ag', 'se', 'ot', 'no', 'di'], CASE WHEN contains(raw, 'mag') THEN 'mg' ELSE left(split_part(raw, ' ', 3), 2) END), split_part(raw, ' ', 2)::INTEGER) ELSE '' END AS month_day FROM v_dates""", DATES)
def parse_partial_date(spark: SparkSession, d: str) -> DataFrame:
    return dates(spark, d).select("o_orderkey", D.parse_month_day(F.col("raw")).alias("month_day"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, (CASE WHEN a >= 30 THEN 1900 + a ELSE 2000 + a END)::VARCHAR || '-' || (CASE WHEN b >= 30 THEN 1900 + b ELSE 2000 + b END)::VARCHAR AS span FROM (SELECT *, (o_orderkey % 100)::INTEGER AS a, ((o_orderkey + 7) % 100)::INTEGER AS b FROM orders)""", DATES)
def parse_year(spark: SparkSession, d: str) -> DataFrame:
    two = lambda x: F.lpad((x % 100).cast("string"), 2, "0")
    o = read(spark, d, "orders")
    return o.select("o_orderkey", D.parse_year(F.concat(F.lit("nel "), F.date_format("o_orderdate", "yyyy"))).alias("year"), D.parse_year(F.concat_ws("-", two(F.col("o_orderkey")), two(F.col("o_orderkey") + 7))).alias("span"))


@query(f"SELECT {_K}, section AS filled_from, count(*) OVER (PARTITION BY sample_id, section ORDER BY row_index) AS position FROM v_cells")
def row_numbers(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("sample_id", "section").orderBy("row_index")
    return cells(spark, d).select("sample_id", "row_index", F.col("section").alias("filled_from"), F.row_number().over(w).cast("long").alias("position"))


@query(f"SELECT {_K}, coalesce(last_value(CASE WHEN nominal_raw = '' THEN issuer_raw END IGNORE NULLS) OVER (PARTITION BY sample_id ORDER BY row_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS filled FROM v_cells")
def section_fill(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("sample_id").orderBy("row_index").rowsBetween(Window.unboundedPreceding, 0)
    heading = F.when(F.col("nominal_raw") == "", F.col("issuer_raw"))
    return cells(spark, d).select("sample_id", "row_index", F.coalesce(F.last(heading, ignorenulls=True).over(w), F.lit("")).alias("filled"))


# text

_ISSUER = "CASE WHEN issuer_raw = '' THEN '' ELSE '12 ' || issuer_raw || ' {ee} ,' END"


@query(f"""SELECT {_K}, trim(regexp_replace(translate({_ISSUER}, '{{}}|\\[]', '      '), '\\s+', ' ', 'g')) AS cleaned, trim(regexp_replace(lower({_ISSUER}), '[^a-z0-9]+', ' ', 'g')) AS lookup, trim(trim(regexp_replace(regexp_replace(regexp_replace(translate({_ISSUER}, '{{}}|\\[]', '      '), '^[^A-Za-zÀ-ÿ]+', ''), '\\bee\\b', ' ', 'g'), '\\s+', ' ', 'g')), ' .,-;:') AS issuer FROM v_cells""")
def issuer_clean(spark: SparkSession, d: str) -> DataFrame:
    t = F.when(F.col("issuer_raw") == "", "").otherwise(F.concat(F.lit("12 "), F.col("issuer_raw"), F.lit(" {ee} ,")))
    return cells(spark, d).select("sample_id", "row_index", T.clean_text(t).alias("cleaned"), T.lookup_text(t).alias("lookup"), T.clean_issuer(t).alias("issuer"))


@query("SELECT doc_id, trim(regexp_replace(lower(strip_accents(text)), '[^a-z]+', ' ', 'g')) AS letters FROM documents")
def letters_nfkd(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", T.letters_only(F.col("text")).alias("letters"))


@query("SELECT doc_id, trim(regexp_replace(translate(lower(text), 'àèéìòù’', 'aeeiou'''), '[^a-z0-9]+', ' ', 'g')) AS lookup, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS heading, CASE WHEN regexp_matches(text, '^[=+\\-@]') THEN '''' || text ELSE text END AS safe FROM documents")
def text_normalise(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return read(spark, d, "documents").select("doc_id", T.lookup_text(t).alias("lookup"), T.heading_text(t).alias("heading"), T.spreadsheet_safe(t).alias("safe"))


@query("SELECT doc_id, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS escaped FROM documents")
def html_escaped(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", T.html_escape(F.col("text")).alias("escaped"))


@query(f"SELECT {_K}, CASE WHEN issuer_raw = '' THEN '' ELSE array_to_string(string_split(issuer_raw, ' ')[:8], ' ') END AS issuer FROM v_cells")
def issuer_from_raw(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat_ws(" ", "capital_raw", "cedola_raw", "issuer_raw", "close_raw")
    return cells(spark, d).select("sample_id", "row_index", T.issuer_from_text(t).alias("issuer"))


@query(f"SELECT {_K}, CASE WHEN issuer_raw = '' THEN capital_raw || ' ' || issuer_raw || ' ' || nominal_raw ELSE capital_raw || ' ' END AS prefix, close_raw IN ('', '—') AS blank_cell FROM v_cells")
def text_before(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat_ws(" ", "capital_raw", "issuer_raw", "nominal_raw")
    return cells(spark, d).select("sample_id", "row_index", T.text_before_issuer(t, F.col("issuer_raw")).alias("prefix"), T.is_blank_cell(F.col("close_raw")).alias("blank_cell"))


# references

_REFS = ", ".join("('" + "', '".join(x.replace("'", "''") for x in r) + f"', {i})" for i, r in enumerate(ISSUERS))


@query(f""",
hay AS (SELECT {_K}, trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) AS h FROM (SELECT {_K}, issuer_raw || ' ' || (['siele', 'mira lanza', 'terni', 'adriatica riunione', 'nulla', 'ceramica ginori x richard'])[(sample_id + row_index) % 6 + 1] AS name FROM v_cells)),
ref(key, issuer, capital, shares, nominal, pos) AS (VALUES {_REFS}),
rk AS (SELECT *, list_distinct(list_filter(string_split(key, ' '), lambda w: length(w) > 1)) AS kt FROM ref),
sc AS (SELECT sample_id, row_index, issuer, pos, contains(h, key) AS hit, key, len(list_intersect(kt, list_distinct(list_filter(string_split(h, ' '), lambda w: length(w) > 1)))) / len(kt) AS share FROM hay, rk),
ok AS (SELECT *, share + CASE WHEN hit THEN 1 ELSE 0 END AS score FROM sc WHERE hit OR (share >= 0.75 AND key NOT IN ('motta', 'veneta', 'terni')))
SELECT {_K}, coalesce(arg_max(issuer, score * 1000 - pos), '') AS issuer FROM hay LEFT JOIN ok USING (sample_id, row_index) GROUP BY sample_id, row_index""")
def issuer_reference_match(spark: SparkSession, d: str) -> DataFrame:
    extra = F.get(F.array(*map(F.lit, ("siele", "mira lanza", "terni", "adriatica riunione", "nulla", "ceramica ginori x richard"))), ((F.col("sample_id") + F.col("row_index")) % 6).cast("int"))
    return cells(spark, d).select("sample_id", "row_index", F.coalesce(equity.reference_match(F.col("issuer_raw"), extra)["issuer"], F.lit("")).alias("issuer"))


@query(None)
def fuzzy_section(spark: SparkSession, d: str) -> DataFrame:
    from folioframe.operators.sections import fuzzy_sections

    n = len(SECTION_ALIASES)
    alias = F.get(F.array(*[F.lit(a) for a, _ in SECTION_ALIASES]), ((F.col("sample_id") + F.col("row_index")) % n).cast("int"))
    raw = F.when(F.col("row_index") % 2 == 0, alias).otherwise(F.regexp_replace(alias, "i", "l"))
    return fuzzy_sections(cells(spark, d).select("sample_id", "row_index", raw.alias("text")))


# cleaning

_NAMES = {"issuer_raw": "issuer_name_raw", "capital_raw": "capital_subscribed_raw", "shares_raw": "shares_outstanding_raw", "nominal_raw": "nominal_value_raw", "close_raw": "price_close_raw", "quantity_raw": "quantity_traded_raw", "cedola_raw": "cedola_date_raw", "conf": "mean_conf"}


def raw_rows(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    return c.withColumn("raw_row_text", F.concat_ws(" ", *[x for x in _NAMES if x != "conf"])).withColumnsRenamed(_NAMES).withColumn("source_file", F.when(F.col("sample_id") % 2 == 0, "page_left_").otherwise("page_right_"))


def clean_rows(spark: SparkSession, d: str) -> DataFrame:
    return equity.clean(raw_rows(spark, d), ["sample_id", "row_index"])


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("validation_flags", F.array_join("validation_flags", ";"))


@query(None)
def equity_clean(spark: SparkSession, d: str) -> DataFrame:
    return _flat(clean_rows(spark, d))


@query(None)
def equity_context(spark: SparkSession, d: str) -> DataFrame:
    return _flat(equity.context(clean_rows(spark, d)))


@query(None)
def equity_flag_histogram(spark: SparkSession, d: str) -> DataFrame:
    return R.flag_histogram(equity.context(clean_rows(spark, d)))


@query(None)
def equity_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    return R.column_diagnostics(equity.context(clean_rows(spark, d)))


# the plain clean: what both engines can state in a few lines, for the operators that follow cleaning

_PLAIN = """,
v_plain AS (SELECT sample_id, row_index, section, row_role, issuer_raw AS issuer_name_clean, issuer_raw AS issuer_name_raw, regexp_replace(capital_raw, '\\D', '', 'g') AS capital_subscribed, capital_raw AS capital_subscribed_raw,
  CASE WHEN contains(shares_raw, ' ') THEN '' ELSE regexp_replace(shares_raw, '\\D', '', 'g') END AS shares_outstanding, shares_raw AS shares_outstanding_raw, nominal_raw AS nominal_value, nominal_raw AS nominal_value_raw, CASE WHEN close_raw = '—' THEN '' ELSE close_raw END AS price_close, close_raw AS price_close_raw, quantity_raw AS quantity_traded, quantity_raw AS quantity_traded_raw,
  issuer_raw || ' ' || capital_raw AS raw_row_text, list_filter([CASE WHEN issuer_raw = '' THEN 'missing_issuer' END, CASE WHEN capital_raw = '' THEN 'missing_capital' END, CASE WHEN shares_raw = '' THEN 'missing_shares' END, CASE WHEN nominal_raw = '' THEN 'missing_nominal' END, CASE WHEN close_raw = '—' THEN 'close_likely_printed_blank' END, CASE WHEN close_raw IN ('', '—') THEN 'missing_close_price' END,
  CASE WHEN quantity_raw = '' THEN 'blank_quantity' END, CASE WHEN contains(shares_raw, ' ') THEN 'multi_value_shares_raw' END, CASE WHEN conf < 65 THEN 'low_mean_ocr_confidence' END], lambda x: x IS NOT NULL) AS validation_flags FROM v_cells)"""


def plain_rows(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    digits = lambda n: F.regexp_replace(n, r"\D", "")
    two = F.contains("shares_raw", F.lit(" "))
    flags = [(c("issuer_raw") == "", "missing_issuer"), (c("capital_raw") == "", "missing_capital"), (c("shares_raw") == "", "missing_shares"), (c("nominal_raw") == "", "missing_nominal"), (c("close_raw") == "—", "close_likely_printed_blank"), (c("close_raw").isin("", "—"), "missing_close_price"), (c("quantity_raw") == "", "blank_quantity"), (two, "multi_value_shares_raw"), (c("conf") < 65, "low_mean_ocr_confidence")]
    return cells(spark, d).select(
        "sample_id", "row_index", "section", "row_role", c("issuer_raw").alias("issuer_name_clean"), c("issuer_raw").alias("issuer_name_raw"), digits("capital_raw").alias("capital_subscribed"), c("capital_raw").alias("capital_subscribed_raw"),
        F.when(two, "").otherwise(digits("shares_raw")).alias("shares_outstanding"), c("shares_raw").alias("shares_outstanding_raw"), c("nominal_raw").alias("nominal_value"), c("nominal_raw").alias("nominal_value_raw"), F.when(c("close_raw") == "—", "").otherwise(c("close_raw")).alias("price_close"), c("close_raw").alias("price_close_raw"), c("quantity_raw").alias("quantity_traded"), c("quantity_raw").alias("quantity_traded_raw"),
        F.concat_ws(" ", "issuer_raw", "capital_raw").alias("raw_row_text"), F.array_compact(F.array(*[F.when(x, F.lit(n)) for x, n in flags])).alias("validation_flags"),
    )


_FL = "array_to_string(validation_flags, ';') AS validation_flags"


@query(_PLAIN + "\nSELECT flag, count(*) AS n FROM (SELECT unnest(validation_flags) AS flag FROM v_plain) GROUP BY flag")
def flag_histogram(spark: SparkSession, d: str) -> DataFrame:
    return R.flag_histogram(plain_rows(spark, d))


@query(_PLAIN + "\nSELECT sample_id, count(*) AS total, count(*) FILTER (WHERE row_role = 'security_main_row') AS main_rows, count(*) FILTER (WHERE len(validation_flags) > 0) AS flagged FROM v_plain GROUP BY sample_id")
def sample_summary(spark: SparkSession, d: str) -> DataFrame:
    return R.sample_summary(plain_rows(spark, d))


_INHERIT = _PLAIN + """,
pv AS (SELECT *, last_value(CASE WHEN row_role = 'security_main_row' AND issuer_name_clean <> '' THEN {'i': issuer_name_clean, 'c': capital_subscribed, 's': shares_outstanding, 'n': nominal_value} END IGNORE NULLS) OVER (PARTITION BY sample_id, section ORDER BY row_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM v_plain),
fl AS (SELECT *, row_role = 'security_continuation_row' AND p IS NOT NULL AS on_ FROM pv),
gi AS (SELECT *, on_ AND issuer_name_clean = '' AS gi, on_ AND capital_subscribed = '' AND p.c <> '' AS gc, on_ AND shares_outstanding = '' AND p.s <> '' AS gs, on_ AND nominal_value = '' AND p.n <> '' AS gn FROM fl),
inh AS (SELECT sample_id, row_index, section, row_role, CASE WHEN gi THEN p.i ELSE issuer_name_clean END AS issuer_name_clean, CASE WHEN gc THEN p.c ELSE capital_subscribed END AS capital_subscribed, CASE WHEN gs THEN p.s ELSE shares_outstanding END AS shares_outstanding, CASE WHEN gn THEN p.n ELSE nominal_value END AS nominal_value,
  list_concat(list_filter(validation_flags, lambda f: NOT ((gi AND f = 'missing_issuer') OR (gc AND f = 'missing_capital') OR (gs AND f = 'missing_shares') OR (gn AND f = 'missing_nominal'))), list_filter([CASE WHEN gi THEN 'issuer_inherited' END, CASE WHEN gi OR gc OR gs OR gn THEN 'identity_inherited_from_previous_row' END], lambda f: f IS NOT NULL)) AS validation_flags FROM gi)"""
_INHERITED = ["sample_id", "row_index", "section", "row_role", "issuer_name_clean", "capital_subscribed", "shares_outstanding", "nominal_value", "validation_flags"]


@query(_INHERIT + f"\nSELECT sample_id, row_index, issuer_name_clean, capital_subscribed, shares_outstanding, nominal_value, {_FL} FROM inh")
def continuation_inherit(spark: SparkSession, d: str) -> DataFrame:
    out = equity.inherit(plain_rows(spark, d).select(*_INHERITED))
    return _flat(out).select("sample_id", "row_index", "issuer_name_clean", "capital_subscribed", "shares_outstanding", "nominal_value", "validation_flags")


@query(_INHERIT + f""",
nx AS (SELECT *, coalesce(list_contains(validation_flags, 'missing_issuer') AND lead(section) OVER o = section AND lead(issuer_name_clean) OVER o <> '' AND (capital_subscribed <> '')::INT + (shares_outstanding <> '')::INT + (nominal_value <> '')::INT >= 2, FALSE) AS gives, lead(issuer_name_clean) OVER o AS ni FROM inh WINDOW o AS (PARTITION BY sample_id ORDER BY row_index)),
dn AS (SELECT *, lag(CASE WHEN gives THEN {{'c': capital_subscribed, 's': shares_outstanding, 'n': nominal_value}} END) OVER (PARTITION BY sample_id ORDER BY row_index) AS d FROM nx),
tk AS (SELECT *, coalesce(capital_subscribed = '' AND d.c <> '', FALSE) AS tc, coalesce(shares_outstanding = '' AND d.s <> '', FALSE) AS ts, coalesce(nominal_value = '' AND d.n <> '', FALSE) AS tn FROM dn)
SELECT sample_id, row_index, CASE WHEN gives THEN 'split_identity_prefix' ELSE row_role END AS row_role, CASE WHEN gives THEN ni ELSE issuer_name_clean END AS issuer_name_clean, CASE WHEN tc THEN d.c ELSE capital_subscribed END AS capital_subscribed, CASE WHEN ts THEN d.s ELSE shares_outstanding END AS shares_outstanding, CASE WHEN tn THEN d.n ELSE nominal_value END AS nominal_value,
  array_to_string(list_concat(list_filter(validation_flags, lambda f: NOT ((tc AND f = 'missing_capital') OR (ts AND f = 'missing_shares') OR (tn AND f = 'missing_nominal') OR (gives AND f = 'missing_issuer'))), list_filter([CASE WHEN tc OR ts OR tn THEN 'identity_from_previous_split_prefix' END, CASE WHEN gives THEN 'probable_split_identity_prefix' END], lambda f: f IS NOT NULL)), ';') AS validation_flags FROM tk""")
def split_prefix_repair(spark: SparkSession, d: str) -> DataFrame:
    out = equity.context(plain_rows(spark, d).select(*_INHERITED))
    return _flat(out).drop("section")


_LONG = _PLAIN + """,
lg AS (SELECT sample_id, row_index, m.pos, m.field, m.clean, m.raw, list_filter(validation_flags, lambda f: list_contains(m.fl, f)) AS flags FROM v_plain, LATERAL (VALUES """ + ", ".join(f"({i}, '{c}', {c}, {r}, {[*fl, *GENERIC_FLAGS]!r})" for i, (c, r, fl) in enumerate(FIELDS) if c in ("issuer_name_clean", "capital_subscribed", "shares_outstanding", "nominal_value", "price_close", "quantity_traded")) + ") m(pos, field, clean, raw, fl))"
_HARD = "regexp_matches(f, '^(?:missing_|multi_value_)|(?:_ocr_noise|_needs_review)$|^(?:glued_shares_nominal_raw|probable_row_fragment|probable_split_identity_prefix)$')"


@query(_LONG + f""",
sn AS (SELECT field, flag, count(*) AS n, min((sample_id, row_index, flag)) AS first_ FROM (SELECT field, sample_id, row_index, unnest(flags) AS flag FROM lg) GROUP BY field, flag),
tp AS (SELECT field, string_agg(flag || ':' || n::VARCHAR, '; ' ORDER BY n DESC, first_) AS top_field_flags FROM (SELECT * FROM sn QUALIFY row_number() OVER (PARTITION BY field ORDER BY n DESC, first_) <= 8) GROUP BY field)
SELECT field, count(*) AS total_rows, count(*) FILTER (WHERE trim(clean) = '') AS empty_clean, count(*) FILTER (WHERE trim(raw) = '') AS empty_raw, count(*) FILTER (WHERE trim(raw) <> '' AND trim(clean) = '') AS raw_present_clean_empty, count(*) FILTER (WHERE trim(clean) <> '' AND trim(raw) = '') AS clean_present_raw_empty, count(*) FILTER (WHERE len(flags) > 0) AS field_flagged_rows,
  count(*) FILTER (WHERE len(list_filter(flags, lambda f: {_HARD})) > 0) AS field_review_rows, count(*) FILTER (WHERE len(list_filter(flags, lambda f: regexp_matches(f, 'rescued|_inherited$'))) > 0) AS rescued_or_inherited_rows, count(*) FILTER (WHERE len(list_filter(flags, lambda f: f LIKE '%\\_likely\\_printed\\_blank' ESCAPE '\\')) > 0) AS likely_printed_blank_rows, coalesce(max(top_field_flags), '') AS top_field_flags FROM lg LEFT JOIN tp USING (field) GROUP BY field""")
def column_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    return R.column_diagnostics(plain_rows(spark, d))


@query(_LONG + """
SELECT field, issue_kind, sample_id, row_index, n FROM (SELECT *, row_number() OVER (PARTITION BY field, issue_kind ORDER BY sample_id, row_index) AS n FROM (SELECT field, sample_id, row_index, unnest(list_filter([CASE WHEN trim(clean) = '' THEN 'empty_clean_value' END, CASE WHEN trim(raw) <> '' AND trim(clean) = '' THEN 'raw_present_but_clean_empty' END, CASE WHEN len(flags) > 0 THEN 'field_flag' END], lambda x: x IS NOT NULL)) AS issue_kind FROM lg)) WHERE n <= 8""")
def issue_examples(spark: SparkSession, d: str) -> DataFrame:
    return R.issue_examples(plain_rows(spark, d))


_CAT = """CASE WHEN list_contains(validation_flags, 'missing_issuer') AND row_role = 'security_continuation_row' THEN 'continuation row needs parent context' WHEN (row_index * 100) / 1000 > 0.78 AND list_has_any(validation_flags, ['missing_capital', 'missing_nominal', 'missing_shares']) THEN 'bottom-row crowding / identity OCR loss'
  WHEN list_contains(validation_flags, 'missing_nominal') AND regexp_matches(raw_row_text, '[0-9]') THEN 'nominal validation or glued identity cells' WHEN list_contains(validation_flags, 'missing_capital') AND capital_subscribed = '' THEN 'left identity-column OCR loss' WHEN list_contains(validation_flags, 'missing_issuer') THEN 'issuer text missing or continuation semantics' ELSE 'general high-priority identity issue' END"""
_PRIORITY = _PLAIN + f""",
pr AS (SELECT *, array_to_string(list_filter(['missing_capital', 'missing_nominal', 'missing_issuer'], lambda f: list_contains(validation_flags, f)), ';') AS priority_reason, {_CAT} AS problem_category FROM v_plain WHERE list_has_any(validation_flags, ['missing_capital', 'missing_nominal', 'missing_issuer']))"""


def _packet(spark: SparkSession, d: str) -> DataFrame:
    return R.priority_rows(plain_rows(spark, d)).withColumn("problem_category", R.problem_category(F.col("row_index") * 100, F.lit(1000)))


@query(_PRIORITY + "\nSELECT sample_id, row_index, priority_reason, problem_category FROM pr")
def priority_rows(spark: SparkSession, d: str) -> DataFrame:
    return _packet(spark, d).select("sample_id", "row_index", "priority_reason", "problem_category")


@query(_PRIORITY + "\nSELECT problem_category, n FROM (SELECT problem_category, count(*) AS n, min((sample_id, row_index)) AS f FROM pr GROUP BY problem_category ORDER BY n DESC, f LIMIT 15)")
def packet_counts(spark: SparkSession, d: str) -> DataFrame:
    return R.most_common(_packet(spark, d), "problem_category")


@query(_PRIORITY + f"\nSELECT sample_id, row_index, section, row_role, problem_category, priority_reason, issuer_name_clean, capital_subscribed, shares_outstanding, nominal_value, price_close, quantity_traded, {_FL}, raw_row_text, 'manual_review' AS review_action, '' AS corrected_capital_subscribed, '' AS corrected_shares_outstanding, '' AS corrected_nominal_value, '' AS corrected_issuer_name, '' AS merge_target_row_index, '' AS review_notes FROM pr")
def correction_template(spark: SparkSession, d: str) -> DataFrame:
    return R.correction_template(_packet(spark, d))


_CORR = _PLAIN + """,
vc AS (SELECT sample_id, row_index, s AS seq, (['keep', ' Merge', 'exclude', 'manual_review', '', 'bogus'])[(sample_id + row_index + s) % 6 + 1] AS review_action, CASE WHEN s = 0 THEN '' ELSE '123456' END AS corrected_capital_subscribed, shares_outstanding AS corrected_shares_outstanding, '100' AS corrected_nominal_value, '' AS corrected_issuer_name, CASE WHEN row_index % 2 = 0 THEN (row_index - 1)::VARCHAR ELSE '' END AS merge_target_row_index
  FROM v_plain, (VALUES (0), (1)) v(s) WHERE (sample_id + row_index) % 3 = 0 AND (s = 0 OR (sample_id + row_index) % 2 = 0)),
lc AS (SELECT *, lower(trim(review_action)) AS a FROM vc QUALIFY row_number() OVER (PARTITION BY sample_id, row_index ORDER BY seq DESC) = 1),
jn AS (SELECT p.*, c.a, c.merge_target_row_index AS target, c.a IS NOT NULL AS has, corrected_capital_subscribed AS cc, corrected_shares_outstanding AS cs, corrected_nominal_value AS cn, coalesce(c.a IN ('keep', 'merge'), FALSE) AS fill, coalesce(c.a IN ('exclude', 'merge'), FALSE) AS role_ FROM v_plain p LEFT JOIN lc c USING (sample_id, row_index)),
ch AS (SELECT *, fill AND cc <> '' AND cc <> capital_subscribed AS xc, fill AND cs <> '' AND cs <> shares_outstanding AS xs, fill AND cn <> '' AND cn <> nominal_value AS xn FROM jn),
ap AS (SELECT *, role_ OR xc OR xs OR xn AS changed, list_filter([CASE WHEN a = 'exclude' THEN 'manual_exclude' END, CASE WHEN a = 'merge' THEN 'manual_merge_requested' END, CASE WHEN a = 'merge' AND target <> '' THEN 'manual_merge_target_' || target END, CASE WHEN xc THEN 'manual_corrected_capital_subscribed' END, CASE WHEN xs THEN 'manual_corrected_shares_outstanding' END, CASE WHEN xn THEN 'manual_corrected_nominal_value' END, 'manual_corrected'], lambda f: f IS NOT NULL) AS added FROM ch)"""


def corrections(spark: SparkSession, d: str) -> DataFrame:
    p = plain_rows(spark, d).withColumn("seq", F.explode(F.array(F.lit(0), F.lit(1)))).where("(sample_id + row_index) % 3 = 0 AND (seq = 0 OR (sample_id + row_index) % 2 = 0)")
    action = F.get(F.array(*map(F.lit, ("keep", " Merge", "exclude", "manual_review", "", "bogus"))), ((F.col("sample_id") + F.col("row_index") + F.col("seq")) % 6).cast("int"))
    return p.select("sample_id", "row_index", "seq", action.alias("review_action"), F.when(F.col("seq") == 0, "").otherwise("123456").alias("corrected_capital_subscribed"), F.col("shares_outstanding").alias("corrected_shares_outstanding"), F.lit("100").alias("corrected_nominal_value"), F.lit("").alias("corrected_issuer_name"), F.when(F.col("row_index") % 2 == 0, (F.col("row_index") - 1).cast("string")).otherwise("").alias("merge_target_row_index"))


@query(_CORR + """
SELECT sample_id, row_index, CASE WHEN a = 'exclude' THEN 'manual_exclude' WHEN role_ THEN 'manual_merge_requested' ELSE row_role END AS row_role, CASE WHEN xc THEN cc ELSE capital_subscribed END AS capital_subscribed, CASE WHEN xs THEN cs ELSE shares_outstanding END AS shares_outstanding, CASE WHEN xn THEN cn ELSE nominal_value END AS nominal_value,
  array_to_string(CASE WHEN changed THEN list_concat(list_filter(validation_flags, lambda f: NOT ((fill AND cc <> '' AND f = 'missing_capital') OR (fill AND cs <> '' AND f = 'missing_shares') OR (fill AND cn <> '' AND f = 'missing_nominal'))), list_sort(added)) ELSE validation_flags END, ';') AS validation_flags FROM ap""")
def apply_corrections(spark: SparkSession, d: str) -> DataFrame:
    out = R.corrected(plain_rows(spark, d), corrections(spark, d), ["seq"])
    return _flat(out).select("sample_id", "row_index", "row_role", "capital_subscribed", "shares_outstanding", "nominal_value", "validation_flags")


@query(_CORR + """
SELECT sample_id, row_index, a AS review_action, CASE WHEN a = 'bogus' THEN 'invalid_action' WHEN changed THEN 'applied' ELSE 'skipped' END AS status, array_to_string(list_filter([CASE WHEN role_ THEN 'row_role' END, CASE WHEN xc THEN 'capital_subscribed' END, CASE WHEN xs THEN 'shares_outstanding' END, CASE WHEN xn THEN 'nominal_value' END], lambda f: f IS NOT NULL), ';') AS changed_fields FROM ap WHERE has""")
def correction_log(spark: SparkSession, d: str) -> DataFrame:
    out = R.corrected(plain_rows(spark, d), corrections(spark, d), ["seq"])
    return out.where("log IS NOT NULL").select("sample_id", "row_index", "log.*")


@query(_PLAIN + """
SELECT sample_id, row_index, CASE WHEN capital_subscribed = '' AND row_role = 'security_continuation_row' AND lc IS NOT NULL THEN lc ELSE capital_subscribed END AS capital_filled, CASE WHEN capital_subscribed <> '' THEN 'ocr' WHEN row_role = 'security_continuation_row' AND lc IS NOT NULL THEN 'carry_forward' ELSE '' END AS capital_source, CASE WHEN nominal_value = '' AND ln IS NOT NULL THEN ln ELSE nominal_value END AS nominal_filled
FROM (SELECT *, last_value(nullif(capital_subscribed, '') IGNORE NULLS) OVER o AS lc, last_value(nullif(nominal_value, '') IGNORE NULLS) OVER o AS ln FROM v_plain WINDOW o AS (PARTITION BY sample_id ORDER BY row_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""")
def carry_forward(spark: SparkSession, d: str) -> DataFrame:
    allowed = {"capital_subscribed": F.col("row_role") == "security_continuation_row", "nominal_value": F.lit(True)}
    out = R.carried(plain_rows(spark, d), ["capital_subscribed", "nominal_value"], allowed)
    return out.select("sample_id", "row_index", F.col("capital_subscribed_filled").alias("capital_filled"), F.col("capital_subscribed_fill_source").alias("capital_source"), F.col("nominal_value_filled").alias("nominal_filled"))


# bonds


def bond_rows(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    return c.select("sample_id", F.col("row_index").alias("record_index"), F.lit("candidate_record").alias("record_type"), F.lit("").alias("record_role"), "section", F.col("issuer_raw").alias("security_name_raw"), F.col("capital_raw").alias("capital_in_circulation_raw"), F.col("nominal_raw").alias("nominal_value_raw"), F.when(F.col("row_index") % 3 == 0, "").otherwise(F.lit("1960")).alias("maturity_year_raw"), F.col("cedola_raw").alias("coupon_date_raw"), F.col("close_raw").alias("price_close_raw"), F.col("quantity_raw").alias("quantity_traded_raw"), F.concat_ws(" ", "capital_raw", "nominal_raw", F.lit("1960"), "issuer_raw").alias("raw_text"), F.col("conf").cast("string").alias("mean_conf"))


@query(None)
def bond_clean(spark: SparkSession, d: str) -> DataFrame:
    out = bond.clean(bond_rows(spark, d), ["sample_id", "record_index"])
    return out.withColumns({"validation_flags": F.array_join("validation_flags", ";"), "processing_flags": F.array_join("processing_flags", ";")})


@query(None)
def bond_carry_forward(spark: SparkSession, d: str) -> DataFrame:
    out = bond.carry_forward(bond.clean(bond_rows(spark, d), ["sample_id", "record_index"]))
    return out.withColumns({"validation_flags": F.array_join("validation_flags", ";"), "processing_flags": F.array_join("processing_flags", ";")})


@query(f"""SELECT {_K}, CASE WHEN a < 1000 AND b < 100 THEN a::VARCHAR || '.' || lpad(b::VARCHAR, 2, '0') ELSE a::VARCHAR END AS price, 'possible_price_column_merge' AS flags FROM (SELECT {_K}, sample_id % 1500 + 1 AS a, row_index AS b FROM v_cells)""")
def bond_price_quantity(spark: SparkSession, d: str) -> DataFrame:
    p = bond.price_and_quantity(F.concat_ws(" ", (F.col("sample_id") % 1500 + 1).cast("string"), F.col("row_index").cast("string")), F.lit(""))
    return cells(spark, d).select("sample_id", "row_index", p["price"].alias("price"), F.array_join(p["flags"], ";").alias("flags"))


@query(None)
def bond_left_infer(spark: SparkSession, d: str) -> DataFrame:
    i = bond.inferred_left(F.concat_ws(" ", "capital_raw", "nominal_raw", F.lit("1960"), "issuer_raw"))
    return cells(spark, d).select("sample_id", "row_index", *[i[f].alias(f) for f in ("capital", "nominal", "maturity")])
