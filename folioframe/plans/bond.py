"""Cleaning of bond records, and repeated fields carried forward with their provenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.dimensions import BOND_FOOTNOTES, BOND_NOMINALS, BOND_SECTIONS
from folioframe.functions import numbers as N
from folioframe.functions import text as T
from folioframe.functions.dates import parse_date, parse_year
from folioframe.operators.words import let

RAW = ["capital_in_circulation_raw", "nominal_value_raw", "maturity_year_raw", "extraction_period_raw", "godimento_raw", "coupon_date_raw", "coupon_net_amount_raw", "coupon_number_raw", "compensation_price_raw", "security_name_raw", "price_min_raw", "price_max_raw", "price_close_raw", "quantity_traded_raw"]
LEFT = ["capital_in_circulation", "nominal_value", "maturity_year"]
FILLABLE = ["security_name_clean", *LEFT, "extraction_period", "godimento"]


def _flags(*pairs: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in pairs]))


def price_and_quantity(price: Column, quantity: Column) -> Column:
    """struct(price, quantity, flags, processing) of a closing price cell that may hold a quantity too."""
    read = F.struct(T.bond_text(price).alias("text"), N.bond_parsed(price, True).alias("values"), N.first_of(N.bond_parsed(quantity)).alias("given"))
    return let(read, _price_and_quantity)


def _price_and_quantity(read: Column) -> Column:
    text, values, given = read["text"], read["values"], read["given"]
    n = F.size(values)
    digits = lambda v: F.translate(F.coalesce(v, F.lit("")), ".", "")
    first, second, last = digits(F.get(values, F.lit(0))), digits(F.get(values, F.lit(1))), digits(F.try_element_at(values, F.lit(-1)))
    split = F.concat(first, F.lit("."), F.lpad(second, F.greatest(F.lit(2), F.length(second)), F.lit("0")))
    two = (n == 2) & text.rlike(r"^\D*\d{1,3}\s+\d{1,2}\D*$") & ~F.contains(text, F.lit(",")) & ~F.contains(text, F.lit("-"))
    slash = (n >= 3) & F.contains(text, F.lit("/"))
    hint = (n > 1) & (F.contains(text, F.lit("/")) | text.rlike(r"(?i)\bm\b")) & (last != "")

    def told(k: Column) -> Column:
        taken = (given == "") & (k["slash"] | k["hint"])
        return F.struct(
            F.when(k["two"] | k["slash"], split).otherwise(N.first_of(values)).alias("price"),
            F.when(taken, last).otherwise(given).alias("quantity"),
            _flags((n > 1, "possible_price_column_merge")).alias("flags"),
            _flags((k["two"] | k["slash"], "price_decimal_split_from_ocr_tokens"), (taken, "quantity_split_from_price_cell")).alias("processing"),
        )

    return let(F.struct(two.alias("two"), slash.alias("slash"), hint.alias("hint")), told)


def inferred_left(raw: Column) -> Column:
    """struct(capital, nominal, maturity) read off the first five numbers of a row, from left to right."""
    return let(F.slice(N.plain_tokens(T.text_of(raw)), 1, 6), _inferred_left)


def _inferred_left(tokens: Column) -> Column:
    nominal = lambda v: v.isin(BOND_NOMINALS)
    values = F.transform(tokens, lambda t: F.struct(t.alias("t"), N.plain_value(t).alias("v")))

    def items(x: Column) -> Column:
        def item(y: Column, i: Column) -> Column:
            v, pair = y["v"], F.concat(y["v"], F.get(x, i + 1)["v"])  # null after the last
            year = v.rlike(r"^(?:18[5-9]\d|19\d\d|20\d\d|2100)$")
            large = ~nominal(v) & ~year & (F.contains(y["t"], F.lit(".")) | (F.length(v) >= 5))
            return F.struct(v.alias("v"), year.alias("year"), large.alias("large"), F.when(nominal(v), v).when(nominal(pair), pair).otherwise("").alias("nominal"))

        return F.aggregate(F.slice(F.transform(x, item), 1, 5), start, step)

    def step(s: Column, x: Column) -> Column:
        """A year after the nominal ends the search; a number that is taken for the capital is no nominal."""
        live, first = s["maturity"] == "", x["large"] & (s["capital"] == "")
        return F.struct(F.when(live & first, x["v"]).otherwise(s["capital"]).alias("capital"), F.when(live & ~first & (s["nominal"] == "") & (x["nominal"] != ""), x["nominal"]).otherwise(s["nominal"]).alias("nominal"), F.when(live & (s["nominal"] != "") & x["year"], x["v"]).otherwise(s["maturity"]).alias("maturity"))

    start = F.struct(F.lit("").alias("capital"), F.lit("").alias("nominal"), F.lit("").alias("maturity"))
    return F.when(F.size(tokens) < 3, start).otherwise(let(values, items))


def _has_any(text: Column, terms: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in terms])


def clean(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, type, role and section, the clean fields and their inferences, and both kinds of flags (arrays)."""
    names = [*RAW, "raw_text", "record_type", "record_role", "section", "mean_conf"]
    df = rows.withColumns({n: T.text_of(F.col(n).cast("string")) if n in rows.columns else F.lit("") for n in names})
    c = F.col
    df = df.withColumns({"_low": F.lower(T.bond_text(c("raw_text"))), "_name": T.bond_text(c("security_name_raw"))})
    low, raw_name = c("_low"), c("_name")
    note = _has_any(low, BOND_FOOTNOTES)
    section = (c("record_type") == "section_heading") | (_has_any(low, BOND_SECTIONS) & (F.size(N.plain_tokens(low)) <= 2))
    df = df.withColumns({"record_role": F.when(section, "section_heading").when(note, "footnote_text").otherwise(c("record_role")), "record_type": F.when(section, "section_heading").when(note, "other_text").otherwise(c("record_type"))})
    first = lambda n, decimal=False: N.first_of(N.bond_parsed(c(n), decimal))
    second = lambda n: F.coalesce(F.get(N.bond_parsed(c(n)), F.lit(1)), F.lit(""))
    df = df.withColumns({
        "security_name_clean": T.clean_security_name(c("security_name_raw")), "capital_in_circulation": first("capital_in_circulation_raw"), "nominal_value": first("nominal_value_raw"), "maturity_year": parse_year(c("maturity_year_raw")),
        "capital_in_circulation_extra": second("capital_in_circulation_raw"), "nominal_value_extra": second("nominal_value_raw"), "_left": inferred_left(c("raw_text")), "extraction_period": T.bond_text(c("extraction_period_raw")), "godimento": T.bond_text(c("godimento_raw")),
        "coupon_date": parse_date(T.bond_text(c("coupon_date_raw"))), "coupon_net_amount": first("coupon_net_amount_raw", True), "coupon_number": first("coupon_number_raw"), "compensation_price": first("compensation_price_raw", True), "price_min": first("price_min_raw", True), "price_max": first("price_max_raw", True),
        "_pq": price_and_quantity(c("price_close_raw"), c("quantity_traded_raw")),
    })
    df = df.withColumns({"price_close": c("_pq.price"), "quantity_traded": c("_pq.quantity"), "capital_in_circulation_inferred": c("_left.capital"), "nominal_value_inferred": c("_left.nominal"), "maturity_year_inferred": c("_left.maturity")})
    by_max, by_min = (c("price_close") == "") & (c("price_max") != ""), (c("price_close") == "") & (c("price_max") == "") & (c("price_min") != "")
    df = df.withColumns({"price_close_filled": F.when(by_max, N.last_of(N.bond_parsed(c("price_max_raw"), True))).when(by_min, N.last_of(N.bond_parsed(c("price_min_raw"), True))).otherwise(c("price_close")), "price_close_fill_source": F.when(c("price_close") != "", "ocr").when(by_max, "inferred_from_price_max").when(by_min, "inferred_from_price_min").otherwise("")})
    raw_left = F.concat_ws("", *[T.bond_text(c(n)) for n in RAW[:5]])
    more = raw_name.rlike(r"^[»\"'`.,;:\-\s]+") | ((c("security_name_clean") != "") & (F.length("security_name_clean") <= 8) & raw_name.rlike(r"[%»\"]")) | ((F.btrim(raw_left) == "") & (c("security_name_clean") != ""))
    candidate = c("record_type") == "candidate_record"
    df = df.withColumns({"_more": more, "record_role": F.when(candidate & more, "candidate_continuation").otherwise(c("record_role"))})
    missing = reduce(lambda a, b: a + b, [(c(n) == "").cast("int") for n in LEFT])
    prices = T.without_dashes(F.concat_ws(" ", *[c(n) for n in RAW[10:]]))
    many = lambda n: F.size(N.plain_tokens(c(n))) > 1
    flags = _flags(
        (many("capital_in_circulation_raw") | many("nominal_value_raw"), "possible_left_column_merge"),
        (many("price_close_raw") | (F.size("_pq.flags") > 0), "possible_price_column_merge"),
        (F.coalesce(c("mean_conf").try_cast("double") < 55, F.lit(False)), "low_mean_ocr_confidence"),
        ((c("price_close") == "") & (c("price_close_filled") == "") & (prices != ""), "missing_close_price"),
        (~c("_more") & (missing >= 2), "missing_key_left_fields"),
        (c("security_name_clean") == "", "missing_security_name"),
    )
    processing = F.array_sort(F.array_distinct(F.concat(c("_pq.processing"), _flags((by_max, "price_close_inferred_from_price_max"), (by_min, "price_close_inferred_from_price_min")))))
    df = df.withColumns({"validation_flags": F.when(candidate, F.array_sort(flags)).otherwise(F.array().cast("array<string>")), "processing_flags": processing})
    out = ["record_type", "record_role", "section", "security_name_clean", "capital_in_circulation", "nominal_value", "capital_in_circulation_inferred", "nominal_value_inferred", "maturity_year_inferred", "capital_in_circulation_extra", "nominal_value_extra", "maturity_year", "extraction_period", "godimento", "coupon_date", "coupon_net_amount", "coupon_number", "compensation_price", "price_min", "price_max", "price_close", "price_close_filled", "price_close_fill_source", "quantity_traded", "processing_flags", "validation_flags", "raw_text", *RAW]
    return df.select(*keys, F.inline(F.array(F.struct(*out))))


def carry_forward(rows: DataFrame, sample: str = "sample_id", order: str = "record_index") -> DataFrame:
    """rows with <field>_filled and <field>_fill_source for the fields that repeat on a page."""
    c = F.col
    candidate = c("record_type") == "candidate_record"
    w = Window.partitionBy(sample).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    df = rows.withColumns({f"_l_{f}": F.last(F.when(candidate & (c(f) != ""), c(f)), ignorenulls=True).over(w) for f in FILLABLE})
    count = lambda names: reduce(lambda a, b: a + b, [(c(n) != "").cast("int") for n in names])
    more = c("record_role") == "candidate_continuation"
    allowed = {f: more | (F.lit(True) if f in ("extraction_period", "godimento") else (count(LEFT) >= 2) if f == "security_name_clean" else F.lit(False)) for f in FILLABLE}
    df = df.withColumns({f"_t_{f}": candidate & (c(f) == "") & c(f"_l_{f}").isNotNull() & allowed[f] for f in FILLABLE})
    df = df.withColumns({f"{f}_filled": F.when(c(f"_t_{f}"), c(f"_l_{f}")).otherwise(c(f)) for f in FILLABLE} | {f"{f}_fill_source": F.when(c(f) != "", "ocr").when(c(f"_t_{f}"), "carry_forward").otherwise("") for f in FILLABLE})
    carried = reduce(lambda a, b: a | b, [c(f"_t_{f}") for f in FILLABLE])
    enough = count([f"{f}_filled" for f in LEFT]) >= 2
    df = df.withColumns({"_named": candidate & (c("security_name_clean_filled") != "") & enough, "_enough": candidate & enough, "_carried": carried, **{f"_i_{f}": candidate & (c(f"{f}_filled") == "") & (c(f"{f}_inferred") != "") for f in LEFT}})
    inferred = reduce(lambda a, b: a | b, [c(f"_i_{f}") for f in LEFT])
    df = df.withColumns({"_inferred": inferred} | {f"{f}_filled": F.when(c(f"_i_{f}"), c(f"{f}_inferred")).otherwise(c(f"{f}_filled")) for f in LEFT} | {f"{f}_fill_source": F.when(c(f"_i_{f}"), "inferred_from_raw_row").otherwise(c(f"{f}_fill_source")) for f in LEFT})
    enough = count([f"{f}_filled" for f in LEFT]) >= 2
    gone = _flags((c("_enough") | (c("_inferred") & enough), "missing_key_left_fields"), (c("_named"), "missing_security_name"))
    added = _flags((c("_carried"), "used_carry_forward"), (c("_t_security_name_clean"), "security_name_carried_forward"), (c("_inferred"), "left_fields_inferred_from_raw_row"))
    df = df.withColumns({"validation_flags": F.array_except("validation_flags", gone), "processing_flags": F.array_sort(F.array_union("processing_flags", added))})
    return df.select(*rows.columns, *[f"{f}_{x}" for f in FILLABLE for x in ("filled", "fill_source")])
