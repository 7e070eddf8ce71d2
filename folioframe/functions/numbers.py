"""Numbers in Italian notation, as column expressions over text; a value that isn't there is ''."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioframe.dimensions import NOMINALS
from folioframe.functions.text import bond_text, letter_count, ocr_text, text_of

# The number grammar, alternatives in the order in which they are tried.
NUMBER = (
    r"(?<!\d)("
    r"\d{1,3}(?:[.,]\d{3})+(?:,\d+)?"
    r"|\d{1,3} \d{3}(?:[.,]\d{3})+(?:,\d+)?"
    r"|\d{1,3} \d{3}(?:\.\d{3})+(?:,\d+)?"
    r"|\d{4,}(?:\.\d{3})+(?:,\d+)?"
    r"|\d{1,3}(?:\.\d{3})+(?:,\d+)?"
    r"|\d{1,3}(?: \d{3})+(?:,\d+)?"
    r"|\d+(?:,\d+)?"
    r")(?:\s*[—-]+)?"
)
# End of fixed values.


def number_tokens(c: Column) -> Column:
    """Numbers of an equity cell as they are written: they begin and end with a digit and hold digits, dots, commas and spaces.

    What OCR damages (dashes, look-alikes, currency signs) is no part of them and parts none of them, so it isn't mended first.
    """
    return F.regexp_extract_all(text_of(c), F.lit(NUMBER), F.lit(1))


def token_value(t: Column, decimal: bool = False) -> Column:
    """parse_number() of one of number_tokens(), where only its marks are left to mend."""
    without = lambda c, marks: reduce(lambda a, m: F.replace(a, F.lit(m), F.lit("")), marks, c)
    if not decimal:
        return without(t, "., ")
    return F.when(F.contains(t, F.lit(",")), without(F.regexp_replace(without(t, ". "), r",(\d{1,2})$", ".$1"), ",")).otherwise(without(t, ". "))


def plain_value(t: Column, decimal: bool = False) -> Column:
    """parse_bond_number() of one of plain_tokens(), which hold digits, dots and commas alone."""
    if not decimal:
        return F.translate(t, ".,", "")
    return F.translate(F.regexp_replace(t, r"^(.*),(\d{1,2})$|^(\d+(?:\.\d+)*)\.(\d{1,2})$", "$1$3;$2$4"), ";.,", ".")


def plain_tokens(c: Column) -> Column:
    """Numbers of other cells: a digit, then digits, dots and commas."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"(\d[\d.,]*)"), F.lit(1)), lambda t: F.btrim(t, F.lit(".,")))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def _value(t: Column, decimal: bool) -> Column:
    after = F.substring_index(t, ",", -1)
    left = F.substring(t, F.lit(1), F.length(t) - F.length(after) - 1)
    last = F.substring_index(t, ".", -1)
    whole = _digits(t)
    comma, dot = F.contains(t, F.lit(",")), F.contains(t, F.lit("."))
    if not decimal:
        return F.when(t == "", F.lit("")).otherwise(whole)
    by_comma = F.when(after.rlike(r"^\d{1,2}$"), F.when(_digits(left) != "", F.concat(_digits(left), F.lit("."), after)).otherwise(F.lit(""))).otherwise(whole)
    by_dot = F.when((F.length(last) <= 2) & t.rlike(r"^\d+(?:\.\d+)+$"), F.concat(F.replace(F.substring(t, F.lit(1), F.length(t) - F.length(last) - 1), F.lit("."), F.lit("")), F.lit("."), last)).otherwise(whole)
    return F.when(t == "", F.lit("")).when(comma, by_comma).when(dot, by_dot).otherwise(whole)


def parse_number(c: Column, decimal: bool = False) -> Column:
    """A number token of an equity cell as digits, with a point before at most two decimals if they are allowed."""
    t = F.translate(F.btrim(ocr_text(c)), "' €?", "")
    t = F.regexp_replace(F.regexp_replace(t, r"(?<=\d)[CcOo](?=\d)", "0"), r"(?<=\d)[CcOo]$", "0")
    return _value(F.btrim(t, F.lit(".,;:-")), decimal)


def parse_bond_number(c: Column, decimal: bool = False) -> Column:
    t = F.regexp_replace(F.translate(bond_text(c), " '", ""), r"(?<=\d)[OoC](?=\d)", "0")
    return _value(F.btrim(t, F.lit(".,;:-")), decimal)


def parsed(c: Column, decimal: bool = False) -> Column:
    """All numbers of an equity cell, in order."""
    return values_of(number_tokens(c), decimal)


def values_of(tokens: Column, decimal: bool = False) -> Column:
    """Values of number_tokens(), in order."""
    return F.transform(tokens, lambda t: token_value(t, decimal))


def greatest_of(values: Column) -> Column:
    """The value with the most whole digits, then the greatest, then the first; '' for none."""
    ranked = F.transform(values, lambda v, i: F.struct(F.length(F.substring_index(v, ".", 1)).alias("n"), as_decimal(v).alias("d"), (-i).alias("i"), v.alias("v")))
    return F.coalesce(F.array_max(ranked)["v"], F.lit(""))


def bond_parsed(c: Column, decimal: bool = False) -> Column:
    """All numbers of a bond cell, in order; what bond_text() mends is no part of them."""
    return F.transform(plain_tokens(text_of(c)), lambda t: plain_value(t, decimal))


def first_of(values: Column) -> Column:
    return F.coalesce(F.get(values, F.lit(0)), F.lit(""))


def last_of(values: Column) -> Column:
    return F.coalesce(F.try_element_at(values, F.lit(-1)), F.lit(""))


def as_double(c: Column) -> Column:
    """The number, or -1 where there is none."""
    return F.coalesce(c.try_cast("double"), F.lit(-1.0))


def as_decimal(c: Column) -> Column:
    return c.try_cast("decimal(38,2)")


def first_numeric(c: Column, decimal: bool = False, prefer_large: bool = False, most: int | None = None) -> Column:
    """The first number of a cell up to a most; if the large are preferred, that with the most whole digits, then the
    greatest, then the first."""
    values = parsed(c, decimal)
    if most is not None:
        values = F.filter(values, lambda v: as_decimal(v) <= most)
    if not prefer_large:
        return first_of(values)
    return greatest_of(values)


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _whole(c: Column, pattern: str) -> Column:
    """Whether a whole number of at most 38 digits, zeros before it aside, is one that the pattern describes."""
    return _true(c.rlike(f"^0*(?:{pattern})$"))


_FIFTHS = "(?:00|25|50|75)"
_ODD_NOMINALS = "|".join(str(n) for n in NOMINALS if n % 25 or not 25 <= n <= 20000)


def is_large(c: Column) -> Column:
    """10000 or more."""
    return _whole(c, r"[1-9]\d{4,37}")


def is_nominal(c: Column) -> Column:
    """A known nominal, or a multiple of 25 up to 20000."""
    return _whole(c, rf"25|50|75|[1-9]\d?{_FIFTHS}|1\d\d{_FIFTHS}|20000|{_ODD_NOMINALS}")


def is_identity_amount(c: Column) -> Column:
    """1000 or more."""
    return _whole(c, r"[1-9]\d{3,37}")


def is_suspicious(c: Column) -> Column:
    """1 to 30."""
    return _whole(c, r"[1-9]|[12]\d|30")


def is_up_to_thirty(c: Column) -> Column:
    return _whole(c, r"[12]?\d|30")


def is_quantity(c: Column) -> Column:
    """1 to 500000."""
    return _whole(c, r"[1-9]\d{0,4}|[1-4]\d{5}|500000")


def is_price(c: Column) -> Column:
    d = as_decimal(c)
    return _true((d > 0) & (d <= 300000))


def without_row_marker(c: Column) -> Column:
    """Amounts of nine digits and more lose their first two if the third isn't zero."""
    return F.when(~F.contains(c, F.lit(".")) & (F.length(c) >= 9) & c.rlike(r"^\d\d[1-9]"), F.substring(c, F.lit(3), F.length(c))).otherwise(c)


def glued(c: Column) -> Column:
    """struct(value, nominal): a nominal of 4, 3 or 2 digits at the end of an identity amount is taken off it."""
    out = F.struct(c.alias("value"), F.lit("").alias("nominal"))
    ok = ~F.contains(c, F.lit(".")) & (F.length(c) >= 7)
    for k in (2, 3, 4):
        head, tail = F.substring(c, F.lit(1), F.length(c) - k), F.substring(c, F.length(c) - k + 1, F.lit(k))
        out = F.when(ok & is_identity_amount(head) & is_nominal(tail), F.struct(head.alias("value"), tail.alias("nominal"))).otherwise(out)
    return out


def identity_pairs(tokens: Column) -> Column:
    """For each token its value and, of tokens of two parts, the values of both ('' for others)."""

    def one(t: Column) -> Column:
        two = t.rlike("^[^ ]+ [^ ]+$")
        part = lambda k: F.when(two, token_value(F.substring_index(t, " ", k))).otherwise("")
        return F.struct(token_value(t).alias("value"), part(1).alias("left"), part(-1).alias("right"))

    return F.transform(tokens, one)


def values_of_pairs(pairs: Column) -> Column:
    """Values of such tokens; a row number and a nominal read as one count as the nominal."""
    pick = lambda p: F.when((p["left"] != "") & is_up_to_thirty(p["left"]) & is_nominal(p["right"]) & ~is_large(p["right"]), p["right"]).otherwise(p["value"])
    return F.transform(pairs, pick)


def identity_values(c: Column) -> Column:
    """Whole numbers of an identity cell; a row number and a nominal read as one count as the nominal."""
    return values_of_pairs(identity_pairs(number_tokens(c)))


def nominal_values(c: Column) -> Column:
    """Numbers of a cell that may be nominals, row numbers taken off."""
    return F.filter(identity_values(c), lambda v: is_nominal(v) & ~is_large(v))


def only_small_extras(tokens: Column, selected: Column, most: int = 31) -> Column:
    """The first number is the selected one and all others are small."""
    values = values_of(tokens)
    extras = F.slice(values, F.lit(2), F.greatest(F.size(values), F.lit(1)))
    return (F.size(tokens) > 1) & (selected != "") & _true(F.get(values, F.lit(0)) == selected) & (F.size(extras) > 0) & F.forall(extras, lambda v: _true(v.try_cast("decimal(38,0)") <= most))


def over_thirty(values: Column) -> Column:
    return F.filter(values, lambda v: _whole(v, r"3[1-9]|[4-9]\d|[1-9]\d{2,37}"))


def places(values: Column, test) -> Column:
    """Places (from 1) of the values that pass the test."""
    return F.filter(F.transform(values, lambda v, i: F.when(test(v), i + 1)), lambda p: p.isNotNull())


def _if(found: Column, **fields: Column) -> Column:
    return F.struct(*[F.when(found, c).otherwise("").alias(n) for n, c in fields.items()])


def sequence_of(kept: Column, large: Column) -> Column:
    """struct(capital, shares, nominal) of values over thirty and the large ones of them."""
    second = F.array_position(kept, F.get(large, F.lit(1)))
    after = F.slice(kept, F.greatest(F.coalesce(second.cast("int"), F.lit(0)) + 1, F.lit(1)), F.greatest(F.size(kept), F.lit(1)))
    return _if(F.size(large) >= 2, capital=F.get(large, F.lit(0)), shares=F.get(large, F.lit(1)), nominal=first_of(F.filter(after, lambda v: is_nominal(v) & ~is_large(v))))


def column_sequence(values: Column) -> Column:
    """struct(capital, shares, nominal) from whole numbers in order: the first two large ones and a nominal after them."""
    kept = over_thirty(values)
    return sequence_of(kept, F.filter(kept, is_large))


def row_pattern_of(values: Column, at: Column, suffix: Column, repaired: Column) -> Column:
    """struct(capital, shares, nominal) of a row's values, the places of its amounts, the values after and nominals in them."""
    nominal = first_of(F.filter(F.when(F.size(repaired) > 0, repaired).otherwise(suffix), lambda v: is_nominal(v) & ~is_identity_amount(v)))
    return _if(F.size(at) >= 2, capital=F.get(values, F.get(at, F.lit(0)) - 1), shares=F.get(values, F.get(at, F.lit(1)) - 1), nominal=nominal)


def suffix_of(values: Column, at: Column) -> Column:
    """The four values after the second of these places; none without it."""
    return F.when(F.size(at) >= 2, F.slice(values, F.get(at, F.lit(1)) + 1, F.lit(4))).otherwise(F.array().cast("array<string>"))


def raw_row_pattern(text: Column) -> Column:
    """struct(capital, shares, nominal) from a whole row: two amounts of 1000 and more and a nominal in the next four."""
    values = over_thirty(parsed(text))
    at = places(values, is_identity_amount)
    suffix = suffix_of(values, at)
    return row_pattern_of(values, at, suffix, nominal_values(F.array_join(suffix, " ")))


def without_markers(values: Column) -> Column:
    """values without small ones before large ones."""
    return F.filter(F.transform(values, lambda v, i: F.when(~(is_up_to_thirty(v) & is_large(F.coalesce(F.get(values, i + 1), F.lit("")))), v)), lambda v: v.isNotNull())


def fallback_of(kept: Column, at: Column) -> Column:
    """struct(capital, shares, nominal) of values and the places of the large ones; null where there are none."""
    second = F.get(at, F.lit(1))
    after = F.when(second.isNotNull(), F.slice(kept, second + 1, F.greatest(F.size(kept), F.lit(1)))).otherwise(F.array().cast("array<string>"))
    return F.when(kept.isNotNull(), _if(second.isNotNull(), capital=F.get(kept, F.get(at, F.lit(0)) - 1), shares=F.get(kept, second - 1), nominal=first_of(F.filter(after, is_nominal))))


def identity_fallback(text: Column) -> Column:
    """struct(capital, shares, nominal) from a right page's row, small numbers before large ones left out."""
    kept = without_markers(identity_values(text))
    return fallback_of(kept, places(kept, is_large))


def price_pair(values: Column) -> Column:
    """struct(price, quantity) of prices in order: the last is a quantity if it may be one and isn't the only one."""
    n = F.size(values)
    pair = (n >= 2) & is_quantity(last_of(values))
    return F.struct(F.when(pair, F.get(values, n - 2)).otherwise(last_of(values)).alias("price"), F.when(pair, last_of(values)).otherwise("").alias("quantity"))


def price_quantity(low: Column, high: Column) -> Column:
    """struct(price, quantity) from the cells of the lowest and the highest price."""
    return price_pair(F.filter(parsed(F.concat_ws(" ", text_of(low), text_of(high)), True), is_price))


def best_identity(field: str, text: Column) -> Column:
    """The value of a strip read for one identity field; too much text beside several values makes it unsafe."""
    values, letters = parsed(text), letter_count(text)
    if field == "nominal_value_raw":
        good = F.filter(values, is_nominal)
        return F.when((letters > 8) & (F.size(values) > 3), F.lit("")).otherwise(first_of(good))
    good = F.filter(values, is_large)
    return F.when((letters > 10) & (F.size(good) > 1), F.lit("")).otherwise(first_of(good))

