"""Text functions as column expressions. Missing text is '' in and out; nulls count as ''."""

from __future__ import annotations

import re
import unicodedata
from difflib import SequenceMatcher
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from folioframe.dimensions import ISSUER_SCRAPS, SECURITY_SCRAPS, STOP_WORDS

_SPACE = r"(?U)\s+"
_LETTERS = "A-Za-zÀ-ÿ"


def text_of(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(""))


def squeeze(c: Column) -> Column:
    """White space runs become one space, none at the ends."""
    return F.btrim(F.regexp_replace(c, _SPACE, " "))


def clean_cell(c: Column, backslash: bool = False) -> Column:
    """Without brackets and bars."""
    return squeeze(F.translate(text_of(c), r"{}[]|" + ("\\" if backslash else ""), " " * (6 if backslash else 5)))


def display_text(c: Column) -> Column:
    """Rule-like characters become spaces."""
    return squeeze(F.regexp_replace(text_of(c), r"[|_{}\[\]]+", " "))


def spreadsheet_safe(c: Column) -> Column:
    """Text that a spreadsheet would take for a formula gets a quote before it."""
    c = text_of(c)
    return F.when(c.rlike(r"^[=+\-@]"), F.concat(F.lit("'"), c)).otherwise(c)


#: Dashes and Cyrillic look-alikes, and what they stand for; accented vowels of both cases, and the plain ones.
_LOOKS, _STANDS = "‐‑‒–—−ЧСТАл", "-------CTAl"
_VOWELS, _PLAIN = "àèéìòù’ÀÈÉÌÒÙ", "aeeiou'AEEIOU"


def _beyond_ascii(c: Column, old: str, new: str) -> Column:
    """c with characters replaced, none of which ASCII has: such texts, which are most, aren't looked through."""
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(F.translate(c, old, new))


def ocr_text(c: Column) -> Column:
    """Dashes and Cyrillic look-alikes become what they stand for."""
    return _beyond_ascii(text_of(c), _LOOKS, _STANDS)


def clean_text(c: Column) -> Column:
    return squeeze(F.translate(ocr_text(c), "{}|\\[]", " " * 6))


def bond_text(c: Column) -> Column:
    """Doubly encoded accents become plain letters; dashes and brackets go as in clean_text."""
    c = text_of(c)
    for old, new in (("Ã ", "a"), ("Ã¨", "e"), ("Ã©", "e"), ("Ã¬", "i"), ("Ã²", "o"), ("Ã¹", "u"), ("â€™", "'"), ("â€”", "-"), ("â€“", "-")):
        c = F.replace(c, F.lit(old), F.lit(new))
    return F.btrim(squeeze(F.translate(c, "—–{}|\\[]", "--" + " " * 6)), F.lit(" .,:;"))


def lookup_text(c: Column) -> Column:
    """Lower case, six accented vowels plain, all else but letters and digits a space."""
    c = F.lower(_beyond_ascii(text_of(c), _LOOKS + _VOWELS, _STANDS + _PLAIN))
    return F.btrim(F.regexp_replace(c, "[^a-z0-9]+", " "))


def heading_text(c: Column) -> Column:
    c = F.lower(text_of(c))
    for old, new in (("Ã ", "a"), ("Ã¨", "e"), ("Ã©", "e"), ("Ã¬", "i"), ("Ã²", "o"), ("Ã¹", "u")):
        c = F.replace(c, F.lit(old), F.lit(new))
    return F.btrim(F.regexp_replace(c, "[^a-z0-9]+", " "))


def tokens(c: Column) -> Column:
    """Distinct words of a lookup text with more than one character."""
    return F.array_distinct(F.filter(F.split(lookup_text(c), " "), lambda w: F.length(w) > 1))


def digit_count(c: Column) -> Column:
    return F.regexp_count(text_of(c), F.lit("[0-9]"))


def letter_count(c: Column) -> Column:
    return F.regexp_count(text_of(c), F.lit(r"\p{L}"))


def is_large_amount(c: Column) -> Column:
    return text_of(c).rlike(r"\d[\d. ]{3,}\d")


def is_noise(c: Column) -> Column:
    """Nothing, or white space and rule-like characters only."""
    return text_of(c).rlike(r"(?U)^[\s_\-|{}\[\]().,;:!]*$")


def is_symbols(c: Column) -> Column:
    """Nothing, or neither letters nor digits."""
    return text_of(c).rlike(r"(?U)^[\W_]*$")


def clean_issuer(c: Column) -> Column:
    c = F.regexp_replace(clean_text(c), f"^[^{_LETTERS}]+", "")
    c = F.regexp_replace(c, rf"(?iU)\b({'|'.join(ISSUER_SCRAPS)})\b", " ")
    return F.btrim(F.regexp_replace(c, _SPACE, " "), F.lit(" .,-;:"))


def clean_security_name(c: Column) -> Column:
    c = F.regexp_replace(bond_text(c), "^[^A-Za-z0-9]+", "")
    c = F.regexp_replace(c, rf"(?iU)\b({'|'.join(SECURITY_SCRAPS)})\b", " ")
    return F.btrim(F.regexp_replace(c, _SPACE, " "), F.lit(" .,:;-"))


def issuer_from_text(c: Column) -> Column:
    """The name with the most words, then the longest, then the first, of a row's text without dates and numbers."""
    c = F.regexp_replace(clean_text(c), r"\b\d{1,2}\s*[-/]\s*\d{1,2}\s*[-/]\s*\d{2,4}\b", " ")
    c = F.regexp_replace(c, r"\d{1,3}(?:[., ]\d{3})+|\d+(?:,\d+)?", " ")
    names = F.transform(F.regexp_extract_all(c, F.lit(f"([{_LETTERS}][{_LETTERS}.'’&() ]{{2,}})"), F.lit(1)), clean_issuer)
    stop = F.array(*map(F.lit, STOP_WORDS))
    words = lambda n: F.filter(F.split(n, " "), lambda w: (w != "") & ~F.array_contains(stop, F.btrim(F.lower(w), F.lit("."))))
    good = F.filter(F.transform(names, lambda n: F.array_join(words(n), " ")), lambda n: F.length(n) >= 4)
    ranked = F.transform(good, lambda n, i: F.struct(F.size(F.split(n, " ")).alias("w"), F.length(n).alias("l"), (-i).alias("i"), n.alias("n")))
    return F.coalesce(F.array_max(ranked)["n"], F.lit(""))


def text_before_issuer(raw: Column, issuer: Column) -> Column:
    """The text before the first of the issuer's first three words that it holds; all of it without one."""
    from folioframe.operators.words import let

    stop = F.array(*map(F.lit, STOP_WORDS))
    words = F.slice(F.filter(F.regexp_extract_all(clean_text(issuer), F.lit(r"(\p{L}{3,})"), F.lit(1)), lambda w: ~F.array_contains(stop, F.lower(w))), 1, 3)

    def cut(x: Column) -> Column:
        places = F.filter(F.transform(x["words"], lambda w: F.call_function("instr", x["low"], F.lower(w))), lambda p: p > 0)
        return let(F.get(places, F.lit(0)), lambda p: F.when(p.isNotNull(), F.substring(x["t"], F.lit(1), p - 1)).otherwise(x["t"]))

    return let(ocr_text(raw), lambda t: let(F.struct(t.alias("t"), F.lower(t).alias("low"), words.alias("words")), cut))


def without_dashes(c: Column) -> Column:
    return F.regexp_replace(bond_text(c), r"(?U)[-—–_.,;:\s]+", "")


def is_blank_cell(c: Column) -> Column:
    """Empty, or dashes, dots and the like only."""
    c = F.translate(F.regexp_replace(F.lower(clean_text(c)), _SPACE, ""), "=_", "--")
    return c.rlike(r"^[-.,;:()?]*$")


def numeric_parts(c: Column) -> Column:
    """Numbers with a dash after them, words, and other runs, as they follow one another."""
    parts = F.regexp_extract_all(text_of(c), F.lit(r"(\d[\d.,]*\s*(?:[—,-]+)?|[A-Za-z]+|\S+)"), F.lit(1))
    return F.filter(F.transform(parts, lambda p: squeeze(F.regexp_replace(F.btrim(p), "^/+", ""))), lambda p: p != "")


def heading_role(c: Column) -> Column:
    """heading for short text with most letters upper case, else paragraph."""
    letters = F.regexp_count(c, F.lit(r"\p{L}"))
    upper = F.regexp_count(c, F.lit(r"\p{Lu}"))
    return F.when((letters > 0) & (upper / F.greatest(letters, F.lit(1)) > 0.55) & (F.length(c) < 120), F.lit("heading")).otherwise(F.lit("paragraph"))


def holds_any(c: Column, names: list[str]) -> Column:
    """Whether a text, which should be a column, holds any of the names; those that hold another one are left out."""
    least = sorted(n for n in set(names) if not any(o in n for o in set(names) - {n}))
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(n)) for n in least])


def terms_in(c: Column, terms: list[str]) -> Column:
    """The terms that occur in the text, any case, in their order."""
    low = F.lower(text_of(c))
    return F.filter(F.array(*map(F.lit, terms)), lambda t: F.contains(low, F.lower(t)))


def html_escape(c: Column) -> Column:
    c = text_of(c)
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def plain_letters(text: str) -> str:
    """Lower-case a to z with accents off, all else a space."""
    plain = "".join(x for x in unicodedata.normalize("NFKD", text) if not unicodedata.combining(x))
    return re.sub("[^a-z]+", " ", plain.lower()).strip()


#: Latin-1 letters and what is left of them without accents; those that become two letters are apart.
_ACCENTED = [chr(c) for c in range(0xA0, 0x180) if len(unicodedata.normalize("NFKD", chr(c))[0]) == 1 and unicodedata.normalize("NFKD", chr(c))[0].isascii() and unicodedata.normalize("NFKD", chr(c))[0].isalpha() and all(map(unicodedata.combining, unicodedata.normalize("NFKD", chr(c))[1:]))]
_BARE = "".join(unicodedata.normalize("NFKD", c)[0] for c in _ACCENTED)


@F.pandas_udf(StringType())
def _letters_beyond_latin(c: pd.Series) -> pd.Series:
    return c.map(lambda s: None if s is None else plain_letters(s))


def letters_only(c: Column) -> Column:
    """plain_letters of a text. ASCII and single accented Latin letters stay in the JVM, where most texts are done; others need a
    compatibility decomposition, which Spark lacks."""
    c = text_of(c)
    latin = F.btrim(F.regexp_replace(F.lower(F.translate(c, "".join(_ACCENTED), _BARE)), "[^a-z]+", " "))
    other = c.rlike(f"[^\\x00-\\x7F{''.join(_ACCENTED)}]")
    return F.coalesce(_letters_beyond_latin(F.when(other, c)), latin)


@F.pandas_udf(DoubleType())
def match_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of matching blocks; the order of the two texts matters."""
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)])
