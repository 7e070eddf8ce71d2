"""Splitting texts into the pieces that byte-pair merges stay within.

Texts of Latin letters only, the most common case, go through the standard library's regular expressions, which agree
there with the tokenizer's own pre-tokenizer (tests compare every character); all others go through the latter.
"""

from __future__ import annotations

import re
import unicodedata

from tokenizers import Tokenizer

#: Anything that the two may treat differently: beyond Latin Extended-B, other digits and letters, rare white space.
_OTHER = re.compile("[\x1c-\x1f\x85\xa0\xaa\xb2\xb3\xb9\xba\xbc-\xbeƻǀ-ǃɐ-\U0010ffff]")
#: Characters that the normal form may reorder, or join with the letter before them.
_MARK = re.compile("[" + "".join(chr(c) for c in range(0x300, 0x1F000) if unicodedata.combining(chr(c))) + "]")
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d"
_BYTE_LATIN = re.compile(_CUT + r"| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_WORD_LATIN = re.compile(_CUT + r"|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


def is_latin(text: str) -> bool:
    """No character of the text is one that the two may treat differently."""
    if text.isascii():
        return not any(c in text for c in "\x1c\x1d\x1e\x1f")
    return _OTHER.search(text) is None


def byte_pieces(text: str, tokenizer: Tokenizer) -> list[str]:
    """Pieces of byte-level vocabularies; together they are the text."""
    if is_latin(text):
        return _BYTE_LATIN.findall(text)
    return [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def normalised(text: str, tokenizer: Tokenizer) -> tuple[str, bool] | None:
    """The text as the tokenizer's pieces see it: lower-cased, and beyond Latin letters in its normal form; and whether
    it is of Latin letters then. None if to normalise the result again would change it, as then pieces can't be
    encoded on their own: small letters join with marks that capitals don't (only marks can do that)."""
    if text.isascii():
        return text.lower(), is_latin(text)
    if is_latin(text):
        low = text.lower()
        return low, is_latin(low)
    seen = tokenizer.normalizer.normalize_str(text)
    if _MARK.search(seen) and tokenizer.normalizer.normalize_str(seen) != seen:
        return None
    return seen, False


def words(text: str, latin: bool, tokenizer: Tokenizer) -> list[str]:
    """Runs without white space of a normalised text, which pieces never reach beyond; beyond Latin letters, the pieces."""
    if latin:
        return text.split()
    return [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def count_pieces(word: str, tokenizer: Tokenizer) -> int:
    """How many pieces a word has."""
    return len(_WORD_LATIN.findall(word)) if is_latin(word) else len(tokenizer.pre_tokenizer.pre_tokenize_str(word))
