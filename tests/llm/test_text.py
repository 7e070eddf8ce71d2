"""Personal data against plain patterns, and byte-pair coding against the library, on random texts."""

import random
import re
import time
import unicodedata
import zlib

import numpy as np
from tokenizers import Tokenizer

from folioframe.llm import bpe, pii, pretoken, token_files


def plain_findings(text):
    """The fixed kinds by their patterns as they are written."""
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = digits(m[0])
        total = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d)))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15]
    return out


def test_fixed_kinds_equal_plain_patterns():
    rng = random.Random(8)
    parts = ["a", "@", ".", "b.c", "1", "12", "255", "256", "007", ".", "-", " ", "+", "(", ")", "4111 1111 1111 1111", "5500005555555559", "é", "\n", "+49 30", "mail", "0" * 30]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 24)))
        assert pii.base_findings(text) == plain_findings(text), text


def plain_more(text):
    """The further kinds, kind by kind: matches that overlap nothing found before, with checksum or shape and enough score."""
    found = plain_findings(text)
    taken = [(a, b) for _, a, b in found]
    out = []
    for kind, pattern in (("iban", pii._IBAN), ("local_phone", pii._LOCAL_PHONE), ("national_id", pii._NATIONAL)):
        new = []
        for m in re.finditer(pattern.pattern, text):
            a, b = m.span()
            if any(x < b and a < y for x, y in taken):
                continue
            d = re.sub("[^0-9]", "", m[0])
            if kind == "iban":
                turned = m[0].replace(" ", "")
                rest = 0
                for c in turned[4:] + turned[:4]:
                    for digit in str(int(c, 36)):
                        rest = (rest * 10 + int(digit)) % 97
                ok = rest == 1
            elif kind == "local_phone":
                ok = 9 <= len(d) <= 12
            else:
                ok = d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
            bare, check, near = pii.SCORES[kind]
            word = re.search(pii.WORDS[kind].pattern, text[max(0, a - pii.CONTEXT) : a], re.I)
            if ok and bare + check + near * bool(word) >= pii.ACCEPT:
                new.append((kind, a, b))
        taken += [(a, b) for _, a, b in new]
        out += new
    return out


def test_further_kinds_equal_a_plain_version():
    rng = random.Random(18)
    bits = ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "DE88370400440532013000", "030 1234 5678", "(030) 123-4567", "0301-234-567", "123-45-6789", "000-12-3456", "900-12-3456", "Phone", "tel", "ssn", "konto", "call", " ", " ", " ", ": ", "\n", "x", "1", "a@b.cd", "10.0.0.1", "4111 1111 1111 1111", "+49 30 1234567", "é", "word word word word word word word word word word"]
    seen = set()
    for _ in range(12_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))
        got = [f[:3] for f in pii.findings(text) if f[0] not in pii.BASE_KINDS]
        assert got == plain_more(text), text
        seen |= {k for k, *_ in got}
    assert seen == {"iban", "local_phone", "national_id"}


def test_long_numbers_and_many_findings_take_linear_time():
    assert pii.findings("0" * 5000 + ".1.1.1")[0][:3] == ("ip", 0, 5006)
    assert not pii.findings("9" * 5000 + ".1.1.1 " + "1" * 5000)
    took = []
    for n in (4_000, 16_000):
        text = "a@b.cd ssn 123-45-6789 " * n
        began = time.time()
        assert len(pii.findings(text)) == 2 * n
        took.append(time.time() - began)
    assert took[1] < 12 * took[0] + 0.2


def test_later_kinds_stay_off_taken_spans():
    spans = list(pii._apart([(0, 4), (5, 9), (10, 12), (20, 30)], [(1, 2), (3, 11), (30, 31)]))
    assert spans == [(20, 30)]


def test_latin_pieces_equal_the_library_for_every_character():
    byte, word = (Tokenizer.from_file(bpe.vocabulary(f)) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    for c in map(chr, [*range(1, 0xD800), *range(0xE000, 0x10000)]):
        text = f"a{c}b {c}1{c} '{c}s{c}{c}"
        if pretoken.is_latin(text):
            assert pretoken.byte_pieces(text, byte) == [text[a:b] for _, (a, b) in byte.pre_tokenizer.pre_tokenize_str(text)], ascii(c)
            low, latin = pretoken.normalised(text, word)
            assert low == word.normalizer.normalize_str(text) or c.isspace(), ascii(c)
            if not latin:  # a dotted capital I becomes two characters; then the words are the pieces
                assert pretoken.words(low, latin, word) == [low[a:b] for _, (a, b) in word.pre_tokenizer.pre_tokenize_str(low)]
                continue
            assert [pretoken.count_pieces(w, word) for w in pretoken.words(low, latin, word)] == [len(word.pre_tokenizer.pre_tokenize_str(w)) for w in low.split()], ascii(c)


def test_special_tokens_count_in_their_own_case_only():
    t = Tokenizer.from_file(bpe.vocabulary("word_bpe_49k.json"))
    encoder = token_files.WordEncoder(bpe.read_definition(bpe.vocabulary("word_bpe_49k.json")))
    special = encoder.special
    rng = random.Random(9)
    forms = [f(s) for s in special for f in (str, str.upper, str.title, str.swapcase)]
    texts = ["Yß<|StartOfText|>", "<|ENDOFTEXT|>", "日本<|EndOfText|>語", *forms, *(rng.choice(["a ", "é", "x", "語 "]).join(rng.sample(forms, 2)) for _ in range(40))]
    for text, got in zip(texts, encoder.encode_batch(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_texts_whose_normal_form_is_not_final():
    """Capitals that take marks differently from their small letters, beside marks of every class."""
    path = bpe.vocabulary("word_bpe_49k.json")
    t, encoder = Tokenizer.from_file(path), token_files.WordEncoder(bpe.read_definition(path))
    marks = {unicodedata.combining(c): c for c in map(chr, range(0x300, 0x1F000)) if unicodedata.combining(c)}
    letters = ["İ", "i", "J", "H", "T", "W", "Y", "Ϋ", "Ά", "Ω", "ſ", "K", "가", "ᄀ", "ᅡ", "é", "日", "a", " ", "क", "1", "-"]
    rng = random.Random(11)
    pool = [*letters, *marks.values(), *"\u030c\u0331\u0308\u030a\u0301\u0342\u0345\u0307\u094d\u093c"]
    texts = ["İ्", *(a + b + c for a in letters for b in marks.values() for c in rng.sample(pool, 3))]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randrange(2, 12))) for _ in range(40_000)]
    changed = sum(pretoken.normalised(x, t) is None for x in texts)
    assert changed > 100
    for k in range(0, len(texts), 512):
        part = texts[k : k + 512]
        for text, got, want in zip(part, encoder.encode_batch(part), t.encode_batch(part, add_special_tokens=False), strict=True):
            assert np.frombuffer(got, "<u4").tolist() == want.ids, ascii(text)


def test_documents_of_several_blocks(spark, tmp_path):
    path = bpe.vocabulary("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["ab", "cde", "f1", "ghij"]) for _ in range(n)) for n in (3, 150_000, 10, 70_000)]
    folder = f"file://{tmp_path}/ids"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    got = {r.doc_id: r for r in token_files.read_files(spark, token_files.write_files(spark, docs, path, folder), folder).collect()}
    for k, text in enumerate(texts):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert (got[k].n_tokens, got[k].ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
    assert got[1].n_tokens > 2 * token_files.BLOCK
