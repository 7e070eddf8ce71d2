"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

A finding has a kind, a start and an end (code points, end exclusive) and a score. Kinds e-mail, ip, card and phone
follow fixed patterns; their findings are always reported, with a score. The kinds iban, local_phone and national_id
are reported only when checksum, shape and the words just before them lift their score to ACCEPT.

Edge cases: a null or empty text has no finding; texts of any length are scanned in time linear in their length (but
for the sort of their findings), and numbers of any length are read; a span of a further kind that overlaps one of
an earlier kind is left out; repeated rows and null ids each get their own row; an empty table gives an empty result;
further columns, of any name, pass through redact().
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioframe.llm.shared import table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "local_phone", "national_id")
ACCEPT = 0.6
#: Code points before a span in which context words count.
CONTEXT = 48

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits in which no match begins at its first digit has none that begins later in it, hence the look-behinds.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20./-])[0-9]{3,4}[\x20.-]?[0-9]{3,5}(?![0-9A-Za-z.-])")
_NATIONAL = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")
_DIGIT = re.compile(r"[0-9]")

#: kind: score of a bare match, of a checksum or shape that holds, of a context word before it.
SCORES = {"email": (0.8, 0.1, 0.1), "ip": (0.5, 0.2, 0.2), "card": (0.3, 0.5, 0.2), "phone": (0.5, 0.2, 0.2), "iban": (0.1, 0.7, 0.2), "local_phone": (0.1, 0.2, 0.4), "national_id": (0.1, 0.2, 0.4)}
WORDS = {
    "email": re.compile(r"mail|contact|write|courriel|correo|kontakt", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|adresse|direcci", re.I),
    "card": re.compile(r"card|visa|master|credit|payment|carte|tarjeta|karte|zahlung", re.I),
    "phone": re.compile(r"phone|tel\b|tel\.|call|mobile|fax|whatsapp|anruf|appel|llam", re.I),
    "iban": re.compile(r"iban|account|bank|konto|compte|cuenta", re.I),
    "local_phone": re.compile(r"phone|\btel\b|\bcall\b|mobile|\bfax\b|whatsapp|telefon|téléphone|teléfono", re.I),
    "national_id": re.compile(r"\bssn\b|social security|national id|\bid number|sécurité sociale|sozialversicherung", re.I),
}


def luhn(digits: str) -> bool:
    """The weighted digit sum of a card number is a multiple of ten."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if k % 2 == 0 else x * 2 - 9 * (x > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064: the rearranged number leaves the rest 1."""
    x = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain, without looking at any character more than a few times."""
    done, at = 0, text.find("@")
    while at >= 0:
        part = text[done:at]
        start = at - (len(part) - len(part.rstrip(_LOCAL)))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def base_findings(text: str) -> list[tuple[str, int, int]]:
    """Findings of the fixed patterns, kinds in order and then by start."""
    found = []
    if "@" in text:
        found += [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(q := p.lstrip("0")) < 4 and int(q or "0") <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
        if "+" in text:
            found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


def _confirmed(kind: str, span: str) -> bool:
    digits = [c for c in span if "0" <= c <= "9"]
    if kind == "card":
        return luhn("".join(digits))
    if kind == "iban":
        return mod97(span)
    if kind == "national_id":
        area, group, serial = span.split("-")
        return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "local_phone":
        return 9 <= len(digits) <= 12
    return True


def score(text: str, kind: str, start: int, end: int) -> float:
    """0 to 1: the pattern's own score, its checksum or shape, and a context word in the code points before it."""
    bare, check, near = SCORES[kind]
    return min(1.0, bare + check * _confirmed(kind, text[start:end]) + near * bool(WORDS[kind].search(text, max(0, start - CONTEXT), start)))


def _apart(spans: list[tuple[int, int]], taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The spans that overlap none of those taken, both in order of their starts, in one pass over either."""
    k, reach = 0, 0
    for a, b in spans:
        while k < len(taken) and taken[k][0] < b:
            reach = max(reach, taken[k][1])
            k += 1
        if reach <= a:
            yield a, b


def findings(text: str | None) -> list[tuple[str, int, int, float]]:
    """All findings of a text with their scores, kinds in order and then by start."""
    if not text:
        return []
    base = base_findings(text)
    found = [(k, a, b, score(text, k, a, b)) for k, a, b in base]
    if _DIGIT.search(text):
        for kind, pattern in (("iban", _IBAN), ("local_phone", _LOCAL_PHONE), ("national_id", _NATIONAL)):
            for a, b in _apart([m.span() for m in pattern.finditer(text)], sorted((a, b) for _, a, b, _ in found)):
                if (s := score(text, kind, a, b)) >= ACCEPT and _confirmed(kind, text[a:b]):
                    found.append((kind, a, b, s))
    return found


FINDING = "array<struct<kind:string,start:int,end:int,score:double>>"


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def find(docs: DataFrame) -> DataFrame:
    """doc_id and text of docs with the array findings."""
    schema = T.StructType([docs.schema["doc_id"], docs.schema["text"], T.StructField("findings", T._parse_datatype_string(FINDING))])

    def each(batches):
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b, "score": s} for k, a, b, s in findings(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, _arrow(schema["findings"].dataType))], names=["doc_id", "text", "findings"])

    return docs.select("doc_id", "text").mapInArrow(each, schema)


def redacted(text: str | None) -> str | None:
    """text with every finding replaced by its kind in angle brackets; of overlapping findings the first stands."""
    if not text:
        return text
    out, at = [], 0
    for kind, a, b, _ in sorted(findings(text), key=lambda x: (x[1], -x[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """docs with personal data in text replaced and n_chars (where there is one) counted anew."""
    place = docs.columns.index("text")

    def each(batches):
        for batch in batches:
            texts = pa.array([redacted(t) for t in batch.column(place).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([texts if i == place else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    out = docs.mapInArrow(each, T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema]))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def _joined(found: list[tuple]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in sorted(found, key=lambda x: (KINDS.index(x[0]), x[1])))


DIGEST = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, scores string"


def digest(docs: DataFrame) -> DataFrame:
    """One row for each document: counts by kind, all spans and their scores."""

    def each(batches):
        for batch in batches:
            rows = [findings(t) for t in batch.column(1).to_pylist()]
            base = [[x for x in r if x[0] in BASE_KINDS] for r in rows]
            counts = [pa.array([sum(x[0] == k for x in r) for r in base], pa.int64()) for k in BASE_KINDS]
            texts = [[hashlib.sha256(_joined(r).encode()).hexdigest() for r in base], [_joined(r) for r in rows], [",".join(f"{x[3]:.2f}" for x in sorted(r, key=lambda x: (KINDS.index(x[0]), x[1]))) for r in rows]]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *counts, *[pa.array(x, pa.string()) for x in texts]], names=["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "scores"])

    return docs.select("doc_id", "text").mapInArrow(each, DIGEST)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
