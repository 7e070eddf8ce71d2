"""The bond cleaner and its carry-forward against plain loops, on rows made of odd cells and on the query's own rows."""

import random
import re

from folioframe.dimensions import BOND_FOOTNOTES, BOND_NOMINALS, BOND_SECTIONS, SECURITY_SCRAPS
from folioframe.plans import bond, cell_queries

DECODED = {"Ã ": "a", "Ã¨": "e", "Ã©": "e", "Ã¬": "i", "Ã²": "o", "Ã¹": "u", "â€™": "'", "â€”": "-", "â€“": "-"}


def text(s):
    for a, b in DECODED.items():
        s = s.replace(a, b)
    s = s.replace("—", "-").replace("–", "-")
    return " ".join(re.sub(r"[{}|\\\[\]]", " ", s).split()).strip(" .,:;")


def written(s):
    return [t.strip(".,") for t in re.findall(r"[0-9][0-9.,]*", s)]


def number(s, decimal=False):
    s = re.sub(r"(?<=\d)[OoC](?=\d)", "0", text(s).replace(" ", "").replace("'", "")).strip(".,;:-")
    whole = re.sub(r"\D", "", s)
    if not s or not decimal:
        return whole if s else ""
    if "," in s:
        left, _, after = s.rpartition(",")
        if not re.fullmatch(r"\d{1,2}", after):
            return whole
        return f"{re.sub(r'[^0-9]', '', left)}.{after}" if re.search(r"\d", left) else ""
    if "." in s:
        left, _, after = s.rpartition(".")
        if len(after) <= 2 and re.fullmatch(r"\d+(\.\d+)+", s):
            return f"{left.replace('.', '')}.{after}"
    return whole


def numbers(s, decimal=False):
    return [v for v in (number(t, decimal) for t in written(text(s))) if v]


def at(values, k):
    return values[k] if -len(values) <= k < len(values) else ""


def is_year(v):
    return len(v) == 4 and v.isdigit() and 1850 <= int(v) <= 2100


def year(s):
    t = text(s)
    m = re.search(r"(?<!\d)(\d{2})\s*[-/]\s*(\d{2})(?!\d)", t)
    if m:
        return "-".join(str(int(y) + (1900 if int(y) >= 30 else 2000)) for y in m.groups())
    return at([v for v in map(number, written(t)) if is_year(v)], 0)


def date(s):
    m = re.search(r"(?<!\d)(\d{1,2})\s*[-/]\s*(\d{1,2})\s*[-/]\s*(\d{2,4})(?!\d)", text(s))
    if not m:
        return ""
    d, mo, y = map(int, m.groups())
    return f"{y + 1900 if y < 100 else y:04d}-{mo:02d}-{d:02d}" if 1 <= d <= 31 and 1 <= mo <= 12 else ""


def name(s):
    s = re.sub("^[^A-Za-z0-9]+", "", text(s))
    s = re.sub(rf"\b({'|'.join(SECURITY_SCRAPS)})\b", " ", s, flags=re.I)
    return re.sub(r"\s+", " ", s).strip(" .,:;-")


def left_fields(raw):
    found, tokens = ["", "", ""], written(text(raw))[:8]
    if len(tokens) < 3:
        return found
    for k, t in enumerate(tokens[:5]):
        v, after = number(t), number(tokens[k + 1]) if k + 1 < len(tokens) else ""
        if not v:
            continue
        if not found[0] and v not in BOND_NOMINALS and not is_year(v) and ("." in t or len(v) >= 5):
            found[0] = v
        elif not found[1] and v in BOND_NOMINALS:
            found[1] = v
        elif not found[1] and after and v + after in BOND_NOMINALS:
            found[1] = v + after
        elif found[1] and (year(t) or is_year(v)):
            found[2] = year(t) or v
            break
    return found


def price(cell, quantity):
    t, values = text(cell), numbers(cell, True)
    n = len(values)
    two = n == 2 and re.fullmatch(r"\D*\d{1,3}\s+\d{1,2}\D*", t) and "," not in t and "-" not in t
    slash = not two and n >= 3 and "/" in t
    given, last = at(numbers(quantity), 0), number(at(values, -1))
    taken = not given and (slash or (n > 1 and last and ("/" in t or re.search(r"\bm\b", t, re.I))))
    split = f"{number(values[0])}.{number(values[1]).rjust(2, '0')}" if two or slash else None
    processing = ["price_decimal_split_from_ocr_tokens"] * bool(split) + ["quantity_split_from_price_cell"] * bool(taken)
    return split or at(values, 0), last if taken else given, n > 1, processing


def plain(row):
    r = {k: "" if row.get(k) is None else str(row[k]) for k in [*bond.RAW, "raw_text", "record_type", "record_role", "section", "mean_conf"]}
    low = text(r["raw_text"]).lower()
    kind, role = r["record_type"], r["record_role"]
    if kind == "section_heading" or (any(s in low for s in BOND_SECTIONS) and len(written(low)) <= 2):
        kind = role = "section_heading"
    elif any(s in low for s in BOND_FOOTNOTES):
        kind, role = "other_text", "footnote_text"
    first = lambda n, d=False: at(numbers(r[n], d), 0)
    out = {"security_name_clean": name(r["security_name_raw"]), "maturity_year": year(r["maturity_year_raw"]), "extraction_period": text(r["extraction_period_raw"]), "godimento": text(r["godimento_raw"]), "coupon_date": date(r["coupon_date_raw"])}
    for f, d in (("capital_in_circulation", False), ("nominal_value", False), ("coupon_net_amount", True), ("coupon_number", False), ("compensation_price", True), ("price_min", True), ("price_max", True)):
        out[f] = first(f"{f}_raw", d)
    for f in ("capital_in_circulation", "nominal_value"):
        out[f"{f}_extra"] = at(numbers(r[f"{f}_raw"]), 1)
    for f, v in zip(bond.LEFT, left_fields(r["raw_text"])):
        out[f"{f}_inferred"] = v
    out["price_close"], out["quantity_traded"], merged, processing = price(r["price_close_raw"], r["quantity_traded_raw"])
    out["price_close_filled"], out["price_close_fill_source"] = out["price_close"], "ocr" if out["price_close"] else ""
    for f in ("price_max", "price_min"):
        if not out["price_close_filled"] and not out["price_close_fill_source"] and out[f]:
            out["price_close_filled"], out["price_close_fill_source"] = at(numbers(r[f"{f}_raw"], True), -1), f"inferred_from_{f}"
            processing = [*processing, f"price_close_inferred_from_{f}"]
    raw_name, clean = text(r["security_name_raw"]), out["security_name_clean"]
    bare = not "".join(text(r[n]) for n in bond.RAW[:5]).strip()
    more = bool(re.match(r"[»\"'`.,;:\-\s]+", raw_name) or (clean and len(clean) <= 8 and re.search('[%»"]', raw_name)) or (bare and clean))
    flags = []
    if kind == "candidate_record":
        role = "candidate_continuation" if more else role
        several = lambda n: len(written(text(r[n]))) > 1
        conf = float(r["mean_conf"]) if re.fullmatch(r"\d+(\.\d+)?", r["mean_conf"]) else None
        prices = re.sub(r"[-—–_.,;:\s]+", "", text(" ".join(r[n] for n in bond.RAW[10:])))
        cases = {
            "possible_left_column_merge": several("capital_in_circulation_raw") or several("nominal_value_raw"),
            "possible_price_column_merge": several("price_close_raw") or merged,
            "low_mean_ocr_confidence": conf is not None and conf < 55,
            "missing_close_price": not out["price_close"] and not out["price_close_filled"] and prices,
            "missing_key_left_fields": not more and sum(not out[f] for f in bond.LEFT) >= 2,
            "missing_security_name": not clean,
        }
        flags = sorted(f for f, on in cases.items() if on)
    return out | {"record_type": kind, "record_role": role, "validation_flags": flags, "processing_flags": sorted(set(processing))}


def carried(rows):
    """Cleaned rows of one sample in order, with what they take over."""
    last, out = {}, []
    for r in rows:
        r = dict(r) | {"validation_flags": list(r["validation_flags"]), "processing_flags": set(r["processing_flags"])}
        candidate, more = r["record_type"] == "candidate_record", r["record_role"] == "candidate_continuation"
        known = sum(bool(r[f]) for f in bond.LEFT)
        took = False
        for f in bond.FILLABLE:
            may = more or f in ("extraction_period", "godimento") or (f == "security_name_clean" and known >= 2)
            take = bool(candidate and not r[f] and last.get(f) and may)
            r[f"{f}_filled"], r[f"{f}_fill_source"] = (last[f], "carry_forward") if take else (r[f], "ocr" if r[f] else "")
            took |= take
        if took:
            r["processing_flags"].add("used_carry_forward")
        if r["security_name_clean_fill_source"] == "carry_forward":
            r["processing_flags"].add("security_name_carried_forward")
        enough = lambda: sum(bool(r[f"{f}_filled"]) for f in bond.LEFT) >= 2
        gone = {"missing_key_left_fields"} if candidate and enough() else set()
        gone |= {"missing_security_name"} if candidate and r["security_name_clean_filled"] and enough() else set()
        guessed = [f for f in bond.LEFT if candidate and not r[f"{f}_filled"] and r[f"{f}_inferred"]]
        for f in guessed:
            r[f"{f}_filled"], r[f"{f}_fill_source"] = r[f"{f}_inferred"], "inferred_from_raw_row"
        if guessed:
            r["processing_flags"].add("left_fields_inferred_from_raw_row")
            gone |= {"missing_key_left_fields"} if enough() else set()
        r["validation_flags"] = [x for x in r["validation_flags"] if x not in gone]
        r["processing_flags"] = sorted(r["processing_flags"])
        for f in bond.FILLABLE:
            if candidate and r[f]:
                last[f] = r[f]
        out.append(r)
    return out


CELLS = {
    "capital_in_circulation_raw": ["", "1.500.000", "12.000 500", "x", "3O0.000", None],
    "nominal_value_raw": ["", "1000", "500 100", "l000", "2.500"],
    "maturity_year_raw": ["", "1965", "55-72", "48/29", "1700", "19 65"],
    "extraction_period_raw": ["", "genn. {lug}", "—"],
    "godimento_raw": ["", "1 lug", "Ã¨ ora"],
    "coupon_date_raw": ["", "1-7-50", "31/12/1949", "40-1-50"],
    "coupon_net_amount_raw": ["", "12,50", "1.250,5", "7.5", ",5"],
    "coupon_number_raw": ["", "14", "14 15"],
    "compensation_price_raw": ["", "98,75", "100"],
    "security_name_raw": ["", "Ferrovie 5 %", "» Roma", "eee Milano rrr", "5% »", "- id.", "Credito Fond. â€” Napoli"],
    "price_min_raw": ["", "97,10", "96 97,2"],
    "price_max_raw": ["", "98,20 99", "98"],
    "price_close_raw": ["", "98 50", "98,50", "97 50 / 300", "99/200", "1 m 5", "—", "98-50 7", "101 5"],
    "quantity_traded_raw": ["", "300", "1.000"],
    "record_type": ["candidate_record", "candidate_record", "candidate_record", "section_heading", "other_text"],
    "record_role": ["candidate_main", "other"],
    "mean_conf": ["", "40.5", "80", "n"],
    "raw_text": ["", "1.500.000 1000 1965 Ferrovie", "Titoli a reddito fisso", "diritto a voto 12", "12.000 5 00 60-70 x", "7 8 9", "300.000 2 500 1888 1950 5", "diversi 1 2 3", "10.000 150 1,2 1960"],
}


def made(n, seed):
    rng = random.Random(seed)
    return [{"sample_id": k // 12, "record_index": k % 12, "section": "s", **{c: rng.choice(v) for c, v in CELLS.items()}} for k in range(n)]


def check(spark, df, rows):
    cleaned = {(r.sample_id, r.record_index): r.asDict() for r in bond.clean(df, ["sample_id", "record_index"]).collect()}
    want = {(r["sample_id"], r["record_index"]): plain(r) for r in rows}
    assert cleaned.keys() == want.keys()
    for k, w in want.items():
        assert {f: cleaned[k][f] for f in w} == w, rows[0]
    filled = {(r.sample_id, r.record_index): r.asDict() for r in bond.carry_forward(bond.clean(df, ["sample_id", "record_index"])).collect()}
    for sample in {k[0] for k in want}:
        keys = sorted(k for k in want if k[0] == sample)
        for k, w in zip(keys, carried([want[k] for k in keys])):
            assert {f: filled[k][f] for f in w} == w, k
    return want


def test_odd_cells_equal_plain_loops(spark):
    rows = made(1500, 4)
    schema = "sample_id long, record_index long, section string, " + ", ".join(f"{c} string" for c in CELLS)
    want = check(spark, spark.createDataFrame([tuple(r.values()) for r in rows], schema), rows)
    flags = {f for w in want.values() for f in [*w["validation_flags"], *w["processing_flags"]]}
    assert len(flags) == 10 and {w["record_role"] for w in want.values()} >= {"candidate_continuation", "section_heading", "footnote_text"}


def test_the_query_equals_plain_loops(spark):
    df = cell_queries.bond_rows(spark, "/root/testdata/sf0.001").cache()
    check(spark, df, [r.asDict() for r in df.collect()])
    df.unpersist()
