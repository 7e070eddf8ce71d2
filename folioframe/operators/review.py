"""Diagnostics of cleaned rows, review packets, and corrections by hand.

Cleaned rows have sample_id, row_index, section, row_role, the clean and raw fields, validation_flags (array) and
raw_row_text; missing values are ''.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.dimensions import CORRECTIONS, FIELDS, GENERIC_FLAGS

PRIORITY = ["missing_capital", "missing_nominal", "missing_issuer"]
KEY = ["sample_id", "row_index"]


def strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def flag_histogram(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("validation_flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def sample_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("sample_id").agg(F.count("*").alias("total"), F.count_if(F.col("row_role") == "security_main_row").alias("main_rows"), F.count_if(F.size("validation_flags") > 0).alias("flagged"))


def by_field(rows: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """A row for each row and field: clean and raw value, and the row's flags that concern the field."""
    have = [f for f in FIELDS if f[0] in rows.columns and f[1] in rows.columns]
    parts = [F.struct(F.lit(i).alias("pos"), F.lit(c).alias("field"), F.col(c).alias("clean"), F.col(r).alias("raw"), F.array_intersect("validation_flags", strings([*flags, *GENERIC_FLAGS])).alias("flags")) for i, (c, r, flags) in enumerate(have)]
    return rows.select(*keys, F.inline(F.array(*parts)))


def is_hard(f: Column) -> Column:
    return f.rlike("^(?:missing_|multi_value_)|(?:_ocr_noise|_needs_review)$|^(?:glued_shares_nominal_raw|probable_row_fragment|probable_split_identity_prefix)$")


def place_of(rows: DataFrame) -> Column:
    """A value in the order of a row's key: of keys of whole numbers a decimal, which a hash aggregate keeps the least of; a
    struct makes it sort. A row index is a count, so that its amount stays below 5e17; one beyond stops the query."""
    kinds = dict(rows.dtypes)
    if any(kinds[k] not in ("tinyint", "smallint", "int", "bigint") for k in KEY):
        return F.struct(*KEY)
    sample, index = (F.col(k).cast("decimal(19,0)") for k in KEY)
    ok = F.coalesce(F.abs(index) < 5 * 10**17, F.lit(True))
    low = F.when(ok, F.coalesce(index, F.lit(-5 * 10**17).cast("decimal(19,0)"))).otherwise(F.raise_error(F.lit("row_index is no count")).cast("decimal(19,0)"))
    high = F.coalesce(sample, F.lit("-9500000000000000000").cast("decimal(19,0)")) * F.lit(10**18).cast("decimal(19,0)")
    return (high + low).cast("decimal(38,0)")


def patterns(rows: DataFrame) -> DataFrame:
    """Rows as counts: for each set of flags, and of empty, null and other values of the fields, n and the first place_of() it.

    The fields that rows have stand for any value of their kind: null, '' or 'x'.
    """
    have = [f for f in FIELDS if f[0] in rows.columns and f[1] in rows.columns]
    cells = [c for f in have for c in f[:2]]
    kind = lambda c: F.coalesce(F.when(F.btrim(c) == "", 1).when(F.btrim(c).isNotNull(), 0), F.lit(2)).cast("long")
    code = reduce(lambda a, b: a + b, [kind(c) * 3**i for i, c in enumerate(cells)], F.lit(0).cast("long"))
    seen = rows.select("validation_flags", code.alias("_code"), place_of(rows).alias("_place")).groupBy("validation_flags", "_code").agg(F.count("*").alias("_n"), F.min("_place").alias("_place"))
    value = lambda i: F.element_at(F.array(F.lit("x"), F.lit(""), F.lit(None)), (F.expr(f"_code div {3**i}L % 3") + 1).cast("int"))
    return seen.select("validation_flags", "_n", "_place", *[value(i).alias(c) for i, c in enumerate(cells)])


def column_diagnostics(rows: DataFrame, most: int = 8) -> DataFrame:
    """Counts of empty, flagged, rescued and blank values of each field, with its most frequent flags.

    Rows are counted by their flags and empty values first. Each of these patterns and field gives an item for its counts
    and one for each of its flags; they are counted in one pass to a few hundred rows, from which both are read.
    """
    blank = lambda c: F.btrim(c) == ""
    cases = {
        "empty_clean": blank("clean"),
        "empty_raw": blank("raw"),
        "raw_present_clean_empty": ~blank("raw") & blank("clean"),
        "clean_present_raw_empty": ~blank("clean") & blank("raw"),
        "field_flagged_rows": F.size("flags") > 0,
        "field_review_rows": F.exists("flags", is_hard),
        "rescued_or_inherited_rows": F.exists("flags", lambda f: f.rlike("rescued|_inherited$")),
        "likely_printed_blank_rows": F.exists("flags", lambda f: f.endswith("_likely_printed_blank")),
    }
    items = by_field(patterns(rows), ["_n", "_place"]).select("field", "_n", "_place", *[c.alias(n) for n, c in cases.items()], F.explode(F.concat(strings([""]), "flags")).alias("flag"))
    count = lambda n: F.sum(F.when(F.col(n), F.col("_n")).otherwise(0))
    seen = items.groupBy("field", "flag").agg(F.sum("_n").alias("n"), F.min(F.struct(F.col("_place").alias("key"), "flag")).alias("first"), *[count(n).alias(n) for n in cases])
    own = F.col("flag") == ""
    ranked = F.array_sort(F.collect_list(F.when(~own, F.struct((-F.col("n")).alias("n"), "first", "flag"))))
    out = seen.groupBy("field").agg(F.max(F.when(own, F.col("n"))).alias("total_rows"), *[F.max(F.when(own, F.col(n))).alias(n) for n in cases], ranked.alias("_f"))
    top = F.transform(F.slice("_f", 1, most), lambda f: F.concat_ws(":", f["flag"], (-f["n"]).cast("string")))
    return out.withColumn("top_field_flags", F.array_join(top, "; ")).drop("_f")


def by_need(diagnostics: DataFrame) -> DataFrame:
    """Diagnostics with the fields first that need review most; equal ones in the order of their columns."""
    place = F.array_position(strings([c for c, _, _ in FIELDS]), F.col("field"))
    return diagnostics.orderBy(F.desc("field_review_rows"), F.desc("raw_present_clean_empty"), F.desc("empty_clean"), place)


def counted(rows: DataFrame, name: str = "run") -> tuple[DataFrame, Observation]:
    """rows, and the counters of a run over them: records, candidates, flagged and manually changed ones, which are there once the
    rows have been stored, without a pass of their own."""
    seen = Observation(name)
    flags = F.col("validation_flags")
    role = F.col("row_role")
    candidate = role.isin("security_main_row", "security_continuation_row")
    return rows.observe(seen, F.count(F.lit(1)).alias("records"), F.count_if(candidate).alias("candidates"), F.count_if(F.size(flags) > 0).alias("flagged"), F.count_if(F.array_contains(flags, "manual_corrected")).alias("corrected")), seen


def issue_examples(rows: DataFrame, most: int = 8) -> DataFrame:
    """The first rows of each field and kind of issue."""
    long = by_field(rows)
    kinds = F.array_compact(F.array(F.when(F.btrim("clean") == "", "empty_clean_value"), F.when((F.btrim("raw") != "") & (F.btrim("clean") == ""), "raw_present_but_clean_empty"), F.when(F.size("flags") > 0, "field_flag")))
    found = long.withColumn("issue_kind", F.explode(kinds))
    w = Window.partitionBy("field", "issue_kind").orderBy(*KEY)
    return found.withColumn("n", F.row_number().over(w).cast("long")).where(F.col("n") <= most).select("field", "issue_kind", *KEY, "n")


def priority_rows(rows: DataFrame) -> DataFrame:
    """Rows that miss a capital, a nominal or an issuer, with those reasons."""
    found = rows.withColumn("priority_reason", F.array_join(F.array_intersect(strings(PRIORITY), F.col("validation_flags")), ";"))
    return found.where(F.arrays_overlap("validation_flags", strings(PRIORITY)))


def problem_category(bottom: Column, height: Column) -> Column:
    """Why a row needs a look; bottom and height of its page may be unknown (null)."""
    has = lambda f: F.array_contains("validation_flags", f)
    lower = F.coalesce(bottom, F.lit(0)) / F.coalesce(height, F.lit(1)) > 0.78
    return (
        F.when(has("missing_issuer") & (F.col("row_role") == "security_continuation_row"), "continuation row needs parent context")
        .when(lower & F.arrays_overlap("validation_flags", strings(["missing_capital", "missing_nominal", "missing_shares"])), "bottom-row crowding / identity OCR loss")
        .when(has("missing_nominal") & F.col("raw_row_text").rlike("[0-9]"), "nominal validation or glued identity cells")
        .when(has("missing_capital") & (F.col("capital_subscribed") == ""), "left identity-column OCR loss")
        .when(has("missing_issuer"), "issuer text missing or continuation semantics")
        .otherwise("general high-priority identity issue")
    )


def last_of_key(rows: DataFrame, order: list[str]) -> DataFrame:
    """The last row of each key in an order."""
    w = Window.partitionBy(*KEY).orderBy(*[F.desc(o) for o in order])
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def most_common(rows: DataFrame, by: str, n: int = 15) -> DataFrame:
    """The most frequent values, of equally frequent ones the first seen."""
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.min(F.struct(*KEY)).alias("_first")).orderBy(F.desc("n"), "_first").limit(n).drop("_first")


def correction_template(priority: DataFrame) -> DataFrame:
    """The sheet that is filled in by hand: what is known, and empty columns for what is right."""
    known = ["sample_id", "row_index", "section", "row_role", "problem_category", "priority_reason", "issuer_name_clean", "capital_subscribed", "shares_outstanding", "nominal_value", "price_close", "quantity_traded"]
    blank = [*[c for c, _, _ in CORRECTIONS], "merge_target_row_index", "review_notes"]
    return priority.select(*known, F.array_join("validation_flags", ";").alias("validation_flags"), "raw_row_text", F.lit("manual_review").alias("review_action"), *[F.lit("").alias(c) for c in blank])


def corrected(rows: DataFrame, corrections: DataFrame, order: list[str]) -> DataFrame:
    """rows with their last correction applied, and log (struct: action, status, changed_fields; null without one)."""
    c = last_of_key(corrections, order).select(*KEY, F.lower(F.btrim("review_action")).alias("_a"), *[F.btrim(F.coalesce(n, F.lit(""))).alias(n) for n, _, _ in CORRECTIONS], F.btrim(F.coalesce("merge_target_row_index", F.lit(""))).alias("_target"), F.lit(True).alias("_has"))
    df = rows.join(c, KEY, "left")
    action, has = F.col("_a"), F.coalesce("_has", F.lit(False))
    valid = action.isin("", "manual_review", "keep", "exclude", "merge")
    fill = has & action.isin("keep", "merge")
    changes = {f: fill & (F.col(n) != "") & (F.col(f) != F.col(n)) for n, f, _ in CORRECTIONS}
    role = has & action.isin("exclude", "merge")
    fields = F.array_compact(F.array(F.when(role, F.lit("row_role")), *[F.when(changes[f], F.lit(f)) for _, f, _ in CORRECTIONS]))
    df = df.withColumn("_changed", F.coalesce(fields, strings([])))
    some = F.size("_changed") > 0
    gone = F.array_compact(F.array(*[F.when(fill & (F.col(n) != ""), F.lit(m)) for n, _, m in CORRECTIONS]))
    added = F.array_sort(F.array_compact(F.array(F.when(action == "exclude", F.lit("manual_exclude")), F.when(action == "merge", F.lit("manual_merge_requested")), F.when((action == "merge") & (F.col("_target") != ""), F.concat(F.lit("manual_merge_target_"), F.col("_target"))), *[F.when(changes[f], F.lit(f"manual_corrected_{f}")) for _, f, _ in CORRECTIONS], F.lit("manual_corrected"))))
    flags = F.concat(F.array_except("validation_flags", gone), F.array_except(added, F.col("validation_flags")))
    status = F.when(~valid, "invalid_action").when(some, "applied").otherwise("skipped")
    log = F.when(has, F.struct(action.alias("review_action"), status.alias("status"), F.array_join("_changed", ";").alias("changed_fields")))
    df = df.withColumns({"log": log, "_flags": F.when(some, flags).otherwise(F.col("validation_flags")), "row_role": F.when(role & (action == "exclude"), "manual_exclude").when(role, "manual_merge_requested").otherwise(F.col("row_role"))})
    df = df.withColumns({f: F.when(F.coalesce(changes[f], F.lit(False)), F.col(n)).otherwise(F.col(f)) for n, f, _ in CORRECTIONS})
    return df.withColumn("validation_flags", F.col("_flags")).select(*rows.columns, "log")


def carried(rows: DataFrame, fields: list[str], allowed: dict[str, Column], order: str = "row_index", sample: str = "sample_id") -> DataFrame:
    """rows with <field>_filled and <field>_fill_source: an empty value takes the last one read on its page if allowed."""
    w = Window.partitionBy(sample).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    last = {f: F.last(F.nullif(F.col(f), F.lit("")), ignorenulls=True).over(w) for f in fields}
    df = rows.withColumns({f"_{f}": last[f] for f in fields})
    take = {f: (F.col(f) == "") & F.col(f"_{f}").isNotNull() & allowed[f] for f in fields}
    df = df.withColumns({f"{f}_filled": F.when(take[f], F.col(f"_{f}")).otherwise(F.col(f)) for f in fields} | {f"{f}_fill_source": F.when(F.col(f) != "", "ocr").when(take[f], "carry_forward").otherwise("") for f in fields})
    return df.drop(*[f"_{f}" for f in fields])


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
