"""What a row costs: steps that are computed once stand once in the plan, and shorter forms give what the longer ones gave."""

import random
import re

import pytest
from pyspark.sql import functions as F

from folioframe.functions import numbers as N
from folioframe.plans import cell_queries as C
from folioframe.plans import word_queries as Q

SF = "/root/testdata/sf0.001"


def _times(df, what):
    return df._jdf.queryExecution().optimizedPlan().toString().count(what)


def test_fallbacks_find_numbers_once(spark):
    assert _times(C.identity_fallbacks(spark, SF), "regexp_extract_all(") <= 3


def test_lines_of_a_tsv_are_split_once(spark):
    assert _times(Q.tsv_word_parse(spark, SF), "concat_ws(") == 1


def test_references_are_one_constant(spark):
    """Not a branch for each name, whose code is too long to be compiled."""
    assert _times(C.issuer_reference_match(spark, SF), "array_intersect(") == 0
    assert _times(C.issuer_reference_match(spark, SF), "lower(") == 1


def test_values_of_tokens_equal_those_of_any_text(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("0012359.,, -–€Cl/'") for _ in range(rng.randint(0, 22))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    pairs = []
    for d in (False, True):
        pairs += [F.transform(N.number_tokens(F.col("t")), lambda t: F.struct(N.token_value(t, d).alias("a"), N.parse_number(t, d).alias("b"))), F.transform(N.plain_tokens(F.col("t")), lambda t: F.struct(N.plain_value(t, d).alias("a"), N.parse_bond_number(t, d).alias("b")))]
    found = df.select(F.explode(F.concat(*pairs)).alias("x"))
    assert found.count() > 10000 and not found.where("x.a != x.b").count()


def test_kinds_of_numbers_equal_comparisons(spark):
    values = [str(n) for n in range(25000)] + ["0" * 9 + "300", "0025", "500000", "500001", "0" * 40 + "10000", "9" * 38, "1" + "0" * 38, "", "12.5", "x1"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    n = F.when(F.col("v").rlike(r"^\d+$"), F.col("v").try_cast("decimal(38,0)"))
    v, true = F.col("v"), lambda c: F.coalesce(c, F.lit(False))
    same = [(N.is_large(v), n >= 10000), (N.is_identity_amount(v), n >= 1000), (N.is_suspicious(v), n.between(1, 30)), (N.is_quantity(v), n.between(1, 500000)), (N.is_up_to_thirty(v), n <= 30), (N.is_nominal(v), n.isin(N.NOMINALS) | (n.between(25, 20000) & (n % 25 == 0))), (F.size(N.over_thirty(F.array(v))) == 1, n > 30)]
    for a, b in same:
        assert not df.where(a != true(b)).count()


def test_the_left_of_a_bond_row_finds_numbers_once(spark):
    assert _times(C.bond_left_infer(spark, SF), "regexp_extract_all(") <= 3


def test_bond_cells_are_mended_once(spark):
    assert _times(C.bond_clean(spark, SF), "â€™") <= 25
    assert _times(C.bond_carry_forward(spark, SF), "â€™") <= 25


def test_flags_are_made_in_one_step(spark):
    assert _times(C.equity_clean(spark, SF), "array_distinct(") <= 1
    assert _times(C.equity_clean(spark, SF), "translate(") <= 14


def test_no_text_is_mended_for_each_name_it_is_looked_for(spark):
    """Spark copies what is used once into a function of array items: there it would be done for each of them."""
    fields = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(fields)
    spark.conf.set(fields, "10000")
    try:
        plan = C.equity_clean(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(fields, before)
    assert not re.search(r"lambdafunction\((?i:contains)\((?:trim|lower|regexp_replace|translate)\(", plan)


def test_mended_texts_equal_single_replacements(spark):
    """ASCII texts pass by the replacements, others take one for both; names are held as they were one by one."""
    from folioframe.functions import dates as D
    from folioframe.functions import text as T

    rng = random.Random(5)
    texts = ["".join(rng.choice("aZ 0—ЧСТАлàÀéÈìÌòÒùÙ’'-\n\t\u00a0") for _ in range(rng.randint(0, 9))) + rng.choice(["", "", "Marzo", " sett", "DIVERSI", "ma r"]) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    ocr = F.translate(t, "‐‑‒–—−ЧСТАл", "-------CTAl")
    squeezed = F.regexp_replace(F.regexp_replace(F.translate(ocr, "{}|\\[]", " " * 6), r"(?U)\s+", " "), "^ | $", "")
    looked = F.btrim(F.regexp_replace(F.translate(F.lower(ocr), "àèéìòù’", "aeeiou'"), "[^a-z0-9]+", " "))
    month = F.exists(F.array(*[F.lit(k) for k, _ in D.MONTHS]), lambda k: F.contains(F.lower(t), k))
    for a, b in ((T.ocr_text(t), ocr), (T.clean_text(t), squeezed), (T.lookup_text(t), looked), (D.has_month(t), month), (T.holds_any(F.lower(t), [k for k, _ in D.MONTHS]), month)):
        assert not df.where(~a.eqNullSafe(b)).count()


@pytest.mark.parametrize("name", ["words_to_lines", "row_records", "typed_cells", "line_types", "page_text", "parse_summary", "text_page_rows", "row_noise_signal", "cells_pivot", "merged_rules", "body_fraction_words", "row_cluster", "issuer_anchor_rows", "bond_anchor_split", "page_components"])
def test_texts_are_shuffled_and_not_their_words(spark, name):
    plan = Q.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange hashpartitioning") > plan.rindex("Generate ")


def test_page_parts_grow_with_the_input(spark):
    """So that one task's words don't: no count that is fixed, none that is merged again."""
    plan = Q.strip_band_join(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and plan.count("Exchange hashpartitioning") == 2


def test_headings_of_pages_are_constants(spark):
    from folioframe.sources.views import page_words

    assert _times(page_words(spark, SF), "initcap(") == 0


def test_words_meet_the_bands_of_their_page_without_another_shuffle(spark):
    """As they do where tables are too large for a broadcast."""
    least = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(least)
    spark.conf.set(least, "-1")
    try:
        plan = Q.backup_cell_texts(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(least, before)
    shuffles = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    assert shuffles and all("REPARTITION_BY_NUM" in x for x in shuffles)


def test_words_of_a_top_are_counted_before_they_look_for_the_nearest_anchor(spark):
    """And texts are shuffled, not their words."""
    df = Q.nearest_anchor(spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "Aggregate" in plan[plan.index("Union"):]
    assert "REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString()


def test_words_of_a_top_are_counted_before_they_look_for_an_anchor(spark):
    plan = Q.asof_anchor(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "Aggregate" in plan[plan.index("Union"):]


@pytest.mark.parametrize("name", ["row_cluster", "issuer_anchor_rows", "bond_anchor_split"])
def test_pages_are_arrow_tables(spark, name):
    """No data frame is made for each page, or row of it."""
    assert "FlatMapGroupsInArrow" in Q.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_cells_are_shuffled_by_page_and_not_their_words(spark):
    from folioframe.plans import parse_queries as R

    plan = R.page_anchored_rows(spark, SF)._jdf.queryExecution().executedPlan().toString()
    last = plan.index("Exchange hashpartitioning(page")
    assert "REPARTITION_BY_NUM" in plan[last:].split("\n")[0] and plan.index("Generate inline") < last


def test_diagnostics_count_rows_before_fields_and_flags_multiply_them(spark):
    df = C.column_diagnostics(spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Aggregate [validation_flags") > plan.rindex("Generate inline")
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[validation_flags" in physical and "SortAggregate(keys=[validation_flags" not in physical


def test_diagnostics_of_null_and_odd_values(spark):
    """Against plain counts; equal counts of flags go by the first row, whatever the type and sign of its key."""
    from folioframe.operators import review as R

    low, high = -(1 << 63), (1 << 63) - 1
    data = [(high, 2, None, "a", ["missing_issuer"]), (low, 9, " ", None, ["text_in_close", "text_in_close"]), (low, -1, "", "b", ["issuer_inherited"]), (None, 5, "x", " ", ["text_in_compensation"]), (7, None, "x", "y", []), (8, 1, "x", "y", None)]
    for key in ("bigint", "string"):
        rows = spark.createDataFrame(data, "sample_id bigint, row_index bigint, issuer_name_clean string, issuer_name_raw string, validation_flags array<string>").withColumn("sample_id", F.col("sample_id").cast(key))
        (r,) = R.column_diagnostics(rows).collect()
        assert (r.total_rows, r.empty_clean, r.empty_raw, r.raw_present_clean_empty, r.clean_present_raw_empty, r.field_flagged_rows, r.field_review_rows, r.rescued_or_inherited_rows) == (5, 2, 1, 1, 1, 4, 1, 1)
        first = [("text_in_compensation", (0,)), *sorted([("missing_issuer", (1, str(high) if key == "string" else high, 2)), ("text_in_close", (1, str(low) if key == "string" else low, 9)), ("issuer_inherited", (1, str(low) if key == "string" else low, -1))], key=lambda x: x[1])]
        assert r.top_field_flags == "; ".join(f"{f}:1" for f, _ in first)
