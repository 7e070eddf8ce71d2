"""Quality rules: fences that follow their group, and edge cases."""

import random

from folioframe.llm import quality_rules


def text(rng, symbols):
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    for at in rng.sample(range(200), symbols):
        words[at] = words[at][:4] + "#"
    return " ".join(words)


def test_fences_follow_the_spread_of_their_group(spark):
    rng = random.Random(3)
    rows = [(k, text(rng, rng.randrange(0, 3)), "en", "prose") for k in range(400)]
    rows += [(1000 + k, text(rng, rng.randrange(0, 120)), "en", "tables") for k in range(400)]
    rows += [(2000 + k, text(rng, 100), "en", source) for k, source in enumerate(("prose", "tables"))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(spark, docs).collect()}
    assert not kept[2000] and kept[2001]  # the same share of symbols
    assert sum(kept[k] for k in range(400)) >= 396 and sum(kept[1000 + k] for k in range(400)) >= 396
    fence = {r.source: r.fence_symbol_pm for r in quality_rules.thresholds(spark, quality_rules.measure(docs)).collect()}
    assert fence["prose"] < 100 < fence["tables"]


def test_small_groups_are_drawn_to_the_wider_one(spark):
    rng = random.Random(5)
    rows = [(k, text(rng, rng.randrange(0, 40)), "en", f"big{k % 4}") for k in range(800)] + [(900 + k, text(rng, 0), "en", "small") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    measured = quality_rules.measure(docs)
    fence = [{r.source: r.fence_symbol_pm for r in quality_rules.thresholds(spark, measured, prior=p).collect()} for p in (1, 100, 10_000)]
    assert fence[0]["small"] < fence[1]["small"] < fence[2]["small"] <= max(fence[2].values())


def test_edge_cases(spark):
    rng = random.Random(7)
    long = text(rng, 1)
    rows = [(1, None, None, None), (2, "", "en", None), (None, long, "en", "s"), (3, long, "en", "s"), (3, long, "en", "s"), (4, " ".join([long] * 50), "en", "s"), (5, "two words", None, "s")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, lang string, source string, kept string, _row int")
    judged = quality_rules.judge(spark, docs).collect()
    assert len(judged) == len(rows) and {r.doc_id for r in judged if r.kept} == {None, 3}  # 4 repeats itself
    kept = quality_rules.filter_documents(spark, docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 3]
    none = spark.createDataFrame(rows[:2], "doc_id bigint, text string, lang string, source string")
    assert [r.kept for r in quality_rules.judge(spark, none).collect()] == [False, False]
