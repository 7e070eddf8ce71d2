"""Quality rules with thresholds read from mergeable quantile sketches.

Each document gets integer measures of its whole text, each a count in so many units of the text. A sketch of a measure
is a histogram of the shares, whose bins are exact up to 31 and then 16 to each power of two, so a quantile read from it
is at most 1/16 too high. Sketches merge by adding counts: Spark's partial aggregation builds one for each language and
source, of the documents that pass the base rules, and adding those gives the sketches of a language and of the corpus.

The upper fence of a measure is its upper quartile and SPREADS times its spread, which is the quartile range or, where most
documents have the same share, the mean's distance from the median if that is more. A source's fence is drawn towards its
language's, and that towards the corpus's, as if PRIOR documents of the wider group were its own; no group's size
switches anything. A document is rejected if a count is above the fence by more than chance (NOISE standard errors
of the count) explains, so that short texts aren't judged by one line or word. There are no fixed cutoffs.

Edge cases: a null text has no words and fails the base rules; a null language or source is a group of its own; shares
equal to a fence are kept; repeated rows and ids count as often as they occur, each getting its own row; with no document
that passes the base rules there is no fence, and nothing else is rejected; an empty table gives an empty result; texts of
any length are measured whole; further columns of the input, of any name, pass through filter_documents() and are ignored by judge().
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.llm.shared import WORD_GAP, bounded, table, written

#: Measure: the count, what it is a share of, the scale, and how much the count grows with each event.
MEASURES = {
    "symbol_pm": ("n_symbols", "word_chars", 1000, 1),
    "repeat_pm": ("n_repeat_words", "n_words", 1000, 6),  # two windows of three words
    "dup_line_pm": ("n_dup_lines", "n_lines", 1000, 1),
    "word_len_pc": ("word_chars", "n_words", 100, 1),
    "upper_pm": ("n_upper", "word_chars", 1000, 1),
}
SPREADS, NOISE = 3, 3
PRIOR = 100
#: At most so many rows of fences are broadcast; beyond it the join shuffles, and Spark splits hot keys.
BROADCAST_ROWS = 50_000
KEYS = ("lang", "source")


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def measure(docs: DataFrame) -> DataFrame:
    """docs with the base measures of the contract and the per-mille measures the fences are for."""
    gap = " \t\n\x0b\f\r"
    t = docs.withColumn("_t", F.coalesce("text", F.lit("")))
    t = t.withColumns({"_w": F.filter(F.split("_t", WORD_GAP), lambda w: w != ""), "_l": F.filter(F.split("_t", "\n"), lambda x: F.translate(x, gap, "") != "")})
    t = t.withColumns({"n_words": F.size("_w").cast("long"), "_n": F.size("_w")})
    n = F.col("_n")
    # three-word windows with their places, equal ones side by side
    t = t.withColumn("_g", F.when(n >= 4, F.sort_array(F.arrays_zip(F.slice("_w", F.lit(1), n - 2).alias("a"), F.slice("_w", F.lit(2), n - 2).alias("b"), F.slice("_w", F.lit(3), n - 2).alias("c"), F.sequence(F.lit(1), n - 2).alias("i")))))
    m = F.size("_g")
    t = t.withColumn("_p", F.when(F.col("_g").isNotNull(), F.filter(F.zip_with(F.slice("_g", F.lit(1), m - 1), F.slice("_g", F.lit(2), m - 1), lambda x, y: F.when((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.struct(x["i"].alias("i"), y["i"].alias("j")))), lambda p: p.isNotNull())))
    t = t.withColumn("_s", F.when(F.size("_p") > 0, F.sort_array(F.array_distinct(F.concat(F.transform("_p", lambda p: p["i"]), F.transform("_p", lambda p: p["j"]))))))
    k = F.size("_s")
    covered = F.aggregate(F.zip_with("_s", F.slice("_s", F.lit(2), k), lambda x, y: F.least(F.lit(3), F.coalesce(y - x, F.lit(3)))), F.lit(0), lambda acc, x: acc + x)
    t = t.withColumns({
        "word_chars": F.length(_without(F.col("_t"), gap)).cast("long"),
        "n_symbols": (F.length("_t") - F.length(_without(F.col("_t"), "#*$%&|<>"))).cast("long"),
        "n_upper": (F.length("_t") - F.length(_without(F.col("_t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))).cast("long"),
        "n_lines": F.size("_l").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
    })
    t = t.drop("_t", "_w", "_l", "_n", "_g", "_p", "_s")
    ratio = lambda c, scale, by: F.when(F.col(by) > 0, F.expr(f"({scale} * {c}) div {by}")).otherwise(F.lit(0).cast("long"))
    made = ["n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words"]
    # a generator keeps the optimizer from copying these expressions into filters that use them
    t = t.select(*[f"`{c}`" for c in docs.columns], F.inline(F.array(F.struct(*made))))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return t.withColumns({"base_failed": failed, **{m: ratio(x, scale, n) for m, (x, n, scale, _) in MEASURES.items()}})


def sketch_bin(x: Column) -> Column:
    """The bin of a non-negative whole number: itself below 32, then 16 bins to each power of two."""
    e = F.length(F.bin(x)) - 5
    return F.when(x < 32, x).otherwise(F.lit(16).cast("long") * e + F.call_function("shiftright", x, e))


def bin_top(b: Column) -> Column:
    """The largest number that falls in bin b."""
    e = F.floor((b - 16) / 16).cast("int")
    return F.when(b < 32, b).otherwise(F.call_function("shiftleft", b - 16 * e + 1, e) - 1)


def sketches(measured: DataFrame) -> DataFrame:
    """One row for each language, source, measure and bin that occurs, with its count of documents that pass the base rules."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), sketch_bin(F.col(m)).alias("bin")) for m in MEASURES])
    return measured.where("NOT base_failed").select(*KEYS, F.explode(pairs).alias("x")).groupBy(*KEYS, "x.measure", "x.bin").agg(F.count("*").alias("n"))


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of the coarser groups: the counts of the same bin add up."""
    return parts.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: list[str], name: str) -> DataFrame:
    """keys, measure, the number of documents and the upper fence."""
    w = Window.partitionBy(*keys, "measure")
    run = sketch.withColumns({"_all": F.sum("n").over(w), "_upto": F.sum("n").over(w.orderBy("bin"))})
    at = lambda q: bin_top(F.min(F.when(F.col("_upto") * 100 >= F.col("_all") * q, F.col("bin"))))
    total = F.sum(F.col("n") * bin_top(F.col("bin")))
    q = run.groupBy(*keys, "measure").agg(F.max("_all").alias("docs"), at(25).alias("q1"), at(50).alias("q2"), at(75).alias("q3"), total.alias("total"))
    spread = F.greatest(F.expr("q3 - q1"), F.expr("total div docs - q2"))
    return q.select(*keys, "measure", F.col("docs").alias(f"docs_{name}"), (F.col("q3") + SPREADS * spread).alias(f"fence_{name}"))


def thresholds(spark: SparkSession, measured: DataFrame, prior: int = PRIOR) -> DataFrame:
    """One row for each language and source: fence_<measure> for every measure."""
    parts = written(spark, sketches(measured), "sketches")
    own = fences(parts, [*KEYS], "own")
    lang = fences(merged(parts, ["lang"]), ["lang"], "lang")
    every = fences(merged(parts, []), [], "all")
    all_ = own.alias("o").join(lang.alias("l"), F.col("o.lang").eqNullSafe(F.col("l.lang")) & (F.col("o.measure") == F.col("l.measure"))).join(F.broadcast(every.alias("a")), F.col("o.measure") == F.col("a.measure"))
    drawn = lambda fence, docs, wider: F.expr(f"({fence} * {docs} + {wider} * {prior}) div ({docs} + {prior})")
    picked = all_.withColumn("wider", drawn("fence_lang", "docs_lang", "fence_all")).select("o.lang", "o.source", "o.measure", drawn("fence_own", "docs_own", "wider").alias("fence"))
    wide = picked.groupBy(*KEYS).agg(*[F.max(F.when(F.col("measure") == m, F.col("fence"))).alias(f"fence_{m}") for m in MEASURES])
    return written(spark, wide, "fences")


def judge(spark: SparkSession, docs: DataFrame, prior: int = PRIOR) -> DataFrame:
    """doc_id, lang and source of docs with all measures, fences and kept."""
    measured = written(spark, measure(docs.select("doc_id", "text", *KEYS)).drop("text"), "measures")
    return _verdict(measured, thresholds(spark, measured, prior))


def _over(measure: str) -> Column:
    x, n, scale, unit = MEASURES[measure]
    above = (scale * F.col(x) - F.col(f"fence_{measure}") * F.col(n)).cast("double")
    return F.coalesce((above > 0) & (above * above > F.col(x).cast("double") * float(NOISE * NOISE * unit * scale * scale)), F.lit(False))


def _verdict(measured: DataFrame, fence: DataFrame) -> DataFrame:
    f = bounded(fence.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[f"fence_{m}" for m in MEASURES]), BROADCAST_ROWS)
    joined = measured.join(f, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left").drop("_lang", "_source")
    return joined.withColumn("kept", ~F.col("base_failed") & ~reduce(lambda a, b: a | b, map(_over, MEASURES)))


def filter_documents(spark: SparkSession, docs: DataFrame, prior: int = PRIOR) -> DataFrame:
    """docs without the rejected ones, columns as they were. The texts are measured once and written with their measures."""
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text", *KEYS)
    measured = written(spark, measure(inner).drop("text"), "measures")
    return _verdict(measured, thresholds(spark, measured, prior)).where("kept").select("_row.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(spark, table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
