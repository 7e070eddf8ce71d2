"""Documents for people: a page's rows as a table, and what a run has done, as Markdown or HTML text.

A page's document is put together where its rows meet, in the order of the rows; a run's summary from counts of a few rows.
Edge cases: null cells are empty; bars and line breaks in cells don't break the table; a page without rows has no document; a
run without flags says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.functions.text import html_escape, text_of


def _cell(c: Column) -> Column:
    """Text inside a Markdown table."""
    return F.replace(F.regexp_replace(text_of(c.cast("string")), r"[\r\n]+", " "), F.lit("|"), F.lit("\\|"))


def page_documents(rows: DataFrame, key: str, order: str, columns: list[str], html: bool = False) -> DataFrame:
    """name and content (bytes) of a document for each page: its rows in order, a column for each of the columns."""
    if html:
        head = "<tr>" + "".join(f"<th>{c}</th>" for c in columns) + "</tr>\n"
        line = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), html_escape(F.col(c).cast("string")), F.lit("</td>")) for c in columns], F.lit("</tr>"))
        title = lambda k: F.concat(F.lit("<h1>"), html_escape(k), F.lit(f"</h1>\n<table>\n{head}"))
        end = "\n</table>\n"
    else:
        head = "| " + " | ".join(columns) + " |\n|" + "---|" * len(columns) + "\n"
        line = F.concat(F.lit("| "), F.concat_ws(" | ", *[_cell(F.col(c)) for c in columns]), F.lit(" |"))
        title = lambda k: F.concat(F.lit("# "), k, F.lit(f"\n\n{head}"))
        end = "\n"
    lines = rows.select(F.col(key).cast("string").alias("_k"), F.col(order).alias("_o"), line.alias("_l"))
    body = lines.groupBy("_k").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_l"))), lambda s: s["_l"]), "\n").alias("_b"))
    name = F.concat(F.lit("reports/"), F.regexp_replace("_k", r"[^A-Za-z0-9_\-]", "_"), F.lit(".html" if html else ".md"))
    return body.select(name.alias("name"), F.concat(title(F.col("_k")), F.col("_b"), F.lit(end)).cast("binary").alias("content"))


def run_summary(pages: DataFrame, flags: DataFrame, title: str) -> DataFrame:
    """One row, content (text): pages by type and flags by name, each in the order of names. Types and flags are few, whatever the
    number of pages."""
    types = pages.groupBy(F.col("page_type").alias("name")).agg(F.count("*").alias("n")).select(F.lit(0).alias("part"), "name", "n")
    seen = flags.groupBy(F.col("flag").alias("name")).agg(F.count("*").alias("n")).select(F.lit(1).alias("part"), "name", "n")
    of = lambda k: F.transform(F.array_sort(F.collect_list(F.when(F.col("part") == k, F.struct("name", "n")))), lambda s: F.concat(F.lit("- `"), s["name"], F.lit("`: "), s["n"].cast("string")))
    both = types.union(seen).agg(of(0).alias("t"), of(1).alias("f"))
    listed = lambda c, none: F.when(F.size(c) > 0, F.array_join(c, "\n")).otherwise(none)
    return both.select(F.concat(F.lit(f"# {title}\n\n## Pages by type\n\n"), listed("t", "- none"), F.lit("\n\n## Flags\n\n"), listed("f", "- none"), F.lit("\n")).alias("content"))
