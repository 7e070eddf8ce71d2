"""Queries of the page-table operators by name, with their DuckDB forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioframe.plans import cell_queries, page_queries, parse_queries, word_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**word_queries.QUERIES, **cell_queries.QUERIES, **page_queries.QUERIES, **parse_queries.QUERIES}
ORACLES: dict[str, str] = {**word_queries.ORACLES, **cell_queries.ORACLES, **page_queries.ORACLES}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each flag is on the cleaned rows."""
    return QUERIES["flag_histogram"](spark, sf_dir)
