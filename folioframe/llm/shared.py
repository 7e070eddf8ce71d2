"""Reading tables, and what else the operators of this subpackage share; lineage is cut by the tables of folioframe.stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.stored import _application_folder, discard, fresh_path, job, shared_dir, written  # noqa: F401

#: The words of a text are the runs of other characters than these (space and U+0009 to U+000D).
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows; else as it is, for a shuffled join.

    df must be cheap to read again, such as a table from written().
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
