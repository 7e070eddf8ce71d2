"""CSV and TSV as the pipeline's stages exchange them: a header, all values text, '' for what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def text_schema(fields: list[str]) -> StructType:
    return StructType([StructField(f, StringType()) for f in fields])


def read_csv(spark: SparkSession, path: str, fields: list[str], sep: str = ",", missing_ok: bool = False) -> DataFrame:
    """All columns as text, null for ''. A byte order mark goes; with missing_ok, no file is an empty table."""
    schema = text_schema(fields)
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"', sep=sep, enforceSchema=False)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_csv(df: DataFrame, path: str, fields: list[str], sep: str = ",", mode: str = "errorifexists", strict: bool = False, files: int | None = 1, mark: bool = False) -> None:
    """fields of df in order as CSV in a folder: one file, as the stages exchange them, or so many; with None, one a task.

    Fields df hasn't are empty; strict, other columns are an error. mark: a byte order mark begins each file, as spreadsheets
    want it; the header is then the first field's name after the mark.
    """
    if strict and set(df.columns) - set(fields):
        raise ValueError(f"unexpected columns: {sorted(set(df.columns) - set(fields))}")
    out = df.select(*[F.col(f).cast("string").alias(f) if f in df.columns else F.lit("").alias(f) for f in fields])
    if mark and fields:
        out = out.withColumnRenamed(fields[0], f"\ufeff{fields[0]}")
    (out if files is None else out.coalesce(files)).write.mode(mode).csv(path, header=True, emptyValue="", escape='"', sep=sep)


def write_by_type(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A folder for each page type, the format in which stages are kept."""
    df.write.mode(mode).partitionBy("page_type").parquet(path)


def combined(parts: list[DataFrame], preferred: list[str]) -> DataFrame:
    """All rows of tables with different columns, preferred columns first and the rest as they are first seen."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    first = [c for c in preferred if c in out.columns]
    return out.select(*first, *[c for c in out.columns if c not in first])
