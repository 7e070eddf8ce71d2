"""Scan files: names, folders and image sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_name(name: Column) -> Column:
    """struct(date, picture, side) of a crop's name, '' where it isn't one."""
    pattern = r"^(\d{4}-\d{2}-\d{2})_(\d+)_(left|right)_table\.(?i:jpg)$"
    return F.struct(*[F.regexp_extract(name, pattern, k).alias(n) for k, n in ((1, "date"), (2, "picture"), (3, "side"))])


def scan_date(name: Column) -> Column:
    """The date of a scan's name, year-M month-day, with zeros."""
    part = lambda k: F.regexp_extract(name, r"(?i)^(\d{4})-M(\d{1,2})-(\d{1,2})_(\d+)", k).try_cast("int")
    return F.when(part(1).isNotNull(), F.format_string("%04d-%02d-%02d", part(1), part(2), part(3))).otherwise("")


def named(spark: SparkSession, folder: str, glob: str = "*.{jpg,JPG}") -> DataFrame:
    """path of the image files of a folder; no content is read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path")


def sliced(names: DataFrame, start: int = 0, end: int | None = None, limit: int | None = None) -> DataFrame:
    """The names from start to before end, at most limit of them, in the order of path.

    The names at both ends of the slice are looked for first, each by a limited sort, of which a task keeps the first ones; the
    slice is then a filter.
    """
    if start < 0 or (end is not None and end < start):
        raise ValueError("a slice begins at 0 or later and doesn't end before it begins")
    stop = min([n for n in (end, start + limit if limit is not None else None) if n is not None], default=None)

    def at(n: int) -> str | None:
        """The name of which n are less; none if there aren't more than n."""
        row = names.orderBy("path").limit(n + 1).agg(F.max("path").alias("m"), F.count("*").alias("n")).first()
        return row["m"] if row["n"] == n + 1 else None

    if stop is not None and stop <= start:
        return names.limit(0)
    if start:
        first = at(start)
        if first is None:
            return names.limit(0)
        names = names.where(F.col("path") >= first)
        stop = None if stop is None else stop - start
    if stop is not None and (last := at(stop)) is not None:
        names = names.where(F.col("path") < last)
    return names


def with_content(names: DataFrame) -> DataFrame:
    """path and content of the files; those of other names aren't opened."""

    def each(batches):
        import pyarrow as pa
        from pyarrow.fs import FileSystem

        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, at = FileSystem.from_uri(path if "://" in path else path.replace(":", "://", 1))
                with fs.open_input_stream(at) as f:
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([f.read()], pa.binary())], names=["path", "content"])

    return names.select("path").mapInArrow(each, "path string, content binary")


def scans(spark: SparkSession, folder: str, start: int = 0, end: int | None = None, limit: int | None = None, glob: str = "*.{jpg,JPG}") -> DataFrame:
    """path and content of the image files of a folder, sliced in the order of their names. Files out of the slice aren't read."""
    whole = not start and end is None and limit is None
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select("path", "content") if whole else with_content(sliced(named(spark, folder, glob), start, end, limit))


def manifest_rows(manifest: DataFrame, column: str, value: str, order: list[str], limit: int | None = None) -> DataFrame:
    """The rows of a manifest of one zone or page type, in order, the first ones if there is a limit."""
    rows = manifest.where(F.col(column) == value).orderBy(*order)
    return rows if limit is None else rows.limit(limit)


def pending(work: DataFrame, done: DataFrame, key: str = "sample_id") -> DataFrame:
    """The part of a list of work that isn't done yet."""
    return work.join(done.select(key).distinct(), key, "left_anti")
