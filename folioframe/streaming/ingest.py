"""Word tables read as a stream of files: each new file once, then the query ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioframe.sources.tsv import parse_tsv


def new_words(spark: SparkSession, folder: str, scale: float = 1.0) -> DataFrame:
    """Words of the TSV files in a folder, as a stream."""
    return parse_tsv(spark.readStream.text(folder), scale)


def ingest(spark: SparkSession, folder: str, table: str, checkpoint: str, scale: float = 1.0) -> None:
    """Append the words of files that weren't there at the last call to a Parquet table."""
    query = new_words(spark, folder, scale).writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
