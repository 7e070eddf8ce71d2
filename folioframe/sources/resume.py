"""Work on samples that goes on where it stopped: outputs in runs, and a manifest of what is complete.

A run writes each kind of output below its own name and then, once all kinds are stored, a row for each sample and run to
the manifest. Readers take rows of runs that the manifest holds alone, so what a stopped run has written is never read, and
its samples are made again. Of several runs of a sample the last counts.

Modes: resume makes what the manifest lacks; again makes all, as after a change of rules, from cached inputs if there are
any; only makes nothing and reads what is there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.sources.csv import exists

_MANIFEST = "sample_id string, run string, at timestamp"


class Runs:
    """Outputs of kinds (name: schema, each with sample_id) in a folder."""

    def __init__(self, spark: SparkSession, folder: str, kinds: dict[str, str]):
        self.spark, self.folder, self.kinds = spark, folder.rstrip("/"), kinds

    def _table(self, name: str, schema: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        return self.spark.read.schema(schema).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def complete(self) -> DataFrame:
        """sample_id and run of the complete samples, the last run of each."""
        return self._table("manifest", _MANIFEST).groupBy("sample_id").agg(F.max_by("run", F.struct("at", "run")).alias("run"))

    def read(self, kind: str) -> DataFrame:
        """Rows of a kind of all complete samples."""
        rows = self._table(kind, f"{self.kinds[kind]}, run string")
        return rows.join(self.complete(), ["sample_id", "run"], "left_semi").drop("run")

    def pending(self, work: DataFrame) -> DataFrame:
        """The part of the work (sample_id and more) whose samples aren't complete."""
        return work.join(self.complete(), "sample_id", "left_anti")

    def run(self, work: DataFrame, make: Callable[[DataFrame], dict[str, DataFrame]], mode: str = "resume") -> str | None:
        """Make the outputs of the work that the mode asks for; the run's name, none if there was nothing to do."""
        if mode not in ("resume", "again", "only"):
            raise ValueError(f"no such mode: {mode}")
        todo = self.pending(work) if mode == "resume" else work
        if mode == "only" or not todo.limit(1).count():
            return None
        name = uuid.uuid4().hex
        made = make(todo)
        for kind in self.kinds:
            path = f"{self.folder}/{kind}"
            made[kind].withColumn("run", F.lit(name)).write.mode("append").partitionBy("run").parquet(path)
        at = F.lit(datetime.now(timezone.utc))
        todo.select(F.col("sample_id").cast("string").alias("sample_id"), F.lit(name).alias("run"), at.alias("at")).distinct().write.mode("append").parquet(f"{self.folder}/manifest")
        return name


def cached(work: DataFrame, path: str, make: Callable[[DataFrame], DataFrame], schema: str, keys: list[str]) -> DataFrame:
    """What path holds (schema, with the keys), after what make() gives for the work whose keys it lacks has been added.

    Work that a reading gave nothing for is tried again, as it has left no row.
    """
    spark = work.sparkSession
    new = work.join(spark.read.schema(schema).parquet(path).select(*keys).distinct(), keys, "left_anti") if exists(spark, path) else work
    if new.limit(1).count():
        make(new).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def resolved(pages: DataFrame, listings: list[tuple[str, DataFrame]], fallback: str = "made_from_scan") -> DataFrame:
    """pages with crop_path and crop_source: the first listing (source, table of name and path) that has the page's file.

    A page gives the name that each listing is searched for in <source>_name; a page that none has gets no path and the
    fallback as its source, to be made again. Of files of one name in a listing the first path counts.
    """
    out, found = pages, []
    for k, (source, files) in enumerate(listings):
        one = files.groupBy(F.col("name").alias(f"_n{k}")).agg(F.min("path").alias(f"_p{k}"))
        out = out.join(one, F.col(f"{source}_name") == F.col(f"_n{k}"), "left").drop(f"_n{k}")
        found.append((source, F.col(f"_p{k}")))
    path = F.coalesce(*[p for _, p in found])
    source = F.coalesce(*[F.when(p.isNotNull(), s) for s, p in found], F.lit(fallback))
    return out.withColumns({"crop_path": path, "crop_source": source}).drop(*[f"_p{k}" for k in range(len(listings))])
