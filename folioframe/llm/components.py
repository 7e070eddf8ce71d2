"""Connected components of a table of links.

Tasks of at most PART links each first turn their links into stars around the least node that they know. If there is
more than one such task, alternating star contractions follow: every round sends each node's greater neighbours, and
then its smaller ones, to the least node it knows, until the links are stars around the least node of each component.
Rounds grow with the logarithm of the longest path. Minima are aggregated before they are shuffled, and the joins are
plain ones whose hot keys Spark splits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm.shared import discard, job, written

#: Links that a task joins in memory (about 100 bytes each).
PART = 1_000_000


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least place that each of n places is connected with by the edges x, y."""
    root = np.arange(n)
    while len(x):
        x, y = root[x], root[y]
        low, new = np.minimum(x, y), root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        while ((further := new[new]) != new).any():
            new = further
        if (new == root).all():
            break
        root = new
    return root


def _stars(links: DataFrame) -> DataFrame:
    """The links of each task as stars around the least nodes."""

    def each(batches):
        parts = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not parts:
            return
        whole = pa.concat_tables(parts)
        both = pa.chunked_array(whole.column(0).chunks + whole.column(1).chunks).combine_chunks().dictionary_encode()
        known, at = both.dictionary, both.indices.to_numpy()
        order = pa.compute.sort_indices(known).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        x, y = place[at[: whole.num_rows]], place[at[whole.num_rows :]]
        root = connected(len(order), x, y)
        far = np.flatnonzero(root != np.arange(len(order)))
        yield pa.RecordBatch.from_arrays([known.take(pa.array(order[k])) for k in (far, root[far])], names=["a", "b"])

    return links.select("a", "b").mapInArrow(each, links.select("a", "b").schema)


def components(spark: SparkSession, links: DataFrame, part: int = PART) -> DataFrame:
    """a (node) and b (least node of its component) for all nodes of links (columns a, b) but the least ones."""
    with job(spark):
        links = written(spark, links.where(F.col("a") != F.col("b")).select("a", "b"), "links")
        n = links.count()
        parts = max(1, -(-n // part))
        links = written(spark, _stars(links.coalesce(parts)), "links", kept=parts == 1)
        if parts == 1:
            return links
        state = _state(links)
        while state[0]:
            both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
            low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a != b").distinct()
            new = written(spark, small, "links")
            discard(spark, links)
            links, before, state = new, state, _state(new)
            if state == before:
                break
        return written(spark, links, "links", kept=True)
