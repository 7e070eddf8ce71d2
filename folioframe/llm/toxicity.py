"""Toxicity scores from a factorization machine over hashed terms.

Terms are lower-case runs of letters, hashed into 2^18 places. A place is a feature if enough training documents hold
it and its share differs between the two labels; a document's value for it is 1 if it holds the term. The machine adds
a bias, a weight for each feature and, for each pair of features that occur together, the product of their factor
vectors, so a pair such as an insult and the mention of a group can weigh more than both do alone.

The machine is trained on the driver on at most TRAIN_ROWS labelled rows, those with the lowest hash of doc_id among
the rows that aren't held out, however many labels there are. Scoring is one pass over all documents.

Edge cases: a null or empty text has no features and gets the score of the bias; a text of any length counts each term
once; a null doc_id isn't held out, and has no label; rows whose label or text is null aren't used in training; of several
labels or texts of one doc_id each counts, in the order of their hashes; scores of one half count as toxic; with no labelled row, or labels of one kind, every score is that kind's share (one half
without any); repeated rows each get their own row; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm.shared import table, written

PLACES = 1 << 18
TRAIN_ROWS = 20_000
FACTORS = 8
EPOCHS = 12
BATCH = 256
MIN_DOCS = 5
#: Least difference between the labels' shares, in standard errors, that makes a place a feature.
MIN_Z = 4.0
FOLDS = 5
_TERM = re.compile(r"[^\W\d_]+")
#: A worker forgets its terms' places when it has so many.
CACHE_TERMS = 1_000_000


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def place(term: str) -> int:
    return zlib.crc32(term.encode()) & (PLACES - 1)


class _Places(dict):
    def __missing__(self, term):
        if len(self) > CACHE_TERMS:
            self.clear()
        at = self[term] = place(term)
        return at


_places = _Places()


def places(text: str | None) -> list[int]:
    """The distinct places of a text's terms, in order."""
    return sorted(set(map(_places.__getitem__, set(_TERM.findall(text.lower()))))) if text else []


@dataclass
class Machine:
    """feature: number of each place's feature, -1 for none."""

    feature: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, features: np.ndarray) -> float:
        """The margin of a document with these features."""
        if not len(features):
            return self.bias
        v = self.factors[features]
        total = v.sum(0)
        return self.bias + self.weights[features].sum() + 0.5 * float((total * total - (v * v).sum(0)).sum())

    def score(self, at: list[int]) -> float:
        f = self.feature[at] if at else np.empty(0, np.int64)
        x = self.raw(f[f >= 0])
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def train(rows: list[list[int]], labels: np.ndarray, seed: int = 7) -> Machine:
    """Fit by Adam on the logistic loss with weight decay; rows hold each document's places."""
    feature = np.full(PLACES, -1, np.int64)
    n, positive = len(labels), float(labels.sum())
    share = (positive + 0.5) / (n + 1)
    prior = math.log(share / (1 - share))
    if not 0 < positive < n:
        return Machine(feature, prior, np.zeros(0), np.zeros((0, FACTORS)))
    flat = np.concatenate([np.asarray(r, np.int64) for r in rows])
    doc = np.repeat(np.arange(n), [len(r) for r in rows])
    df = np.bincount(flat, minlength=PLACES)
    hits = np.bincount(flat, weights=labels[doc], minlength=PLACES)
    p = df / n
    gap = hits / positive - (df - hits) / (n - positive)
    z = np.abs(gap) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / positive + 1 / (n - positive)))
    chosen = np.flatnonzero((df >= MIN_DOCS) & (z >= MIN_Z))
    feature[chosen] = np.arange(len(chosen))
    f = feature[flat]
    doc, f = doc[f >= 0], f[f >= 0]
    first = np.searchsorted(doc, np.arange(n + 1))
    rng = np.random.default_rng(seed)
    m, k = len(chosen), FACTORS
    params = np.zeros((m + 1, k + 1))  # weights, then factors; the bias is the last row's weight
    params[:m, 1:] = rng.normal(0, 0.05, (m, k))
    params[m, 0] = prior
    mean, square, step = np.zeros_like(params), np.zeros_like(params), 0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            ids = order[at : at + BATCH]
            sizes = first[ids + 1] - first[ids]
            row = np.repeat(np.arange(len(ids)), sizes)
            cols = f[np.concatenate([np.arange(first[i], first[i + 1]) for i in ids])] if sizes.sum() else np.empty(0, np.int64)
            v = params[cols]
            sums = np.zeros((len(ids), k + 1))
            np.add.at(sums, row, v)
            squares = np.zeros((len(ids), k))
            np.add.at(squares, row, v[:, 1:] ** 2)
            margin = params[m, 0] + sums[:, 0] + 0.5 * (sums[:, 1:] ** 2 - squares).sum(1)
            error = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - labels[ids]) / len(ids)
            grad = 1e-4 * params
            grad[m] = 0
            local = np.empty_like(v)
            local[:, 0] = error[row]
            local[:, 1:] = error[row, None] * (sums[row, 1:] - v[:, 1:])
            np.add.at(grad, cols, local)
            grad[m, 0] = error.sum()
            step += 1
            mean = 0.9 * mean + 0.1 * grad
            square = 0.999 * square + 0.001 * grad**2
            params -= 0.02 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Machine(feature, float(params[m, 0]), params[:m, 0].copy(), params[:m, 1:].copy())


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[list[int]], np.ndarray]:
    """Places and labels of the training documents, in the order of doc_id.

    Executors count the places' documents for either label first; only places that may be features go to the driver.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_y")).where(F.col("_y").isNotNull() & F.col("_id").isNotNull() & ~held_out(F.col("_id")))
    picked = known.orderBy(F.xxhash64("_id"), "_id", "_y").limit(rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).where(F.col("text").isNotNull())

    def each(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array([places(t) for t in part.column(3).to_pylist()], pa.list_(pa.int32()))], names=["doc_id", "toxic", "h", "places"])

    spark = docs.sparkSession
    found = joined.select(F.col("doc_id").cast("long"), F.col("_y").cast("int").alias("toxic"), F.xxhash64("text").alias("h"), "text").mapInArrow(each, "doc_id bigint, toxic int, h bigint, places array<int>")
    found = written(spark, found.orderBy("doc_id", "toxic", "h").limit(rows), "training-rows")
    n, positive = found.agg(F.count("*"), F.count_if(F.col("toxic") > 0)).first()
    df, hits = F.count("*"), F.count_if(F.col("toxic") > 0)
    gap = F.abs(F.col("hits") / max(positive, 1) - (F.col("df") - F.col("hits")) / max(n - positive, 1))
    share = F.col("df") / max(n, 1)
    error = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-12)) * (1 / max(positive, 1) + 1 / max(n - positive, 1)))
    # train() decides; a little less is asked here, as its arithmetic may round otherwise
    often = found.select("toxic", F.explode("places").alias("p")).groupBy("p").agg(df.alias("df"), hits.alias("hits")).where((F.col("df") >= MIN_DOCS) & (gap >= (MIN_Z - 0.01) * error)).select("p")
    apart = found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "toxic", "h", "places")
    kept = apart.select("row", F.explode("places").alias("p")).join(often, "p").groupBy("row").agg(F.array_sort(F.collect_list("p")).alias("kept"))
    out = apart.drop("places").join(kept, "row", "left").select("doc_id", "toxic", "h", "kept").toArrow()
    out = out.sort_by([("doc_id", "ascending"), ("toxic", "ascending"), ("h", "ascending")])
    return [x or [] for x in out.column(3).to_pylist()], (out.column(1).to_numpy() > 0).astype(float)


def score(spark: SparkSession, docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score and predicted for each document. The machine's size doesn't grow with the documents."""
    shared = spark.sparkContext.broadcast(machine)

    def each(batches):
        model = shared.value
        for batch in batches:
            scores = np.array([model.score(places(t)) for t in batch.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32), pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(each, "doc_id bigint, held_out boolean, score double, predicted int")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(spark, docs, train(*training_rows(docs, table(spark, sf_dir, "labels"))))
