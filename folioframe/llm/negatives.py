"""Hard negatives of anchor vectors, screened by partial products along principal axes.

Vectors of integers are turned by an orthogonal matrix whose axes are the principal ones of all rows' second moments, so
that the leading components hold most of a product. A task adds up products over the leading components; what is left of a
product is at most the product of the two residual norms, and a slack covers rounding. Pairs that can't enter a list any
more are discarded, the others get more components, and what survives is verified by integer products, which alone
decide.

Anchors are the stated query set, searched against all rows in blocks of at most ANCHORS, which are broadcast; each block
takes two passes over the rows, of which no row is shuffled. The first finds each anchor's positives, the second, for
each positive, the best negatives in its window of scores. A task keeps the lists' heads and gives these alone, so
that a window function over tasks' heads finishes the job. Within a task rows come by id, so a row that only ties with a
full list is discarded too, and a group of equal vectors costs no more than others.

Edge cases: rows with a null label or vector, or a component that is null, not finite or not within BOUND after
scaling (whose products might not fit a long), take no part; a null id is no anchor's, isn't divisible, comes last
among ties, and is null again in the result; repeated rows are rows like others, also beside an anchor that they
repeat; shorter vectors count as filled up with zeros; anchors without positives, and positives without negatives, give no
row; an empty table gives an empty result; further columns, of any name, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.llm.shared import fresh_path, table, written

SCALE, EVERY, RELABEL, LABELS = 256, 100, 7, 10
POSITIVES, NEGATIVES, LEAST, MOST = 5, 10, 30, 90
#: Anchors of a block, and rows and anchors whose products are made at once.
ANCHORS, ROWS_AT_ONCE, ANCHORS_AT_ONCE = 8192, 2048, 512
#: Components of a block's anchors, so that long vectors make smaller blocks.
COMPONENTS = 1 << 22
#: Greatest component after scaling.
BOUND = 1 << 24
#: Rounding of single precision, a multiple of both norms: a product of d terms is off by less than (d + 3) * 2 ** -24 of them.
_ROUNDING = 2.0**-24
_LAST = np.iinfo(np.int64).max
_FAR = 1 << 62


def prepared(rows: DataFrame) -> DataFrame:
    """id (vec_id, null last), label, q (scaled integers) and row (a number of its own) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda v: v.isNotNull() & (F.abs(v * SCALE) <= BOUND))  # NaN is greater than any number
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % RELABEL == 0, (label + 1) % LABELS).otherwise(label)
    rows = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(sound)
    q = F.transform(x, lambda v: F.floor(v * SCALE).cast("int"))
    return rows.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(_LAST)).alias("id"), label.alias("label"), q.alias("q"), F.monotonically_increasing_id().alias("row"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Lists of integers as rows of a matrix, filled up with zeros."""
    n = len(column)
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if (sizes == d).all():
        return flat.reshape(n, d).astype(np.int64)
    out = np.zeros((n, d), np.int64)
    out[np.arange(d)[None, :] < sizes[:, None]] = flat
    return out


def axes(rows: DataFrame, d: int) -> np.ndarray:
    """The orthogonal matrix whose columns are the principal axes of all rows, the strongest first."""

    def each(batches):
        total = np.zeros((d, d))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                q = _matrix(batch.column(0).slice(at, 4096), d).astype(float)
                total += q.T @ q
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "s"])

    found = rows.select("q").mapInArrow(each, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas()
    moments = np.zeros((d, d))
    moments[found.i, found.j] = moments[found.j, found.i] = found.s
    return np.linalg.eigh(moments)[1][:, ::-1]


@dataclass
class Turned:
    """Rows or anchors: ids, labels, integers, turned components, and the norms of what is left after each step."""

    row: np.ndarray
    id: np.ndarray
    label: np.ndarray
    q: np.ndarray
    y: np.ndarray
    left: np.ndarray

    @classmethod
    def of(cls, row, id_, label, q, turn: np.ndarray, steps: list[int]) -> Turned:
        y = q @ turn
        behind = np.sqrt(np.maximum(np.cumsum((y * y)[:, ::-1], 1)[:, ::-1], 0))
        left = np.stack([behind[:, k] if k < y.shape[1] else np.zeros(len(y)) for k in (0, *steps)], 1)
        return cls(row, id_, label, q, y.astype(np.float32), (left * (1 + 1e-6)).astype(np.float32))

    def part(self, a: int, b: int) -> Turned:
        return Turned(*(v[a:b] for v in (self.row, self.id, self.label, self.q, self.y, self.left)))


def steps_of(d: int) -> list[int]:
    return sorted({max(1, d // 4), max(1, d // 2), d})


def screened(r: Turned, a: Turned, steps: list[int], same: bool, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, anchor) of pairs whose product may be from low to high of the anchor, and whose labels are equal or not."""
    d = r.y.shape[1]
    rounding = np.float32(4 * (d + 3) * _ROUNDING)
    ny, na = r.left[:, 0], a.left[:, 0]
    low, high = low.astype(np.float32), high.astype(np.float32)
    # thresholds lose up to 2 ** -24 of themselves as single numbers
    low, high = low - np.abs(low) * np.float32(1e-6) - 1, high + np.abs(high) * np.float32(1e-6) + 1
    done, x, p = 0, None, None
    mask = (r.label[:, None] == a.label[None, :]) == same
    total = np.zeros(mask.shape, np.float32)
    for s, k in enumerate(steps, 1):
        if x is None:
            total += r.y[:, done:k] @ a.y[:, done:k].T
            slack = r.left[:, s, None] * a.left[None, :, s] + rounding * ny[:, None] * na[None, :]
            mask &= (total + slack >= low) & (total - slack <= high)
            if k == d or np.count_nonzero(mask) * 16 < mask.size:
                x, y = np.nonzero(mask)
                p = total[x, y]
        else:
            p = p + np.einsum("ij,ij->i", r.y[x, done:k], a.y[y, done:k])
            slack = r.left[x, s] * a.left[y, s] + rounding * ny[x] * na[y]
            ok = (p + slack >= low[y]) & (p - slack <= high[y])
            x, y, p = x[ok], y[ok], p[ok]
        done = k
    return x, y


class Lists:
    """The heads of lists by falling score and rising id: slots lists for each anchor, each with scores of its own window."""

    def __init__(self, low: np.ndarray, high: np.ndarray, most: int):
        self.slots, self.most = low.shape[1], most
        self.low, self.high = low.copy(), high  # anchors x slots; low rises as lists fill
        self.score = np.full((low.size, most), -_FAR)
        self.id = np.full((low.size, most), _LAST)

    def bounds(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of use to any list of each anchor."""
        return self.low[a:b].min(1), self.high[a:b].max(1)

    def add(self, anchor: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        at, slot = np.nonzero((score[:, None] >= self.low[anchor]) & (score[:, None] <= self.high[anchor]))
        if not len(at):
            return
        new = anchor[at] * self.slots + slot
        touched = np.unique(new)
        old = np.repeat(touched, self.most)
        g = np.concatenate([old, new])
        score, id_ = np.concatenate([self.score[touched].ravel(), score[at]]), np.concatenate([self.id[touched].ravel(), id_[at]])
        order = np.lexsort((id_, -score, g))
        g, score, id_ = g[order], score[order], id_[order]
        first = np.append(0, np.flatnonzero(g[1:] != g[:-1]) + 1)
        head = (first[:, None] + np.arange(self.most)).ravel()  # each list has at least its old rows
        self.score[touched], self.id[touched] = score[head].reshape(-1, self.most), id_[head].reshape(-1, self.most)
        worst = self.score[touched, -1]
        full = touched[worst > -_FAR]
        flat = self.low.reshape(-1)
        flat[full] = np.maximum(flat[full], self.score[full, -1] + 1)

    def heads(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, score and id of all that the lists hold."""
        which, place = np.nonzero(self.score > -_FAR)
        return which, self.score[which, place], self.id[which, place]


def _searched(rows: DataFrame, anchors, low: np.ndarray, high: np.ndarray, same: bool, most: int, d: int) -> DataFrame:
    """list (anchor * slots + slot), score and id: heads of the lists over all rows, best first by place.

    anchors: a broadcast of the turning matrix and the anchors' rows, ids, labels and integers. low, high: a window for
    each anchor and slot.
    """
    steps, slots = steps_of(d), low.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast((low, high))

    def each(batches):
        turn, *own = anchors.value
        a = Turned.of(*own, turn, steps)
        lists = Lists(*shared.value, most)
        step = 64
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, step)
                at, step = at + step, min(2 * step, ROWS_AT_ONCE)
                row, id_, label = (part.column(k).to_numpy() for k in (0, 1, 2))
                r = Turned.of(row, id_, label, _matrix(part.column(3), d), turn, steps)
                for k in range(0, len(a.row), ANCHORS_AT_ONCE):
                    some = a.part(k, k + ANCHORS_AT_ONCE)
                    x, y = screened(r, some, steps, same, *lists.bounds(k, k + ANCHORS_AT_ONCE))
                    other = r.row[x] != some.row[y]
                    x, y = x[other], y[other]
                    for j in range(0, len(x), 1 << 16):
                        px, py = x[j : j + (1 << 16)], y[j : j + (1 << 16)]
                        lists.add(py + k, np.einsum("ij,ij->i", r.q[px], some.q[py]), r.id[px])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in lists.heads()], names=["list", "score", "id"])

    ordered = rows.select("row", "id", "label", "q").sortWithinPartitions("id")
    heads = ordered.mapInArrow(each, "list bigint, score bigint, id bigint")
    place = F.row_number().over(Window.partitionBy("list").orderBy(F.desc("score"), "id"))
    found = heads.withColumn("place", place).where(F.col("place") <= most)
    return found.withColumn("anchor", F.floor(F.col("list") / slots).cast("long"))


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def mined(spark: SparkSession, vectors: DataFrame, block: int = ANCHORS) -> DataFrame:
    """Hard negatives of vectors (vec_id, embedding, label): RESULT."""
    rows = written(spark, prepared(vectors), "vectors")
    d = max(1, rows.agg(F.max(F.size("q"))).first()[0] or 0)
    wanted = rows.where((F.col("id") % EVERY == 0) & (F.col("id") != _LAST))
    n = wanted.count()
    if n == 0:
        return spark.createDataFrame([], RESULT)
    block = max(1, min(block, COMPONENTS // d))
    blocks = -(-n // block)
    while True:  # blocks of a hash; none may have more than block anchors
        own = wanted.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
        if own.groupBy("block").count().agg(F.max("count")).first()[0] <= block:
            break
        blocks += 1 + blocks // 4
    own = written(spark, own, "anchors")
    turn, path = axes(rows, d), fresh_path(spark, "negatives")
    for k in range(blocks):
        part = own.where(F.col("block") == k).select("row", "id", "label", "q").toArrow().combine_chunks()  # at most block rows
        if not part.num_rows:
            continue
        whole = [part.column(c).to_numpy() for c in (0, 1, 2)] + [_matrix(part.column(3).combine_chunks(), d)]
        anchors = spark.sparkContext.broadcast((turn, *whole))
        m = part.num_rows
        found = _searched(rows, anchors, np.full((m, 1), -_FAR), np.full((m, 1), _FAR), True, POSITIVES, d).select("anchor", "place", "score", "id").toPandas()  # at most POSITIVES for each anchor of the block
        score, ids = np.zeros((m, POSITIVES), np.int64), np.zeros((m, POSITIVES), np.int64)
        low, high = np.full((m, POSITIVES), _FAR), np.full((m, POSITIVES), -_FAR)
        at = found.anchor.to_numpy(), found.place.to_numpy() - 1
        score[at], ids[at] = found.score, found.id
        low[at], high[at] = -(-LEAST * score[at] // 100), MOST * score[at] // 100
        # each list's positive stands beside it as a small table: POSITIVES rows for each anchor of the block
        beside = spark.createDataFrame(
            pa.table({"list": at[0] * POSITIVES + at[1], "anchor_id": whole[1][at[0]], "positive_id": ids[at], "positive_score": score[at]}),
            "list bigint, anchor_id bigint, positive_id bigint, positive_score bigint",
        )
        best = _searched(rows, anchors, low, high, False, NEGATIVES, d)
        best = best.join(F.broadcast(beside), "list")
        best = best.select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        best.write.mode("append").option("compression", "zstd").parquet(path)
        anchors.unpersist()
    back = spark.read.schema(RESULT).parquet(path)
    return back.withColumns({c: F.when(F.col(c) != _LAST, F.col(c)) for c in ("positive_id", "negative_id")})


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(spark, table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH r AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.rid AS ar, a.vec_id AS anchor_id, r.rid, r.vec_id, a.label = r.label AS same, list_inner_product(a.q, r.q)::BIGINT AS score
  FROM r AS a JOIN r ON a.rid <> r.rid WHERE a.vec_id % 100 = 0
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.ar, p.rid ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.ar = p.ar WHERE NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
