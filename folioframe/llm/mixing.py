"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in an order dealt by a digest of their ids and texts, are cut into blocks of equal volume (code
points); a document belongs to the block its first character falls in. With integer weights w of W in all, block j of
a source is released in slot floor(j*W/w) and due by slot ceil((j+1)*W/w). Every slot takes, of the blocks released by
then, the one due first (then the greater weight, then the name), from a heap. Up to any slot each source has its fluid
share of blocks, more or less than one block. The schedule repeats after W slots, a period, in which each source has w blocks.

Sources run out. Phases of 1, 1, 2, 4, 8 ... periods follow each other, each planned for the sources that still have blocks as it
begins; slots of a source that runs out inside a phase stay empty, which leaves the order of the others and their shares of
each period as they are. So phases are few, a block's slot is a closed form of its number, and the plan has a row for each
source, unit of weight and phase, whatever the number of blocks. No document is left out or repeated.

Without given weights a source's weight grows with the square root of its volume, up to UNITS, so that the main source
is held back and small ones are seen more often. The driver gets a row for each source; sources number thousands.

Ranks inside a source come from counts of digest prefixes: a source with a third of all rows is dealt over groups, each
numbered on its own, with the counts of the groups before added.

Edge cases: a null source is a source of its own, named ''; sources without a given weight get DEFAULT_WEIGHT; null
and empty texts have no volume and stay in the block at their place; a document longer than a block fills several;
repeated rows have neighbouring places; rows with a null id are dealt by their texts; an empty table gives an empty
result; further columns, of any name, pass through mixed().
"""

from __future__ import annotations

import heapq
import json
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.llm.shared import bounded, table, written

BLOCK_CHARS = 200_000
DEFAULT_WEIGHT = 1
#: The weight of the largest source, if weights come from volumes.
UNITS = 16
#: Hexadecimal digits of the digest that deal a source's documents into groups.
PREFIX = 3
#: At most so many rows of schedule are broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 50_000


def tempered(volumes: dict[str, int]) -> dict[str, int]:
    """Weights that grow with the square root of the volume."""
    most = max(volumes.values(), default=0)
    return {s: max(1, round(UNITS * math.sqrt(v / most))) if most else 1 for s, v in volumes.items()}


def period(weights: list[tuple[str, int]]) -> list[tuple[str, int, int]]:
    """One period of the schedule: source, its block in the period, slot. Depends on weights alone."""
    total = sum(w for _, w in weights)
    due = lambda j, w: -(-(j + 1) * total // w)
    waiting: list[list] = [[] for _ in range(total)]  # blocks by the slot of their release
    waiting[0] = [(due(0, w), -w, s, 0) for s, w in weights] if total else []
    ready: list[tuple[int, int, str, int]] = []
    out = []
    for slot in range(total):
        for x in waiting[slot]:
            heapq.heappush(ready, x)
        _, minus, source, j = heapq.heappop(ready)
        out.append((source, j, slot))
        w, j = -minus, j + 1
        if j < w:
            released = j * total // w
            if released <= slot:
                heapq.heappush(ready, (due(j, w), minus, source, j))
            else:
                waiting[released].append((due(j, w), minus, source, j))
    return out


def schedule(blocks: dict[str, int], weights: dict[str, int], default: int = DEFAULT_WEIGHT) -> list[tuple[str, int, int, int, int, int, int]]:
    """Rows (source, weight, place in the period, slot of that place, phase, period length, first slot of the phase).

    Block j of a source is in period q = j div weight, at place j mod weight, and in phase 0 if q = 0, else 1 + floor(log2(q));
    the phase begins with period 2^(phase-1) (0: with period 0). Its slot is first slot + (q - that) * period length + slot.
    """
    w = {s: weights.get(s, default) for s in blocks}
    if any(x < 1 for x in w.values()):
        raise ValueError("weights are whole numbers from 1 on")
    rows, at, phase, begin = [], 0, 0, 0
    while live := sorted(s for s, b in blocks.items() if b > w[s] * begin):
        plan = period([(s, w[s]) for s in live])
        rows += [(s, w[s], j, slot, phase, len(plan), at) for s, j, slot in plan]
        at += max(1, begin) * len(plan)
        phase, begin = phase + 1, max(1, 2 * begin)
    return rows


def _rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """The schedule as a table, from literals of bounded length."""
    names = ("_s", "weight", "place", "slot", "phase", "period", "base")
    schema = "array<struct<_s:string,weight:bigint,place:bigint,slot:bigint,phase:int,period:bigint,base:bigint>>"
    some = lambda part: spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps([dict(zip(names, r, strict=True)) for r in part])), schema)))
    return reduce(DataFrame.union, [some(rows[k : k + 10_000]) for k in range(0, max(1, len(rows)), 10_000)])


def _digest(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat_ws(":", doc_id.cast("string"), F.xxhash64(text).cast("string")))


def placed(rows: DataFrame, block_chars: int) -> DataFrame:
    """rows (columns _s source, _d digest, _v volume, _id) with _block and _rank, the place in the source."""
    rows = rows.withColumn("_p", F.substring("_d", 1, PREFIX))
    w = Window.partitionBy("_s", "_p").orderBy("_d", "_id", "_v")
    inner = rows.withColumns({"_rank": F.row_number().over(w).cast("long"), "_upto": F.sum("_v").over(w.rowsBetween(Window.unboundedPreceding, 0))})
    groups = rows.groupBy("_s", "_p").agg(F.count("*").alias("_n"), F.sum("_v").alias("_vol"))
    g = Window.partitionBy("_s").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    before = groups.select("_s", "_p", F.coalesce(F.sum("_n").over(g), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_vol").over(g), F.lit(0)).alias("_v0"))
    at = inner.join(before, ["_s", "_p"])
    return at.withColumns({"_rank": F.col("_rank") + F.col("_n0"), "_block": F.floor((F.col("_upto") - F.col("_v") + F.col("_v0")) / block_chars)})


def slotted(spark: SparkSession, docs: DataFrame, payload: list[str], weights: dict[str, int] | None = None, block_chars: int = BLOCK_CHARS, default: int = DEFAULT_WEIGHT) -> DataFrame:
    """For each row of docs: _row (struct of the payload columns), source, block, slot and rank, its place in its source."""
    source, volume = F.coalesce(F.col("source").cast("string"), F.lit("")), F.coalesce(F.length("text"), F.lit(0)).cast("long")
    totals = {r["_s"]: r["v"] for r in docs.select(source.alias("_s"), volume.alias("_v")).groupBy("_s").agg(F.sum("_v").alias("v")).collect()}  # a row for each source
    weights = tempered(totals) if weights is None else weights
    plan = bounded(written(spark, _rows(spark, schedule({s: v // block_chars + 1 for s, v in totals.items()}, weights, default)), "schedule"), BROADCAST_ROWS)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in payload]).alias("_row"), F.col("doc_id").alias("_id"), source.alias("_s"), _digest(F.col("doc_id"), F.col("text")).alias("_d"), volume.alias("_v"))
    at = placed(rows, block_chars)
    of_source = bounded(plan.select("_s", "weight").distinct(), BROADCAST_ROWS)
    at = at.join(of_source, "_s").withColumn("_q", F.expr("_block div weight"))
    at = at.withColumn("_phase", F.when(F.col("_q") == 0, 0).otherwise(F.length(F.bin("_q"))))
    found = at.alias("d").join(plan.alias("p"), F.expr("d._s = p._s AND d._phase = p.phase AND d._block % d.weight = p.place"))
    begin = F.when(F.col("d._phase") == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("d._phase") - 1))
    slot = F.col("p.base") + (F.col("d._q") - begin) * F.col("p.period") + F.col("p.slot")
    return found.select("d._row", F.col("d._s").alias("source"), F.col("d._block").alias("block"), slot.alias("slot"), F.col("d._rank").alias("rank"))


def mixed(spark: SparkSession, docs: DataFrame, weights: dict[str, int] | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """docs sorted by slot and place: files written from it, read in order, hold the mix."""
    rows = slotted(spark, docs, docs.columns, weights, block_chars)
    return rows.orderBy("slot", "rank").select("_row.*")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return slotted(spark, docs, ["doc_id"]).select("_row.doc_id", "source", "block", "slot", "rank")
