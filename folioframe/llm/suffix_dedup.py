"""Removal of byte strings of a given length that occur more than once, from merged Burrows-Wheeler transforms.

1. Anchors. Every string of LENGTH bytes is filed under the least-hashed GRAM-byte string inside it, so two equal
   strings are filed alike and at the same distance from it. Neighbouring strings with one anchor form a segment.
   Anchors that occur once in all documents hold no repeat and go; counts are aggregated before they're shuffled.
2. Segments. What is left is named by a digest, and equal segments are counted by name: one that occurs twice is repeated
   as a whole. (Inside a segment no string repeats, as its distance from the anchor tells each apart.) An anchor
   all of whose segments are equal is done with that. Of the other anchors' segments one copy each is cut from the texts, with
   its multiplicity, and dealt by anchor: all strings that could be equal are now in the same task, and in the same key group.
3. Transforms. The segments of a task are read as strings over symbols of STEP bytes, one string for each of the STEP
   places to begin at, so every byte begins a suffix. Shards of bounded size get their suffixes sorted and give a transform each (the
   symbol before each suffix in sorted order). Merging knows the transforms alone: it starts with the shards one after
   another and refines the interleave LENGTH / STEP times, by one stable pass over the merged symbols. After round h
   suffixes are in order by h symbols, and the round that parts two neighbours tells the length of their common prefix.
   Runs that share LENGTH bytes are the repeated intervals; those of two or more occurrences mark their suffixes.
4. The marks go back to the documents, where marked strings' bytes are removed.

An anchor whose different segments have more than KEY_BYTES together files each of its strings under that string's own
digest instead, and strings are counted by it, so a passage that a third of all documents share spreads over tasks.
A merge takes MERGE_BYTES and one key group at most, about 140 bytes of memory for each byte. Names that occur more than HOT
times are joined by broadcast, as there are few.

Edge cases: a null or empty text has nothing to remove, nor have texts shorter than LENGTH; matches never cross
documents; repeated rows are documents of their own, so a long enough text that is there twice is removed from both;
equal doc_ids are told apart by their texts, and a null doc_id is one like any other; very long texts are anchored in
blocks; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm.shared import discard, table, written

LENGTH, GRAM, STEP = 200, 64, 50
#: Starts that are anchored at a time in long texts.
CHUNK = 1 << 20
#: Keys and names with more occurrences are joined by broadcast, if they are no more than BROADCAST_ROWS.
HOT, BROADCAST_ROWS = 20_000, 50_000
#: Bytes of segments to a shard, to one merge, and of the different segments of an anchor to merge.
SHARD_BYTES, MERGE_BYTES, KEY_BYTES = 1 << 18, 1 << 20, 1 << 20

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BYTE = np.random.default_rng(4_096).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ (a >> np.uint64(32))) * _A + b * _B
    return h ^ (h >> np.uint64(29))


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all strings of a number of bytes, by doubling."""
    h, n = _BYTE[data], 1
    while 2 * n <= size:
        h, n = _join(h[:-n], h[n:]), 2 * n
    if n < size:
        h = _join(h[: len(h) - (size - n)], h[size - n :])
    return h


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x, n = np.minimum(x[:-n], x[n:]), 2 * n
    if n < width:
        x = np.minimum(x[: len(x) - (width - n)], x[width - n :])
    return x


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, first start and number of starts of each segment."""
    out = []
    for base in range(0, len(data) - LENGTH + 1, CHUNK):
        part = np.frombuffer(data, np.uint8, min(len(data) - base, CHUNK + LENGTH - 1), base)
        h = gram_hashes(part, GRAM)
        place = _sliding_min((h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64), LENGTH - GRAM + 1) & np.uint64(0xFFFFFFFF)
        place = place.astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
        count = np.diff(np.append(first, len(place)))
        out.append((h[place[first]].view(np.int64), first + base, count))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, np.int64),) * 3


def found_anchors(docs: DataFrame) -> DataFrame:
    """key, doc_id, text_hash and place (first start and number of starts in one number) of all segments."""

    def each(batches):
        for batch in batches:
            keys, ids, hashes, places = [], [], [], []
            for doc_id, text, h in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                key, start, count = anchors(text.encode() if text else b"")
                if len(key):
                    keys.append(key)
                    places.append(start << 10 | count)
                    ids += [doc_id] * len(key)
                    hashes.append(np.full(len(key), h))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(ids, pa.int64()), pa.array(np.concatenate(hashes), pa.int64()), pa.array(np.concatenate(places))], names=["key", "doc_id", "text_hash", "place"])

    return docs.mapInArrow(each, "key bigint, doc_id bigint, text_hash bigint, place bigint")


def pieces(docs: DataFrame) -> DataFrame:
    """key, name (digest), doc_id, text_hash, start and size (starts) of every segment of docs (with the array places)."""

    def each(batches):
        for batch in batches:
            keys, names, ids, hashes, at = [], [], [], [], []
            places = batch.column(3)
            for doc_id, h, text, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), places, strict=True):
                data, found = text.encode(), found.values
                place = found.field(1).to_numpy()
                keys.append(found.field(0).to_numpy())
                names += [xxhash.xxh3_128_digest(data[a : a + n + LENGTH - 1]) for a, n in zip((place >> 10).tolist(), (place & 1023).tolist(), strict=True)]
                at.append(place)
                ids += [doc_id] * len(place)
                hashes += [h] * len(place)
            at = np.concatenate(at) if at else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys) if keys else [], pa.int64()), pa.array(names, pa.binary()), pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(at >> 10), pa.array((at & 1023).astype(np.int32))], names=["key", "name", "doc_id", "text_hash", "start", "size"])

    return docs.select("doc_id", "text_hash", "text", "places").mapInArrow(each, "key bigint, name binary, doc_id bigint, text_hash bigint, start bigint, size int")


def cut_out(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, name, data and copies of wanted segments (key, name, doc_id, text_hash, start, size, copies), from the texts."""

    def each(batches):
        for batch in batches:
            rows = []
            for text, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = text.encode()
                rows += [(x["key"], x["name"], data[x["start"] : x["start"] + x["size"] + LENGTH - 1], x["copies"]) for x in found]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary(), pa.int64()))], names=["key", "name", "data", "copies"])

    keys = ["id", "none", "text_hash"]  # without nulls, so that the join's partitioning serves the next step too
    keyed = lambda df, *more: df.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), "text_hash", *more)
    of_doc = keyed(wanted, F.struct("key", "name", "start", "size", "copies").alias("x")).groupBy(*keys).agg(F.collect_list("x").alias("found"))
    texts = keyed(docs, "text").join(of_doc, keys).dropDuplicates(keys)  # repeated rows have the same segments
    return texts.select("text", "found").mapInArrow(each, "key bigint, name binary, data binary, copies bigint")


def _same():
    return F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))


def string_marks(cut: DataFrame, spark: SparkSession) -> DataFrame:
    """name and runs of repeated starts of segments (as cut_out() gives them), their strings counted one by one."""

    def strings(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                names, digests, places, copies = [], [], [], []
                for name, data, n in zip(*(batch.column(k).slice(at, 512).to_pylist() for k in range(3)), strict=True):
                    size = len(data) - LENGTH + 1
                    digests += [xxhash.xxh3_128_digest(data[k : k + LENGTH]) for k in range(size)]
                    places += range(size)
                    names += [name] * size
                    copies += [n] * size
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.binary()), pa.array(places, pa.int32()), pa.array(copies, pa.int64())], names=["name", "string", "place", "copies"])

    def runs(batches):
        for batch in batches:
            found = [_runs(np.sort(np.array(x, np.int64))) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["name", "runs"])

    rows = written(spark, cut.select("name", "data", "copies").mapInArrow(strings, "name binary, string binary, place int, copies bigint"), "strings")
    often = rows.groupBy("string").agg(F.sum("copies").alias("n"), F.count("*").alias("m")).where("n > 1")
    found = _joined(rows.where("copies = 1"), written(spark, often, "repeated"), "string", "m")
    return found.groupBy("name").agg(F.collect_list("place").alias("places")).mapInArrow(runs, "name binary, runs array<int>")


def _joined(rows: DataFrame, values: DataFrame, key: str, count: str) -> DataFrame:
    """rows joined with the values of a key, which has count rows: by broadcast where there are many, else by a shuffle."""
    hot = values.where(F.col(count) > HOT)
    if not 0 < hot.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(values, key)
    few = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(values.where(F.col(count) <= HOT), key)
    return few.unionByName(rows.join(F.broadcast(hot), key))


def _stable_order(ranks: np.ndarray) -> np.ndarray:
    """Stable order of ranks under 2^32, in passes of 16 bits."""
    order = np.argsort((ranks & 0xFFFF).astype(np.uint16), kind="stable")
    if ranks.size and ranks.max() >> 16:
        order = order[np.argsort((ranks[order] >> 16).astype(np.uint16), kind="stable")]
    return order


class Shard:
    """The transform of some segments: for suffixes in sorted order, the symbol before each.

    order: the suffixes' byte places among the shard's segments, sorted by LENGTH bytes; before: the symbols before
    them; ends: how many suffixes have no whole symbol, all of which come first; segment, within: of each byte place.
    """

    def __init__(self, pieces: list[bytes], copies: list[int]):
        sizes = np.array([len(p) + 1 for p in pieces])  # with the empty suffix
        first = np.concatenate([[0], np.cumsum(sizes)])
        data = np.frombuffer(b"\0".join([*pieces, b""]), np.uint8)
        n = len(data)
        self.segment = np.repeat(np.arange(len(pieces)), sizes)
        self.within = np.arange(n) - first[self.segment]
        left = sizes[self.segment] - 1 - self.within
        self.whole = left >= LENGTH
        self.weight = np.asarray(copies)[self.segment]
        symbols = np.zeros(n, np.uint64)
        h = gram_hashes(data, STEP)
        symbols[: len(h)] = h | np.uint64(1)
        symbols[left < STEP] = 0
        _, ranks = np.unique(symbols, return_inverse=True)  # 0 where there's no whole symbol
        order = None
        for k in range(LENGTH // STEP - 1, -1, -1):  # the last symbol is the least important
            column = np.zeros(n, ranks.dtype)
            column[: n - k * STEP] = ranks[k * STEP :]
            column[left <= k * STEP] = 0
            order = _stable_order(column) if order is None else order[_stable_order(column[order])]
        self.order = order
        self.ends = int((left < STEP).sum())
        before = np.zeros(n, np.uint64)
        before[STEP:] = symbols[:-STEP]
        before[self.within < STEP] = 0
        self.before = before[self.order]


def merge(shards: list[Shard]) -> tuple[np.ndarray, np.ndarray]:
    """Interleave (shard of each suffix in merged order) and common prefix.

    The common prefix of each suffix with the one before it is in symbols. Only the shards' transforms are read.
    """
    before = np.concatenate([s.before for s in shards])
    known, ranks = np.unique(before, return_inverse=True)
    none = len(known) and known[0] == 0
    n = len(before)
    ends = np.repeat(np.arange(len(shards)), [s.ends for s in shards])
    interleave = np.repeat(np.arange(len(shards)), [len(s.before) for s in shards])
    block = np.zeros(n, np.int64)
    common = np.full(n, LENGTH // STEP, np.int64)
    common[:1] = 0
    for h in range(LENGTH // STEP):
        # the next unread symbol of each shard, in merged order
        symbol = np.empty(n, ranks.dtype)
        symbol[_stable_order(interleave)] = ranks
        order = _stable_order(symbol)
        if none:
            order = order[int((symbol == 0).sum()) :]
        symbol, source = symbol[order], block[order]
        new = np.ones(n, bool)
        k = len(ends)
        new[k + 1 :] = (symbol[1:] != symbol[:-1]) | (source[1:] != source[:-1])
        interleave = np.concatenate([ends, interleave[order]])
        common[new & (common > h)] = h
        block = np.cumsum(new) - 1
    return interleave, common


def repeated(pieces: list[bytes], copies: list[int]) -> list[np.ndarray]:
    """For each segment, its starts whose LENGTH bytes occur at least twice."""
    shards, shard, size, first = [], [], 0, [0]
    for k, p in enumerate(pieces):
        shard.append(p)
        size += len(p)
        if size >= SHARD_BYTES or k == len(pieces) - 1:
            shards.append(Shard(shard, copies[first[-1] : k + 1]))
            first.append(k + 1)
            shard, size = [], 0
    interleave, common = merge(shards)
    block = np.cumsum(common < LENGTH // STEP)  # the repeated intervals: runs with a long enough common prefix
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(pieces)
    weight = np.zeros(len(block), np.int64)
    whole = np.zeros(len(block), bool)
    places = [np.flatnonzero(interleave == k) for k in range(len(shards))]
    for at, s in zip(places, shards, strict=True):
        weight[at], whole[at] = s.weight[s.order], s.whole[s.order]
    total = np.bincount(block, weights=weight)[block]
    marked = whole & (total >= 2)
    for at, s, base in zip(places, shards, first, strict=False):
        hit = s.order[marked[at]]
        hit = np.sort(hit)
        seg, where = s.segment[hit], s.within[hit]
        cut = np.flatnonzero(np.diff(seg)) + 1
        for part, starts in zip(np.split(seg, cut), np.split(where, cut), strict=True):
            if len(part):
                out[base + part[0]] = starts
    return out


def _runs(starts: np.ndarray) -> list[int]:
    """First and last of each run of consecutive starts, one after another."""
    cut = np.flatnonzero(np.diff(starts) != 1)
    first, last = np.append(starts[:1], starts[cut + 1]), np.append(starts[cut], starts[-1:])
    return np.stack([first, last], 1).ravel().tolist()


def marks(found: DataFrame) -> DataFrame:
    """name and runs of repeated starts of the segments of one copy that have any. A key's segments share a task and a merge."""

    def each(batches):
        names, pieces, copies, size, last = [], [], [], 0, None

        def flush():
            done = [(n, _runs(s)) for n, s, c in zip(names, repeated(pieces, copies), copies, strict=True) if len(s) and c == 1]
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done], pa.list_(pa.int32()))], names=["name", "runs"])

        for batch in batches:
            for name, key, data, n in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if size >= MERGE_BYTES and key != last:
                    yield flush()
                    names, pieces, copies, size = [], [], [], 0
                names.append(name)
                pieces.append(data)
                copies.append(n)
                size += len(data)
                last = key
        if names:
            yield flush()

    rows = found.repartition("key").sortWithinPartitions("key", "name")
    return rows.select("name", "key", "data", "copies").mapInArrow(each, "name binary, runs array<int>")


def _cut(data: bytes, starts: list[int], runs: list[list[int]]) -> tuple[bytes, int, int]:
    """The bytes that stay, and how many bytes go in how many runs."""
    spans = sorted((s + r[k], s + r[k + 1] + LENGTH) for s, r in zip(starts, runs, strict=True) for k in range(0, len(r), 2))
    kept, at, gone, n = [], 0, 0, 0
    end = -1
    for a, b in spans:
        if a > end:
            kept.append(data[at:a])
            n += 1
            gone += b - a
            at = end = b
        elif b > end:
            gone += b - end
            at = end = b
    return b"".join([*kept, data[at:]]), gone, n


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _finished(docs: DataFrame, text: bool) -> DataFrame:
    """The result, from columns doc_id, text, starts, runs (null: nothing goes); with the text that stays if asked for."""

    def each(batches):
        for batch in batches:
            rows = []
            for text_, starts, runs in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                data = text_.encode() if text_ else b""
                kept, gone, n = _cut(data, starts, runs) if starts else (data, 0, 0)
                rows.append((len(data), gone, n, hashlib.sha256(kept).hexdigest(), *((kept,) if text else ())))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *((pa.binary(),) if text else ())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(("kept_bytes",) if text else ())])

    return docs.select("doc_id", "text", "starts", "runs").mapInArrow(each, RESULT + (", kept_bytes binary" if text else ""))


def repeated_runs(spark: SparkSession, may: DataFrame, found: DataFrame, key_bytes: int = KEY_BYTES) -> DataFrame:
    """name, runs and m (occurrences) of the segments (found: as pieces() gives them) that hold repeated strings."""
    first = F.min(F.struct("doc_id", "text_hash", "start", "size")).alias("x")
    names = written(spark, found.groupBy("key", "name").agg(F.count("*").alias("copies"), first).select("key", "name", "copies", "x.*"), "names")
    several = names.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.col("size") + LENGTH - 1).alias("bytes")).where("n > 1")
    several = written(spark, several.select("key", (F.col("bytes") > key_bytes).alias("big"), "n"), "mixed")
    mixed = _joined(names, several, "key", "n")
    cut = written(spark, cut_out(may, mixed.where("NOT big").select(*names.columns)), "segments")
    by_merge = marks(cut)
    by_string = string_marks(cut_out(may, mixed.where("big").select(*names.columns)), spark)
    whole = names.where("copies > 1").select("name", F.array(F.lit(0), F.col("size") - 1).alias("runs"), F.col("copies").alias("m"))
    runs = written(spark, whole.union(by_merge.union(by_string).select("name", "runs", F.lit(1).cast("long").alias("m"))), "marks")
    discard(spark, names, several, cut)
    return runs


def remove_repeats(spark: SparkSession, docs: DataFrame, text: bool = False, key_bytes: int = KEY_BYTES) -> DataFrame:
    """One row for each document: how much was removed, and a digest of what stays; with text, what stays too."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    anchored = written(spark, found_anchors(rows), "anchors")
    often = written(spark, anchored.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "often")
    of_doc = _joined(anchored, often, "key", "n").groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("key", "place")).alias("places")).withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    joined = written(spark, rows.join(of_doc, _same(), "left").drop("_id", "_hash"), "candidates")
    discard(spark, anchored, often)
    may = joined.where("places IS NOT NULL")
    found = written(spark, pieces(may), "pieces")
    runs = repeated_runs(spark, may, found, key_bytes)
    hit = _joined(found.select("name", "doc_id", "text_hash", "start"), runs, "name", "m")
    at = hit.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "runs")).alias("x")).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("x.start").alias("starts"), F.col("x.runs").alias("runs"))
    some = _finished(may.join(at, _same(), "left"), text)
    nothing = joined.where("places IS NULL").select("doc_id", "text", F.lit(None).cast("array<bigint>").alias("starts"), F.lit(None).cast("array<array<int>>").alias("runs"))
    return some.union(_finished(nothing, text))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark, table(spark, sf_dir, "documents"))
