"""SimHash near-duplicates, found by deletion variants of two halves of a fingerprint.

A fingerprint bit is 1 if it is set in more than half of the hashes of a text's shingles. Fingerprints that differ in at
most three bits agree in one of their two halves but for one bit at most, so a half is indexed by its HALF variants, each with
one bit left out: halves that differ in one bit or none have a variant in common. Equal variants meet in a sorted task
(an equality join of the variants with themselves), which verifies whole fingerprints.

Copies are one fingerprint from the start. Variants with more than CROWD fingerprints are crowded and are not compared pair by
pair: their rows leave the task as they stream by, and the other half, cut in two quarters, is indexed in the same
way, as one quarter differs in at most one bit again. What such a second variant leaves free is 18 bits, so it has at most
2 ** 18 fingerprints, and each finds its neighbours by trying all changes of up to three of those bits. A group gives a
spanning forest of its links, so rows grow with the fingerprints, never with their pairs, and no link is lost.

Edge cases: a null or empty text, or one of white space, has fingerprint zero, which links like any other; fewer words
than a shingle make one shingle; repeated rows have one fingerprint and each its own row; a null doc_id is a member like
any other, but the least id only if there's no other; an empty table gives an empty result; very long texts are hashed
in blocks; further columns, of any name, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm.components import components, connected
from folioframe.llm.shared import job, table, written

SHINGLE, SEED, BITS = 3, 42, 3
HALF, QUARTER = 32, 16
#: Fingerprints of a variant whose pairs are compared in one go.
CROWD = 4096
#: Groups of up to so many are compared many at once, in arrays of CELLS cells.
SMALL, CELLS = 32, 1 << 20
#: Shingles that are hashed in one go.
AT_ONCE = 1 << 16


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The fingerprint of a text, as an unsigned number."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)[:n].tolist()
    ends = ends[len(words) - n :].tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, AT_ONCE):
        spans = zip(starts[at : at + AT_ONCE], ends[at : at + AT_ONCE], strict=True)
        h = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n, bitorder="little").tobytes(), "little")


def signed(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the bits as a signed long) of each document."""

    def each(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                fps = np.array([fingerprint(t, size) for t in part.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(each, "doc_id bigint, fp bigint")


def _without(part: np.ndarray, width: int) -> np.ndarray:
    """For each row, its variants: each bit of a part left out in turn, with the bit's place above the part."""
    bit = np.arange(width, dtype=np.uint64)
    return (part[:, None] & ~(np.uint64(1) << bit)) | (bit << np.uint64(width))


def variants(fp: np.ndarray) -> np.ndarray:
    """64 variants of each fingerprint: 32 of either half, the half's number on top."""
    low, high = fp & np.uint64(0xFFFFFFFF), fp >> np.uint64(32)
    return np.concatenate([_without(low, HALF), _without(high, HALF) | np.uint64(1 << 62)], 1)


def finer(key: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """32 variants of the half that a variant leaves whole: 16 of either quarter."""
    other = np.where(key >> np.uint64(62) == 1, fp & np.uint64(0xFFFFFFFF), fp >> np.uint64(32))
    low, high = other & np.uint64(0xFFFF), other >> np.uint64(16)
    return np.concatenate([_without(low, QUARTER), _without(high, QUARTER) | np.uint64(1 << 30)], 1)


def _close(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of a few thousand fingerprints that differ in at most BITS bits."""
    lefts, rights = [], []
    for at in range(0, len(fp), 256):
        x, y = np.nonzero(np.bitwise_count(fp[at : at + 256, None] ^ fp[None, :]) <= BITS)
        lefts.append(x[x + at < y] + at)
        rights.append(y[x + at < y])
    return np.concatenate(lefts), np.concatenate(rights)


def _near(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for many sorted fingerprints, by trying every change of up to BITS of the bits in which they differ."""
    free = [1 << b for b in range(64) if int(np.bitwise_or.reduce(fp ^ fp[0])) >> b & 1]
    lefts, rights = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for k in range(1, BITS + 1):
        for bits in combinations(free, k):
            to = fp ^ np.uint64(sum(bits))
            at = np.minimum(np.searchsorted(fp, to), len(fp) - 1)
            hit = np.flatnonzero((fp[at] == to) & (fp < to))
            lefts.append(hit)
            rights.append(at[hit])
    return np.concatenate(lefts), np.concatenate(rights)


def _star(fp: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    root = connected(len(fp), x, y)
    far = np.flatnonzero(root != np.arange(len(fp)))
    return fp[far], fp[root[far]]


def _groups(batches, keys: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Rows of a sorted stream (key columns first, fp last): sizes of whole groups and their rows; or, with True, rows of
    a group that has more than most rows, as they come."""
    rest, crowd = np.empty((0, keys + 1), np.int64), None
    for batch in batches:
        rows = np.concatenate([rest, np.stack([batch.column(k).to_numpy() for k in range(keys + 1)], 1)])
        if not len(rows):
            continue
        if crowd is not None:  # the group before goes on
            same = int((rows[:, :keys] != crowd).any(1).argmax()) if (rows[:, :keys] != crowd).any() else len(rows)
            if same:
                yield None, rows[:same], True
            if same == len(rows):
                rest = rows[:0]
                continue
            rows, crowd = rows[same:], None
        starts = np.append(0, np.flatnonzero((rows[1:, :keys] != rows[:-1, :keys]).any(1)) + 1)
        whole = rows[: starts[-1]]
        yield np.diff(starts), whole, False
        rest = rows[starts[-1] :]
        if len(rest) > most:
            crowd = rest[0, :keys].copy()
            yield None, rest, True
            rest = rest[:0]
    if len(rest):
        yield np.array([len(rest)]), rest, False


def _small(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of many groups of equal size (a row each), as stars around a member."""
    m, n = fp.shape
    near = np.bitwise_count(fp[:, :, None] ^ fp[:, None, :]) <= BITS
    root = np.tile(np.arange(n), (m, 1))
    while True:
        new = np.where(near, root[:, None, :], n).min(2)
        if (new == root).all():
            break
        root = new
    group, far = np.nonzero(root != np.arange(n))
    return fp[group, far], fp[group, root[group, far]]


def _links(sizes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of groups that aren't crowded."""
    starts, fp = np.cumsum(sizes) - sizes, np.ascontiguousarray(rows[:, -1]).view(np.uint64)
    found = [(fp[:0], fp[:0])]
    for n in np.unique(sizes[sizes > 1]).tolist():
        own = starts[sizes == n]
        if n > SMALL:
            found += [_star(fp[at : at + n], *_close(fp[at : at + n])) for at in own.tolist()]
            continue
        step = max(1, CELLS // (n * n))
        found += [_small(fp[own[k : k + step, None] + np.arange(n)]) for k in range(0, len(own), step)]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def linked(spark: SparkSession, prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """a, b: links that connect all fingerprints (column fp, each once) that differ in at most three bits."""

    def explode(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fp = batch.column(0).slice(at, 4096).to_numpy()
                keys = variants(fp.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(fp, keys.shape[1]))], names=["key", "fp"])

    def first(batches):
        for sizes, rows, crowded in _groups(batches, 1, crowd):
            if crowded:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.ones(len(rows), bool), rows[:, 0], rows[:, 1])], names=["crowded", "a", "b"])
                continue
            large = sizes > crowd  # a group that came within one batch
            flags = np.repeat(large, sizes)
            if large.any():
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.ones(int(flags.sum()), bool), rows[flags, 0], rows[flags, 1])], names=["crowded", "a", "b"])
            found = [x.view(np.int64) for x in _links(sizes[~large], rows[~flags])]
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(found[0]), bool)), *map(pa.array, found)], names=["crowded", "a", "b"])

    def again(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                key, fp = (batch.column(k).slice(at, 4096).to_numpy() for k in (0, 1))
                fine = finer(key.view(np.uint64), fp.view(np.uint64))
                n = fine.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(key, n)), pa.array(fine.ravel().view(np.int64)), pa.array(np.repeat(fp, n))], names=["key", "fine", "fp"])

    def second(batches):
        waiting = []
        for sizes, rows, crowded in _groups(batches, 2, crowd):
            if crowded:  # at most 2 ** 18 rows of 24 bytes
                if waiting and (waiting[0][0, :2] != rows[0, :2]).any():
                    yield from many(waiting)
                    waiting = []
                waiting.append(rows)
                continue
            if waiting:
                yield from many(waiting)
                waiting = []
            large = sizes > crowd
            flags = np.repeat(large, sizes)
            for part in np.split(rows[flags], np.cumsum(sizes[large])[:-1]) if large.any() else []:
                yield from many([part])
            yield out(*_links(sizes[~large], rows[~flags]))
        if waiting:
            yield from many(waiting)

    def many(parts):
        fp = np.sort(np.concatenate(parts)[:, 2].view(np.uint64))
        yield out(*_star(fp, *_near(fp)))

    def out(a, b):
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c).view(np.int64)) for c in (a, b)], names=["a", "b"])

    rows = prints.select("fp").mapInArrow(explode, "key bigint, fp bigint").repartition("key").sortWithinPartitions("key")
    found = written(spark, rows.mapInArrow(first, "crowded boolean, a bigint, b bigint").distinct(), "links")
    links, crowds = found.where("NOT crowded").select("a", "b"), found.where("crowded").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    if not crowds.limit(1).count():
        return links
    rows = crowds.mapInArrow(again, "key bigint, fine bigint, fp bigint").repartition("key", "fine").sortWithinPartitions("key", "fine")
    return links.union(written(spark, rows.mapInArrow(second, "a bigint, b bigint").distinct(), "links")).distinct()


def clusters(spark: SparkSession, docs: DataFrame, size: int = SHINGLE, crowd: int = CROWD) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id that links reach, of each document."""
    own = written(spark, signed(docs, size), "fingerprints")
    with job(spark):
        classes = written(spark, own.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
        roots = components(spark, linked(spark, classes, crowd))
        nodes = roots.select(F.col("a").alias("fp"), F.col("b").alias("root")).union(roots.select("b", "b").distinct())
        at = written(spark, nodes.join(classes, "fp"), "nodes")
        of_print = at.join(at.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
        known = classes.join(of_print, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
        known = written(spark, known, "print-components", kept=True)
    return own.join(known, "fp").select("doc_id", "fp", "component_id")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clusters(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
