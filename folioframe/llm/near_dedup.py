"""Near-duplicate documents by a MinHash LSH forest.

A document's set holds the 64-bit hashes of its distinct 4-word shingles. Documents with equal sets form a class. A
class has TREES signatures of DEPTH minimum hashes each; sorting the classes by each signature gives the forest's
trees. In a sorted order the classes that agree with one on the longest prefix stand next to it, so the candidates are
the stretches of neighbours that agree on SHALLOW values at least. A stretch of more than LEAF classes is crowded and
is split where neighbours agree on fewer than one value more, and so on down to DEPTH: each region is searched at the
depth that it needs. Orders are dealt by ranges of signature and class, so a crowded region spreads over tasks, and
read as a stream, of which a task holds a batch and a stretch.

1. All pairs in a stretch are estimated from whole signatures. Pairs that may reach the threshold are confirmed on the full
   sets: not pair by pair, but by groups of classes that such pairs connect, in all trees if the group fits a task
   (GROUP_SHINGLES, GROUP_MEMBERS), else in each stretch (one of too many shingles is dealt over tasks two parts at a
   time). A group gives a spanning forest of its links, so rows grow with the classes, not with their pairs. Links make
   components.
2. Stretches of more than LEAF classes that agree on DEPTH values are cut in the first step, and so is a stretch that
   goes over the border of two tasks. Their classes are searched again together, all pairs of different components but
   those that a group has settled, in tasks of BLOCK classes a side.

Every pair that agrees on the needed depth in a tree is thus estimated. A pair at 0.8 is missed with a chance of 3e-11
where stretches are not crowded (three values) and 6e-5 at the full depth; or if its estimate is low by six standard errors.
Where many components agree on DEPTH values and no link joins them, the work grows with the square of their number.
(A stretch that goes over both borders of a task of fewer than LEAF rows isn't joined beyond it; tasks are made larger.)

Edge cases: a null or empty text, or one of white space, has an empty set and no links; fewer words than a shingle
make one shingle; repeated rows have equal sets and so are linked, each with its own row; a null doc_id is in a class
like any other, but isn't the least id unless there's no other; ties of a component's least id go to the row whose text
has the lowest hash; an empty table gives an empty result; very long texts are hashed in blocks; further columns, of any
name, pass through keep_one().
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm.components import components, connected
from folioframe.llm.shared import bounded, job, table, written

SHINGLE = 4
PERCENT = 80
TREES, DEPTH, SHALLOW = 32, 6, 3
#: A stretch of more classes is split at a greater depth.
LEAF = 256
#: Pairs with a lower estimate are dropped: six standard errors under the threshold.
LEAST_ESTIMATE = 0.625
#: Classes of cut stretches are dealt in blocks of about so many, each pair of blocks a task of its own.
BLOCK = 512
#: Shingles of the sets that are confirmed in one go, if there are more than two.
GROUP_SHINGLES = 2_000_000
#: Rows that make a task of its own worth while.
TASK_ROWS = 20_000
#: Pairs that are estimated at once.
PAIRS_AT_ONCE = 16_000
#: Classes of one such group, so that all its pairs can be counted at once.
GROUP_MEMBERS = 4096
#: Cells of the matrix in which common shingles are counted.
MATRIX_CELLS = 4_000_000
#: At most so many cut stretches are broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 50_000
#: A task forgets its words' hashes when it has so many.
CACHE_WORDS = 200_000

_M = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


class _Words(dict):
    def __missing__(self, word):
        if len(self) > CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, size: int = SHINGLE, known: dict | None = None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; known: hashes of words (a _Words)."""
    known = _Words() if known is None else known
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if len(h) < size:
        joined = b" ".join(words)
        return np.array([xxhash.xxh3_64_intdigest(joined, seed=len(words))], np.uint64)
    n = len(h) - size + 1
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = _mix(total + h[k : k + n] * _M[k % len(_M)] + np.uint64(k))
    return np.unique(total)


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(20_240).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(hashes: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """16 bits of the minimum under each hash function."""
    low = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), 2048):
        np.minimum(low, (hashes[None, k : k + 2048] * multipliers[:, None]).min(1), out=low)
    return (_mix(low) >> np.uint64(48)).astype(">u2")


def signed(docs: DataFrame, size: int = SHINGLE, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """doc_id, text_hash, n_shingles, cls (digest of the set, null if empty) and sig of each document."""

    def each(batches):
        multipliers, known = _multipliers(trees * depth), _Words()
        for batch in batches:
            sizes, keys, sigs = [], [], []
            for at in range(0, batch.num_rows, 256):
                for text in batch.column(1).slice(at, 256).to_pylist():
                    s = shingles(text, size, known)
                    sizes.append(len(s))
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    sigs.append(signature(s, multipliers).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], names=["doc_id", "text_hash", "n_shingles", "cls", "sig"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(each, "doc_id bigint, text_hash bigint, n_shingles bigint, cls binary, sig binary")


def _runs(agreed: np.ndarray, closed: bool, depth: int, shallow: int, leaf: int) -> tuple[list[tuple[int, int, bool]], int]:
    """Stretches (start, end, cut) of sorted rows, and the place from which rows must wait for those to come.

    agreed: the number of values on which each row agrees with the one before it; closed: no rows follow. Stretches
    of a single row are left out.
    """
    n, out = len(agreed), []
    if not n:
        return out, 0
    starts = np.append(0, np.flatnonzero(agreed[1:] < shallow) + 1)
    ends = np.append(starts[1:], n)
    some = ends - starts > 1
    for start, end in zip(starts[some].tolist(), ends[some].tolist(), strict=True):
        whole = closed or end < n
        while end - start > leaf:
            near = agreed[start + 1 : start + leaf + 1]
            for d in range(shallow + 1, depth + 1):
                apart = np.flatnonzero(near < d)
                if len(apart):
                    stop, cut = start + 1 + int(apart[0]), False
                    break
            else:
                stop, cut = start + leaf, True
            if stop - start > 1:
                out.append((start, stop, cut))
            start = stop
        if not whole:
            return out, start
        if end - start > 1:
            out.append((start, end, False))
    return out, n if closed else int(starts[-1])


def _digest_of(parts: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b"".join(sorted(parts)))


def stretches(classes: DataFrame, trees: int, depth: int, shallow: int, leaf: int) -> DataFrame:
    """cut, cell and cls: the classes of each stretch of the sorted orders; cut: those of stretches to be searched again.

    A cell's name is a digest of its classes, so a stretch that several trees have is one; that of a cut stretch is a
    digest of tree and prefix.
    """
    step = 2 * depth
    key = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.concat(F.unhex(F.lpad(F.hex(t), 2, "0")), F.substring(F.col("sig"), t * step + 1, F.lit(step))))
    rows = classes.select("cls", F.explode(key).alias("key")).select("key", "cls")
    parts = min(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + classes.count() * trees // TASK_ROWS)
    rows = rows.repartitionByRange(parts, "key", "cls").sortWithinPartitions("key", "cls")
    width = step + 1

    def agreement(keys: np.ndarray) -> np.ndarray:
        same = np.logical_and.accumulate(keys[1:] == keys[:-1], 1)
        return np.append(-1, (same.sum(1) + 1) // 2 - 1)

    def each(batches):
        keys, cls = np.empty((0, width), np.uint8), np.empty((0, 16), np.uint8)
        head = tail = None  # up to leaf rows at the borders of the task
        crowded = None  # the key of the last cut stretch
        task = TaskContext.get().partitionId()
        out: list[tuple[bool, bytes, list[bytes]]] = []

        def border(k: np.ndarray, c: np.ndarray, number: int) -> None:
            """Rows beside a border (the first row stands at it) that agree with the row there."""
            agreed = (np.logical_and.accumulate(k == k[:1], 1).sum(1) + 1) // 2 - 1
            prefix = k[0, : 2 * shallow + 1].tobytes() + number.to_bytes(4, "big")
            out.append((True, xxhash.xxh3_128_digest(prefix), _names(c[agreed >= shallow])))
            out.append((True, xxhash.xxh3_128_digest(k[0].tobytes()), _names(c[agreed >= depth])))

        def taken(closed: bool) -> int:
            nonlocal crowded
            agreed = agreement(keys)
            found, upto = _runs(agreed, closed, depth, shallow, leaf)
            full = {} if crowded is None else {crowded: None}  # keys of cut stretches
            for start, end, cut in found:
                names = _names(cls[start:end])
                out.append((False, _digest_of(names), names))
                if cut:
                    crowded = keys[start].tobytes()
                    full[crowded] = None
            for key in full:
                if (same := (keys[:upto] == np.frombuffer(key, np.uint8)).all(1)).any():
                    out.append((True, xxhash.xxh3_128_digest(key), _names(cls[:upto][same])))
            return upto

        def batch_of_out():
            sizes = [len(names) for *_, names in out]
            flat = [c for *_, names in out for c in names]
            cut = np.repeat([x for x, *_ in out], sizes)
            cell = [x for (_, x, names) in out for _ in names]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(cut, pa.bool_()), pa.array(cell, pa.binary()), pa.array(flat, pa.binary())], names=["cut", "cell", "cls"])

        for batch in batches:
            if not batch.num_rows:
                continue
            k = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, width)
            c = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, 16)
            if head is None or len(head[0]) < leaf:
                head = (k[:leaf], c[:leaf]) if head is None else tuple(np.concatenate(x)[:leaf] for x in zip(head, (k, c), strict=True))
            tail = (k[-leaf:], c[-leaf:]) if tail is None else tuple(np.concatenate(x)[-leaf:] for x in zip(tail, (k[-leaf:], c[-leaf:]), strict=True))
            keys, cls = np.concatenate([keys, k]), np.concatenate([cls, c])
            upto = taken(False)
            keys, cls = keys[upto:], cls[upto:]
            if out:
                yield batch_of_out()
        if head is not None:
            taken(True)
            border(*head, task)
            border(tail[0][::-1], tail[1][::-1], task + 1)
            yield batch_of_out()

    return rows.mapInArrow(each, "cut boolean, cell binary, cls binary")


def _names(cls: np.ndarray) -> list[bytes]:
    data = cls.tobytes()
    return [data[k : k + 16] for k in range(0, len(data), 16)]


def _by_cell(batches, column: int) -> Iterator[pa.Table]:
    """Tables of whole cells (rows with equal values of a column, which stand together), a batch or so each."""
    waiting = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        waiting = part if waiting is None else pa.concat_tables([waiting, part])
        names = waiting.column(column)
        last = names[len(names) - 1]
        if names[0] == last:
            continue
        low, high = 0, len(names) - 1  # the first row of the last cell
        while low < high:
            at = (low + high) // 2
            if names[at] == last or names[at].as_py() > last.as_py():
                high = at
            else:
                low = at + 1
        yield waiting.slice(0, low)
        waiting = waiting.slice(low)
    if waiting is not None:
        yield waiting


def promising(cells: DataFrame, percent: int, group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """grp and cls: groups of classes of a cell that pairs connect whose estimates reach the least.

    cells: cell, side, lab, cls, n, sig. Pairs of equal labels are left out, and so are pairs on one side, but for side
    0. Groups with too many shingles for one task are dealt in parts, of which every two make a group.
    """
    rows = cells.repartition("cell").sortWithinPartitions("cell", "cls").select("cell", "side", "lab", "n", "cls", "sig")

    def groups(members: list[tuple[bytes, int]]) -> Iterator[list[bytes]]:
        members.sort()
        parts, size = [[]], 0
        for name, n in members:
            if parts[-1] and size + n > group_shingles // 2:
                parts.append([])
                size = 0
            parts[-1].append(name)
            size += n
        if len(parts) == 1:
            yield parts[0]
        for j in range(1, len(parts)):
            for i in range(j):
                yield parts[i] + parts[j]

    def each(batches):
        for whole in _by_cell(batches, 0):
            cell = whole.column("cell").combine_chunks().dictionary_encode().indices.to_numpy()
            side, lab, n = (whole.column(c).to_numpy() for c in ("side", "lab", "n"))
            names = whole.column("cls").to_pylist()
            sig = np.frombuffer(b"".join(whole.column("sig").to_pylist()), ">u2").astype(np.uint16).reshape(len(names), -1)
            starts = np.flatnonzero(np.diff(cell)) + 1
            at = np.arange(len(names))
            after = np.append(starts, len(names))[np.searchsorted(starts, at, side="right")] - at - 1  # partners behind each row
            upto, begin, lefts, rights = np.cumsum(after), 0, [], []
            while begin < len(names):
                done = upto[begin] - after[begin]
                end = max(begin + 1, int(np.searchsorted(upto, done + PAIRS_AT_ONCE, side="right")))
                x = np.repeat(np.arange(begin, end), after[begin:end])
                y = x + 1 + np.arange(len(x)) - np.repeat(upto[begin:end] - after[begin:end] - done, after[begin:end])
                begin = end
                ok = (lab[x] != lab[y]) & ((side[x] == 0) | (side[x] != side[y])) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
                x, y = x[ok], y[ok]
                ok = (sig[x] == sig[y]).mean(1) >= LEAST_ESTIMATE
                lefts.append(x[ok])
                rights.append(y[ok])
            root = connected(len(names), np.concatenate(lefts), np.concatenate(rights))
            order = np.argsort(root, kind="stable")
            cuts = np.flatnonzero(np.diff(root[order])) + 1
            grp, cls = [], []
            for part in np.split(order, cuts):
                if len(part) > 1:
                    for group in groups([(names[k], int(n[k])) for k in part]):
                        grp += [_digest_of(group)] * len(group)
                        cls += group
            yield pa.RecordBatch.from_arrays([pa.array(grp, pa.binary()), pa.array(cls, pa.binary())], names=["grp", "cls"])

    return rows.mapInArrow(each, "grp binary, cls binary").distinct()


def _linked(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of sets that reach the threshold."""
    n = np.array([len(s) for s in sets])
    if len(sets) == 2:
        same = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        ok = 100 * same >= percent * (n.sum() - same)
        return (np.array([0]), np.array([1])) if ok else (np.empty(0, int),) * 2
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    row, first = row[order], np.cumsum(times) - times
    same = np.zeros((len(sets), len(sets)), np.float32)
    rare = max(16, len(sets) // 32)
    # shingles of few sets pair by pair (of one set: in no intersection), the others as columns of a matrix
    for c in np.unique(times[(times > 1) & (times <= rare)]).tolist():
        at = first[times == c]
        x, y = np.triu_indices(c, 1)
        for k in range(0, len(at), max(1, MATRIX_CELLS // (8 * len(x)))):
            members = row[at[k : k + max(1, MATRIX_CELLS // (8 * len(x))), None] + np.arange(c)[None, :]]
            np.add.at(same, (members[:, x].ravel(), members[:, y].ravel()), 1)
    same += same.T
    often = np.flatnonzero(times > rare)
    width = max(1, MATRIX_CELLS // len(sets))
    for k in range(0, len(often), width):
        some = often[k : k + width]
        has = np.zeros((len(sets), len(some)), np.float32)
        for j, c in enumerate(some.tolist()):
            has[row[first[c] : first[c] + times[c]], j] = 1
        same += has @ has.T
    lefts, rights = [], []
    for k in range(0, len(sets), 256):  # wide numbers for a few rows at a time
        part = same[k : k + 256].astype(np.float64)
        x, y = np.nonzero(100 * part >= percent * (n[k : k + 256, None] + n[None, :] - part))
        lefts.append(x[x + k < y] + k)
        rights.append(y[x + k < y])
    return np.concatenate(lefts), np.concatenate(rights)


def regrouped(spark: SparkSession, groups: DataFrame, classes: DataFrame, group_shingles: int = GROUP_SHINGLES, members: int = GROUP_MEMBERS) -> DataFrame:
    """grp, cls and settled: groups with those that share classes made one, unless that is too large for a task.

    Groups of different trees overlap in most of their classes; as one, their sets are read once and not for each tree.
    A settled class is in that one group, and all pairs of it are confirmed or not with the group.
    """
    least = groups.groupBy("grp").agg(F.min("cls").alias("b"))
    roots = components(spark, groups.join(least, "grp").select(F.col("cls").alias("a"), "b"))
    nodes = roots.select(F.col("a").alias("cls"), F.col("b").alias("root")).union(roots.select("b", "b").distinct())
    sized = written(spark, nodes.join(classes.select("cls", "n"), "cls").select("root", "cls", "n"), "nodes")
    small = sized.groupBy("root").agg(((F.sum("n") <= group_shingles) & (F.count("*") <= members)).alias("small"))
    placed = written(spark, sized.join(small, "root").select(F.col("root").alias("grp"), "cls", "small"), "placed")
    large = placed.where("NOT small").select("cls")
    rest = groups.join(bounded(large, BROADCAST_ROWS), "cls", "left_semi")
    return placed.where("small").select("grp", "cls", F.lit(True).alias("settled")).union(rest.select("grp", "cls", F.lit(False)))


def confirmed(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b (a > b): links of full sets that connect all classes of a group (grp, cls) that links connect."""
    rows = groups.join(sets, "cls").select("grp", "cls", "set").repartition("grp").sortWithinPartitions("grp", "cls")

    def each(batches):
        def links(names, found):
            x, y = _linked([np.frombuffer(s, np.uint64) for s in found], percent)
            root = connected(len(names), x, y)
            at = np.flatnonzero(root != np.arange(len(names)))
            return [(names[k], names[root[k]]) for k in at]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)], names=["a", "b"])

        last, names, found, done = None, [], [], []
        for batch in batches:
            for grp, cls, set_ in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                if (grp := grp.as_py()) != last:
                    done += links(names, found) if len(names) > 1 else []
                    last, names, found = grp, [], []
                names.append(cls.as_py())
                found.append(set_.as_py())
            yield out(done)
            done = []
        if len(names) > 1:
            yield out(links(names, found))

    return rows.mapInArrow(each, "a binary, b binary").distinct()


def again(cut: DataFrame, classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Cells (as promising() takes them) of all pairs of classes of a cut stretch (cell, cls) with different labels.

    classes: cls, lab, n, sig. In a stretch the label with most classes is dealt in blocks, and so are the other classes
    together: a cell gets a block of either, or two blocks of the others. Where no label has two classes, all are others.
    """
    at = cut.distinct().join(classes.select("cls", "lab"), "cls")
    sizes = at.groupBy("cell", "lab").agg(F.count("*").alias("m")).groupBy("cell").agg(F.max(F.struct("m", "lab")).alias("top"), F.sum("m").alias("all"), F.count("*").alias("labels")).where("labels > 1")
    blocks: Callable[[Column], Column] = lambda m: F.ceil(m / block).cast("int")
    sizes = sizes.select("cell", F.when(F.col("top.m") > 1, F.col("top.lab")).alias("main"), "labels", blocks(F.col("top.m")).alias("k"), blocks(F.col("all") - F.when(F.col("top.m") > 1, F.col("top.m")).otherwise(0)).alias("q"))
    rows = at.join(bounded(sizes, BROADCAST_ROWS), "cell").withColumn("is_main", F.col("lab").eqNullSafe(F.col("main")))
    own = F.pmod(F.xxhash64("cls", F.lit(1)), F.when(F.col("is_main"), F.col("k")).otherwise(F.col("q"))).cast("int")
    rows = rows.withColumn("own", own)
    cell = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))
    own, upto = F.col("own"), lambda m: F.sequence(F.lit(0), F.col(m) - 1)
    others = F.transform(upto("q"), lambda j: cell(1, F.least(own, j), F.greatest(own, j), F.when(own == j, 0).when(own < j, 1).otherwise(2)))
    others = F.when((F.col("labels") > 2) | F.col("main").isNull(), others).otherwise(F.array().cast("array<struct<kind:int,i:int,j:int,side:int>>"))
    beside = F.when(F.col("main").isNotNull(), F.transform(upto("k"), lambda i: cell(0, i, own, F.lit(2)))).otherwise(F.array().cast("array<struct<kind:int,i:int,j:int,side:int>>"))
    cells = F.when(F.col("is_main"), F.transform(upto("q"), lambda j: cell(0, own, j, F.lit(1)))).otherwise(F.concat(beside, others))
    rows = rows.select("cls", "cell", F.explode(cells).alias("x"))
    name = F.unhex(F.md5(F.concat("cell", F.concat_ws(":", "x.kind", "x.i", "x.j").cast("binary"))))
    return rows.select("cls", name.alias("cell"), "x.side").join(classes, "cls")


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """cls and set of the wanted classes (columns cls, doc_id and text_hash of one member), from the texts."""

    def each(batches):
        known = _Words()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = [shingles(t, size, known).tobytes() for t in batch.column(0).slice(at, 256).to_pylist()]
                keys = [hashlib.blake2b(s, digest_size=16).digest() for s in found]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.binary())], names=["cls", "set"])

    ids = wanted.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    member = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").join(ids, member, "left_semi").select("text").mapInArrow(each, "cls binary, set binary")
    return found.join(wanted.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])


def clusters(spark: SparkSession, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, trees: int = TREES, depth: int = DEPTH, shallow: int = SHALLOW, leaf: int = LEAF) -> DataFrame:
    """doc_id, text_hash, n_shingles, cls and component_id, the smallest doc_id that links reach, of each document."""
    own = written(spark, signed(docs, size, trees, depth), "signatures")
    with job(spark):
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))  # the null id last
        classes = own.where("cls IS NOT NULL").groupBy("cls").agg(first.alias("x"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n"))
        classes = written(spark, classes.select("cls", "x.doc_id", "x.text_hash", "sig", "n"), "classes")

        def links_of(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
            """Confirmed links, and the settled classes with their group."""
            groups = written(spark, promising(cells, percent), "groups")
            groups = written(spark, regrouped(spark, groups, classes), "groups")
            wanted = classes.select("cls", "doc_id", "text_hash").join(groups.select("cls").distinct(), "cls", "left_semi")
            return written(spark, confirmed(groups, sets_of(docs, wanted, size), percent), "links"), groups.where("settled").select("cls", "grp")

        found = written(spark, stretches(classes, trees, depth, shallow, leaf), "stretches")
        cells = found.where("NOT cut").select("cell", "cls").distinct().join(classes.select("cls", "n", "sig"), "cls")
        links, settled = links_of(cells.select("cell", F.lit(0).alias("side"), F.xxhash64("cls").alias("lab"), "cls", "n", "sig"))
        roots = components(spark, links)
        # classes of one label need no further look at each other: they are joined, or their group is settled
        labelled = classes.select("cls", "n", "sig").join(roots.select(F.col("a").alias("cls"), "b"), "cls", "left").join(settled, "cls", "left").select("cls", "n", "sig", F.xxhash64(F.coalesce("grp", "b", "cls")).alias("lab"))
        more, _ = links_of(again(found.where("cut").select("cell", "cls"), labelled))
        if more.limit(1).count():
            roots = components(spark, roots.union(more))

        nodes = roots.select(F.col("a").alias("cls"), F.col("b").alias("root")).union(roots.select("b", "b").distinct())
        at = nodes.join(classes.select("cls", "doc_id"), "cls")
        least = at.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        of_class = classes.select("cls", "doc_id").join(at.select("cls", "root").join(least, "root").select("cls", "component_id"), "cls", "left")
        of_class = written(spark, of_class.select("cls", F.coalesce("component_id", "doc_id").alias("component_id")), "class-components", kept=True)
    columns = ("doc_id", "text_hash", "n_shingles", "cls")
    some = own.where("cls IS NOT NULL").select(*columns).join(of_class, "cls").select(*columns, "component_id")
    return some.union(own.where("cls IS NULL").select(*columns, F.col("doc_id").alias("component_id")))


def keep_one(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each component, that of the smallest doc_id, and all rows without words.

    Of rows that share that doc_id, one stays: the one whose text has the lowest hash.
    """
    found = clusters(spark, docs, **options).where("cls IS NOT NULL AND doc_id <=> component_id")
    keys = [F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("none"), "hash"]
    # without ids, each component keeps a row: the members of a class share its digest
    first = found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("cls"))).agg(F.min("text_hash").alias("hash")).select(F.col("component_id").alias("id"), "hash")
    first = written(spark, first.select(*keys).distinct(), "kept")
    words = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"), words.alias("words"))
    one = rows.where("words").select("row", *keys).join(first, ["id", "none", "hash"], "left_semi").dropDuplicates(["id", "none", "hash"])
    return one.select("row.*").union(rows.where("NOT words").select("row.*"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clusters(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
