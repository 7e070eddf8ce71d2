"""Repair of conversations at the least cost, by a fold in Spark's own higher-order functions.

A repaired conversation's roles are nothing, or an optional system row and then pairs of user and assistant. Keeping a
row costs nothing, giving it the role user or assistant REROLE, deleting it DELETE (blank and duplicate rows must be),
inserting an empty row INSERT, and leaving a truncated row in place TRUNCATED. Window functions number the rows and find
duplicates, rows are collected as sorted structs, and aggregate() folds them from the last to the first. It carries four
structs (cost, audit): the cheapest way, and of equal ones the ASCII-least, to finish from each of the four states (nothing
yet, after the system row, after a user row, after an assistant row). Going backwards, letters are put before whole
endings, so the order of two endings never changes later, whatever their lengths.

Conversations of up to BLOCK rows take one shuffle, by conversation. Longer ones, which are counted first, are dealt by
ranges of their order, and each block of BLOCK rows is folded on its own to all four states; a second fold joins the
blocks. (An insertion is never part of a cheapest repair: deleting its partner is cheaper. So blocks needn't keep ways
of equal cost that differ in length.) No task holds more than a block's texts; only the digest of such a conversation is
made in one task, from a stream of blocks, as SHA-256 has no other way.

Edge cases: nulls in any column become one space, so a null text is blank, a null role has to be changed, and rows
without conv_id or turn are damaged by the key with spaces, but keep null as id and turn; rows without conv_id are a
conversation; null turns come first; equal turns are in the order of role and text; repeated rows are duplicates; a role
of no character is like any other unknown one; a conversation whose rows are all dropped has zeros; an empty table
gives an empty result; texts of any length are taken whole; further columns, of any name, are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioframe.llm.shared import bounded, table, written

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows that are folded as one.
BLOCK = 1000
#: At most so many ids of long conversations are broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 50_000

STATES = "esua"
_GAP = "\x20\x09\x0a\x0b\x0c\x0d"
_WAY = "struct<cost:bigint,audit:string>"
_FINE, _TRUNCATED, _BLANK, _DUPLICATE = range(4)


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and dropped: rows with the damage that crc32 of conv_id and turn chooses.

    A dropped row stays, without role and text, so that its conversation is known.
    """
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    rows = rows.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), kind.alias("kind"))
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    stays = F.col("kind") != 0
    return rows.select("conv_id", "turn", F.when(stays, role).alias("role"), F.when(stays, text).alias("text"), F.explode(F.array_repeat(~stays, times)).alias("dropped"))


def _fault(text: Column, again: Column) -> Column:
    """The first fault of a row; again: its role and text were seen earlier."""
    bare = F.rtrim(text, F.lit(_GAP))
    return F.when(bare == "", _BLANK).when(again, _DUPLICATE).when(F.substring(bare, -1, 1).isin(".", "!", "?"), _FINE).otherwise(_TRUNCATED)


def _first(v: Column, cost: Column | int, letter: str) -> Column:
    """An edit before a way (null if there is no way)."""
    return F.when(v.isNotNull(), F.struct((v["cost"] + cost).alias("cost"), F.concat(F.lit(letter), v["audit"]).alias("audit")))


def _ways(**ways: Column) -> Column:
    return F.struct(*[ways[q].cast(_WAY).alias(q) for q in STATES])


def _inserted(n: Column) -> Column:
    """The ways when rows may be inserted here."""
    u = F.least(n["u"], _first(n["a"], INSERT, "I"))
    return _ways(u=u, **{q: F.least(n[q], _first(u, INSERT, "I")) for q in "esa"})


def _bound(value: Column, body) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _edited(v: Column, row: Column) -> Column:
    """The ways from before a row, from those after it."""
    initial, late = F.left(row["role"], F.lit(1)), F.when(row["fault"] == _TRUNCATED, TRUNCATED).otherwise(0)
    stays = row["fault"] < _BLANK
    kept = {"e": F.when(initial == "u", v["u"]).when(initial == "s", v["s"]), "s": F.when(initial == "u", v["u"]), "u": F.when(initial == "a", v["a"])}
    kept["a"] = kept["s"]
    each = {}
    for q in STATES:
        to = v["a"] if q == "u" else v["u"]
        each[q] = F.least(_first(v[q], DELETE, "D"), F.when(stays, _first(kept[q], late, "K")), F.when(stays, _first(to, late + REROLE, "R")))
    return _bound(_ways(**each), _inserted)


def folded(rows: Column, ends: str) -> Column:
    """The cheapest ways through rows (sorted structs with role and fault) to one of the states in ends, by first state."""
    none, done = F.lit(None).cast(_WAY), F.struct(F.lit(0).cast("long").alias("cost"), F.lit("").alias("audit"))
    start = _bound(_ways(**{q: done if q in ends else none for q in STATES}), _inserted)
    return F.aggregate(F.reverse(rows), start, _edited)


def rebuilt(rows: Column, audit: Column, state: Column) -> Column:
    """The repaired rows (structs turn, role, text) that an audit makes of rows, from a state on."""
    turns = "array<struct<turn:bigint,role:string,text:string>>"
    start = F.struct(F.lit(0).alias("at"), state.alias("last"), F.array().cast(turns).alias("out"))

    def step(acc: Column, op: Column) -> Column:
        row, new = F.get(rows, acc["at"]), op == "I"
        role = F.when(op == "K", row["role"]).when(acc["last"] == "u", "assistant").otherwise("user")
        one = F.struct(F.when(~new, row["turn"]).alias("turn"), role.alias("role"), F.when(new, "").otherwise(row["text"]).alias("text"))
        gone = op == "D"
        out = F.when(gone, acc["out"]).otherwise(F.concat(acc["out"], F.array(one).cast(turns)))
        return F.struct((acc["at"] + F.when(new, 0).otherwise(1)).alias("at"), F.when(gone, acc["last"]).otherwise(F.left(role, F.lit(1))).alias("last"), out.alias("out"))

    letters = F.filter(F.split(audit, ""), lambda x: x != "")
    return F.aggregate(letters, start, step, lambda acc: acc["out"])


def _illegal(a: Column, b: Column) -> Column:
    """Whether neighbours of these initials may not stand side by side."""
    return ~F.concat(a, b).isin("su", "ua", "au")


def _measures(rows: Column) -> dict[str, Column]:
    """Counts of a sorted array of rows; turns: how many different ones."""
    initial = lambda x: F.left(x["role"], F.lit(1))
    many = lambda kind: F.size(F.filter(rows, lambda x: x["fault"] == kind)).cast("long")
    turns = F.filter(F.transform(rows, lambda x: x["turn"]), lambda t: t.isNotNull())
    pairs = F.transform(rows, lambda x, i: F.when(i > 0, _illegal(initial(F.get(rows, i - 1)), initial(x))))
    return {
        "low": F.array_min(turns),
        "high": F.array_max(turns),
        "turns": F.size(F.array_distinct(turns)).cast("long"),
        "blank": many(_BLANK),
        "duplicate": many(_DUPLICATE),
        "truncated": many(_TRUNCATED),
        "illegal": F.size(F.filter(pairs, lambda p: p)).cast("long"),
    }


_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _gaps(low: Column, high: Column, turns: Column) -> Column:
    return F.coalesce(high - low + 1 - turns, F.lit(0)).cast("long")


def _short(rows: DataFrame) -> DataFrame:
    """Conversations that are one block."""
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    rows = rows.repartition("conv_id").withColumn("pos", F.row_number().over(Window.partitionBy("conv_id").orderBy("dropped", *order)))
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("pos")) > 1
    rows = rows.withColumn("fault", _fault(F.col("text"), again))
    one = F.when(~F.col("dropped"), F.struct("pos", "turn", "role", "text", "fault"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("rows"))
    best = folded(F.col("rows"), "ea")["e"]
    found = whole.select("conv_id", "rows", *[c.alias(n) for n, c in _measures(F.col("rows")).items()], best.alias("best"))
    return found.select("conv_id", F.lit(0).cast("long").alias("part"), F.lit(1).cast("long").alias("parts"), _gaps(F.col("low"), F.col("high"), F.col("turns")).alias("gaps"), *_COUNTS, "best.cost", "best.audit", rebuilt(F.col("rows"), F.col("best.audit"), F.lit("e")).alias("turns"))


def _joined(blocks: Column) -> Column:
    """The cheapest way through blocks (sorted structs with ways, a struct of ways for each last state).

    marked is the audit with the state before each block.
    """
    way = "struct<cost:bigint,audit:string,marked:string>"
    zero = F.struct(F.lit(0).cast("long").alias("cost"), F.lit("").alias("audit"), F.lit("").alias("marked"))
    start = F.struct(*[(zero if q in "ea" else F.lit(None)).cast(way).alias(q) for q in STATES])

    def step(v: Column, block: Column) -> Column:
        def through(q: str, t: str) -> Column:
            m, rest = block["ways"][t][q], v[t]
            both = F.struct((m["cost"] + rest["cost"]).alias("cost"), F.concat(m["audit"], rest["audit"]).alias("audit"), F.concat(F.lit(q), m["audit"], rest["marked"]).alias("marked"))
            return F.when(m.isNotNull() & rest.isNotNull(), both)

        return F.struct(*[F.least(*[through(q, t) for t in STATES]).cast(way).alias(q) for q in STATES])

    return F.aggregate(F.reverse(blocks), start, step, lambda v: v["e"])


def _long(spark: SparkSession, rows: DataFrame, block: int) -> DataFrame:
    """Conversations of any length, as parts of up to block rows."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    rows = rows.where("NOT dropped").drop("dropped").repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(spark, rows.withColumn("pos", F.monotonically_increasing_id()), "long-conversations")  # in the order of all rows
    first = rows.groupBy("conv_id", "role", F.sha2("text", 256)).agg(F.min("pos").alias("first")).select("first")
    rows = rows.join(first, F.col("pos") == F.col("first"), "left").withColumn("fault", _fault(F.col("text"), F.col("first").isNull()))
    key = F.floor(F.col("pos") / block).alias("block")
    parts = rows.groupBy("conv_id", key).agg(F.array_sort(F.collect_list(F.struct("pos", "turn", "role", "text", "fault"))).alias("rows"))
    parts = written(spark, parts, "parts")
    end = lambda i: F.element_at("rows", i)
    ways = F.struct(*[folded(F.col("rows"), t).alias(t) for t in STATES])
    each = parts.select("conv_id", F.struct("block", *[c.alias(n) for n, c in _measures(F.col("rows")).items()], ways.alias("ways"), *[F.left(end(i)["role"], F.lit(1)).alias(n) for i, n in ((1, "left"), (-1, "right"))], *[end(i)["turn"].alias(n) for i, n in ((1, "from"), (-1, "to"))]).alias("b"))
    whole = each.groupBy("conv_id").agg(F.array_sort(F.collect_list("b")).alias("b"), F.min("b.low").alias("low"), F.max("b.high").alias("high"), F.sum("b.turns").alias("turns"), *[F.sum(f"b.{c}").alias(c) for c in _COUNTS], F.count("*").alias("parts"))
    between = lambda test: F.size(F.filter(F.transform("b", lambda x, i: F.when(i > 0, test(F.get("b", i - 1), x))), lambda p: p))
    same = between(lambda a, b: a["to"] == b["from"])
    whole = whole.select("conv_id", "parts", _gaps(F.col("low"), F.col("high"), F.col("turns") - same).alias("gaps"), "blank", "duplicate", "truncated", (F.col("illegal") + between(lambda a, b: _illegal(a["right"], b["left"]))).alias("illegal"), _joined(F.col("b")).alias("best"), F.transform("b", lambda x: x["block"]).alias("blocks"))
    whole = written(spark, whole, "repairs")
    slices = F.regexp_extract_all("best.marked", F.lit(f"([{STATES}][A-Z]*)"), F.lit(1))
    placed = whole.select("*", F.posexplode(slices).alias("part", "own")).withColumn("block", F.get("blocks", F.col("part")))
    counts = [F.when(F.col("part") == 0, F.col(c)).alias(n) for c, n in (("gaps", "gaps"), *[(c, c) for c in _COUNTS], ("best.cost", "cost"), ("best.audit", "audit"))]
    placed = placed.select(F.col("conv_id").alias("id"), "block", F.col("part").cast("long").alias("part"), "parts", *counts, "own")
    both = placed.join(parts, F.col("id").eqNullSafe(F.col("conv_id")) & (placed.block == parts.block))
    turns = rebuilt(F.col("rows"), F.substring("own", 2, 1 << 30), F.left("own", F.lit(1)))
    return both.select("conv_id", "part", "parts", "gaps", *_COUNTS, "cost", "audit", turns.alias("turns"))


def repair(spark: SparkSession, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Damaged rows (as damage() gives them) as repaired conversations, in parts of up to block rows before the repair.

    conv_id, part (from 0), parts, turns (repaired rows: turn, role, text) and, on part 0 only, gaps, blank, duplicate,
    truncated, illegal, cost and audit. Conversations of which every row was dropped have one empty part.
    """
    size = rows.where("NOT dropped").groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > block)
    longs = written(spark, size.select(F.col("conv_id").alias("id")), "long-ids")
    if not longs.limit(1).count():
        return _short(rows)
    longs, same = bounded(longs, BROADCAST_ROWS), F.col("conv_id").eqNullSafe(F.col("id"))
    return _short(rows.join(longs, same, "left_anti")).unionByName(_long(spark, rows.join(longs, same, "left_semi"), block))


def _lines(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")


def digests(parts: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256 of conversations of several parts, from a stream of their parts."""
    rows = parts.where(F.size("turns") > 0).select("conv_id", "part", _lines(F.col("turns")).alias("lines"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part").select("conv_id", "lines")

    def each(batches):
        last, sha, found = None, None, []
        for batch in batches:
            for conv_id, lines in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if sha is None or conv_id != last:
                    if sha is not None:
                        found.append((last, sha.hexdigest()))
                    last, sha = conv_id, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(lines.as_py().encode())
        if sha is not None:
            found.append((last, sha.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in ((0, pa.int64()), (1, pa.string()))], names=["conv_id", "repaired_sha256"])

    return rows.mapInArrow(each, "conv_id bigint, repaired_sha256 string")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return summary(repair(spark, damage(rows)))


def summary(found: DataFrame) -> DataFrame:
    """A row for each repaired conversation: its counts, cost and audit, and the digest of its rows."""
    columns = ["conv_id", "gaps", *_COUNTS, "cost", "audit"]
    single = found.where("parts = 1").select(*columns, F.sha2(_lines(F.col("turns")), 256).alias("repaired_sha256"))
    several = found.where("parts > 1")
    counts = several.where("part = 0").select(*columns)
    digest = digests(several).withColumnRenamed("conv_id", "id")
    none = F.sha2(F.lit(""), 256)
    joined = counts.join(digest, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(*columns, F.coalesce("repaired_sha256", none).alias("repaired_sha256"))
    return single.unionByName(joined)
