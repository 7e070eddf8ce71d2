"""Conversation repair against a search over all edits, row by row."""

import hashlib
import heapq
import random
import zlib

from folioframe.llm import conversations

GAP = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def damaged(rows):
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        role = "user" if kind == 4 else role
        yield from [(conv, turn, role, text)] * (2 if kind == 3 else 1)


def cheapest(rows):
    """Cost, audit and lines of the first repair by cost and audit; rows: role, text, fault."""
    heap, seen = [(0, "", 0, "", ())], set()
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    while True:
        cost, audit, k, last, lines = heapq.heappop(heap)
        if (audit, k, last) in seen:
            continue
        seen.add((audit, k, last))
        if k == len(rows) and last in ("", "a"):
            return cost, audit, lines
        for role in ("user", "assistant"):
            if role[0] in after[last]:
                heapq.heappush(heap, (cost + 5, audit + "I", k, role[0], (*lines, f"{role}:")))
        if k < len(rows):
            role, text, fault = rows[k]
            heapq.heappush(heap, (cost + 2, audit + "D", k + 1, last, lines))
            if fault in ("", "truncated"):
                more = 5 if fault else 0
                if role[:1] and role[:1] in after[last]:
                    heapq.heappush(heap, (cost + more, audit + "K", k + 1, role[:1], (*lines, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if new[0] in after[last]:
                        heapq.heappush(heap, (cost + more + 1, audit + "R", k + 1, new[0], (*lines, f"{new}:{text}")))


def plain(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in damaged(r for r in rows if r[0] == conv)), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in own:
            bare = text.rstrip(GAP)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = cheapest([(role, text, f) for (_, role, text), f in zip(own, faults)])
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def made(n, seed, turns):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        conv_id = None if conv == 3 else conv
        for turn in range(rng.randint(1, turns)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]) if rng.random() < 0.4 else ("user", "assistant")[turn % 2]
            some = ["Yes.", "No!", "so and", "", " \t", None, "é? \n", "a.b", "long " * 50 + "."]
            text = rng.choice(some) if rng.random() < 0.5 else f"text {rng.random()}."
            rows.append((conv_id, None if rng.random() < 0.1 else turn + rng.choice([0, 0, 0, 1, 5]), role, text))
    return rows


def got(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    found = conversations.summary(conversations.repair(spark, conversations.damage(df), **options)).collect()
    assert len(found) == len({r.conv_id for r in found})
    return {r.conv_id: tuple(r)[1:] for r in found}


def test_equals_a_search_over_all_edits(spark):
    rows = made(120, 1, 7)
    assert got(spark, rows) == plain(rows)


def test_blocks_equal_whole_conversations(spark):
    rows = made(60, 2, 9)
    assert got(spark, rows, block=2) == plain(rows)


def test_one_very_long_conversation(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"turn {k}" + (k % 7 > 0) * ".") for k in range(5_000)]
    whole, parts = got(spark, rows, block=10_000), got(spark, rows)
    assert whole == parts and len(parts[1][-2]) > 4_500


def test_edge_cases(spark):
    assert got(spark, []) == {}
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "hello."), (None, None, None, None)]
    found = got(spark, rows)
    assert found == plain(rows) and found[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    df = spark.createDataFrame([(1, 0, "user", "a.", "x")], SCHEMA + ", kind string")
    assert conversations.repair(spark, conversations.damage(df)).count() == 1
