"""The mix against a plain version of windows and deadlines, and edge cases."""

import hashlib
import random
import time

from folioframe.llm import mixing


def plain_slots(blocks, weights):
    """Slot of each (source, block), by looking at all sources in every slot of every period."""
    out, at, q, length = {}, 0, 0, 1
    while live := [s for s in sorted(blocks) if blocks[s] > weights[s] * q]:
        total = sum(weights[s] for s in live)
        for _ in range(length):
            done = dict.fromkeys(live, 0)
            for slot in range(total):
                ready = [(-(-(done[s] + 1) * total // weights[s]), -weights[s], s) for s in live if done[s] < weights[s] and done[s] * total // weights[s] <= slot]
                s = min(ready)[2]
                if weights[s] * q + done[s] < blocks[s]:
                    out[s, weights[s] * q + done[s]] = at + slot
                done[s] += 1
            at, q = at + total, q + 1
        length = q
    return out


def closed_form(blocks, weights):
    out = {}
    for s, w, place, slot, phase, length, base in mixing.schedule(blocks, weights):
        begin = 0 if phase == 0 else 1 << (phase - 1)
        for j in range(place, blocks[s], w):
            q = j // w
            if (0 if q == 0 else q.bit_length()) == phase:
                out[s, j] = base + (q - begin) * length + slot
    return out


def test_schedule_equals_the_plain_one():
    rng = random.Random(4)
    for _ in range(60):
        weights = {f"s{i}": rng.randint(1, 7) for i in range(rng.randint(1, 6))}
        blocks = {s: rng.randint(0, 60) for s in weights}
        want = plain_slots(blocks, weights)
        assert closed_form(blocks, weights) == want
        assert len(want) == len(set(want.values())) == sum(blocks.values())


def test_many_sources_are_planned_quickly():
    rng = random.Random(1)
    blocks = {f"s{i}": rng.randint(1, 3000) for i in range(10_000)}
    began = time.time()
    rows = mixing.schedule(blocks, {"s1": 9})
    assert time.time() - began < 3 and len(rows) < 14 * 10_008


def test_rows_have_the_slots_of_a_plain_version(spark):
    rng = random.Random(6)
    rows = [(None if k % 17 == 0 else k % 90, None if k % 29 == 0 else "x" * rng.randrange(0, 900), rng.choice(["a", "a", "a", "b", "c", None]), "r", 1) for k in range(160)]
    docs = spark.createDataFrame([*rows, rows[3], rows[3]], "doc_id bigint, text string, source string, _row string, slot int")
    weights, size = {"a": 3, "b": 2}, 1000
    found = mixing.slotted(spark, docs, docs.columns, weights, size).collect()
    assert len(found) == 162
    of = {}
    for r in found:
        of.setdefault(r.source, []).append(r)
    assert set(of) == {"a", "b", "c", ""}
    blocks = {s: sum(len(r._row.text or "") for r in v) // size + 1 for s, v in of.items()}
    want = plain_slots(blocks, {"a": 3, "b": 2, "c": 1, "": 1})
    for s, mine in of.items():
        mine.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        volume = 0
        for r in mine:
            assert r.block == volume // size and r.slot == want[s, r.block]
            volume += len(r._row.text or "")
    mixed = mixing.mixed(spark, docs, weights, size)
    assert mixed.columns == docs.columns and sorted(map(str, mixed.collect())) == sorted(map(str, docs.collect()))
    assert mixing.slotted(spark, docs.limit(0), ["doc_id"]).count() == 0
