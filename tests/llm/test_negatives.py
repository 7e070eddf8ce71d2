"""Hard negatives against plain loops over all pairs."""

import math
import random

import pytest

from folioframe.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, q string"


def plain(rows):
    import numpy as np

    own = []
    for vec_id, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        own.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v], label))
    product = lambda a, b: sum(x * y for x, y in zip(a, b))
    first = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for k, (anchor, a, label) in enumerate(own):
        if anchor is None or anchor % 100:
            continue
        scores = [(product(a, v), i, other == label) for j, (i, v, other) in enumerate(own) if j != k]
        for score, positive, _ in sorted((s for s in scores if s[2]), key=first)[:5]:
            fit = sorted((s for s in scores if not s[2] and 30 * score <= 100 * s[0] <= 90 * score), key=first)[:10]
            out += [(anchor, positive, r, n, score, s) for r, (s, n, _) in enumerate(fit, 1)]
    return sorted(out, key=str)


def made(n, seed, d=12):
    rng, rows = random.Random(seed), []
    centres = [[rng.gauss(0, 0.3) for _ in range(d)] for _ in range(4)]
    for k in range(n):
        label = rng.randrange(4)
        v = [c + rng.gauss(0, 0.2) for c in centres[label]]
        rows.append((k, v, label))
        if k % 50 == 0:
            rows.append((k, v, label))  # a repeated row
        if k % 9 == 0:
            rows.append((1000 + k, centres[0], 1))  # a group of equal vectors
    rows += [(5000, None, 1), (5001, [0.1] * d, None), (5002, [None] + [0.1] * (d - 1), 1), (5003, [math.nan] * d, 1), (5004, [math.inf] * d, 1), (5005, [-math.inf] * d, 1), (None, centres[1], 2), (5100, [0.3] * (d - 2), 3), (5101, [], 3)]
    rng.shuffle(rows)
    return rows


def got(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in negatives.mined(spark, df, **options).collect()), key=str)


@pytest.mark.parametrize("block", [8192, 3])
def test_equals_plain_loops(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "ANCHORS_AT_ONCE", 4)
    monkeypatch.setattr(negatives, "ROWS_AT_ONCE", 100)
    rows = made(700, 1)
    want = plain(rows)
    assert len(want) > 200 and got(spark, rows, block=block) == want


def test_edge_cases(spark):
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0], 1)]) == []
    assert got(spark, [(0, [], 1), (1, [], 2), (14, [], 1), (15, [], 2)]) == plain([(0, [], 1), (1, [], 2), (14, [], 1), (15, [], 2)])
    huge = [(k, [1e30 * (k % 3), 1.0], k % 2) for k in range(120)]
    assert len(got(spark, huge)) == len(plain([r for r in huge if r[1][0] == 0]))


def test_the_screen_keeps_every_pair_in_reach(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    q = rng.integers(-1 << 12, 1 << 12, (300, 32)) * (1 << np.arange(32) // 4)
    turn = np.linalg.eigh((q.T @ q).astype(float))[1][:, ::-1]
    steps = negatives.steps_of(32)
    r = negatives.Turned.of(np.arange(300), np.arange(300), np.zeros(300, int), q, turn, steps)
    exact = q @ q.T
    low, high = np.quantile(exact, 0.9, axis=0).astype(np.int64), np.quantile(exact, 0.95, axis=0).astype(np.int64)
    x, y = negatives.screened(r, r, steps, True, low, high)
    found = np.zeros(exact.shape, bool)
    found[x, y] = True
    inside = (exact >= low) & (exact <= high)
    assert inside[found].sum() == inside.sum() and found.sum() < 1.2 * inside.sum()
