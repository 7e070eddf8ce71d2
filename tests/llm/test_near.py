"""Near duplicates in crowded regions against brute force, and components of many links."""

import random

import numpy as np
import pytest

from folioframe.llm import near_dedup
from folioframe.llm.components import components


def brute(sets):
    """Least place linked with each set, directly or by others."""
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if sets[i] and 100 * same >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def crowded(n, pairs, seed):
    """Texts whose sets are about 0.72 alike, and a twin at 0.8 to 0.9 for some of them."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(400)]
    texts = []
    for k in range(n):
        words = list(base)
        for at in rng.sample(range(0, 400, 4), 17):
            words[at] = f"x{k}-{at}"
        texts.append(words)
    for k in range(pairs):
        words = list(texts[k])
        for at in rng.sample(range(1, 400, 4), rng.choice((4, 6, 8, 10))):
            words[at] = f"y{k}-{at}"
        texts.append(words)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("leaf,block", [(256, 512), (8, 16)])
def test_crowded_region_equals_brute_force(spark, monkeypatch, leaf, block):
    texts = crowded(300, 60, 3)
    sets = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in (t.split() for t in texts)]
    want = brute(sets)
    assert 300 <= len(set(want)) < 360  # the crowd itself isn't linked, most twins are
    monkeypatch.setattr(near_dedup.again, "__defaults__", (block,))
    monkeypatch.setattr(near_dedup, "TASK_ROWS", 2_000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = near_dedup.clusters(spark, docs, leaf=leaf).collect()
    got = {r.doc_id: r.component_id for r in found}
    linked = [k for k in range(len(texts)) if want[k] != k]
    assert np.mean([got[k] == want[k] for k in linked]) >= (0.99 if leaf == 256 else 0.9)
    assert all(got[k] >= want[k] for k in range(len(texts)))


def test_large_group_is_one_component_of_cut_stretches(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"w{k}" for k in range(300)]
    texts = []
    for k in range(400):
        words = list(base)
        words[rng.randrange(300)] = f"x{k}"
        texts.append(" ".join(words))
    monkeypatch.setattr(near_dedup, "TASK_ROWS", 500)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.component_id for r in near_dedup.clusters(spark, docs, leaf=16).collect()} == {0}


def test_groups_too_large_for_a_task_are_dealt_in_parts(spark):
    rows = [(b"c" * 16, 0, k, bytes([k]) * 16, 100, np.arange(192, dtype=">u2").tobytes()) for k in range(9)]
    cells = spark.createDataFrame(rows, "cell binary, side int, lab bigint, cls binary, n bigint, sig binary")
    groups: dict = {}
    for r in near_dedup.promising(cells, 80, group_shingles=600).collect():
        groups.setdefault(bytes(r.grp), set()).add(r.cls[0])
    assert {frozenset((a, b)) for g in groups.values() for a in g for b in g if a < b} == {frozenset((a, b)) for b in range(9) for a in range(b)}
    assert max(map(len, groups.values())) == 6


def test_components_of_many_tasks(spark):
    rng = random.Random(6)
    links = [(k + 1, k) for k in range(0, 300) if k % 50] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    few = {(r.a, r.b) for r in components(spark, frame).collect()}
    assert few == {(r.a, r.b) for r in components(spark, frame, part=20).collect()}
    root = {k: k for link in links for k in link}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert few == {(k, r) for k, r in root.items() if k != r}


def test_keep_one_with_clashing_names(spark):
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(1, text, 7, "p", "q", 3), (2, text + " more", 8, "p", "q", 4), (2, None, 9, "p", "q", 5), (None, "other words here", 1, None, None, 0), (None, "other words here", 2, None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id int, hash string, _key string, row int")
    kept = near_dedup.keep_one(spark, docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text is None) for r in kept.collect()) == [(False, 1, False), (False, 2, True), (True, 0, False)]


def test_counted_pairs_equal_plain_sets():
    rng = random.Random(8)
    sets = [np.unique(np.array([rng.randrange(300) for _ in range(rng.randrange(1, 200))] + list(range(60)), np.uint64)) for _ in range(90)]
    for percent in (30, 50, 80):
        x, y = near_dedup._linked(sets, percent)
        plain = [set(s.tolist()) for s in sets]
        want = {(i, j) for j in range(90) for i in range(j) if 100 * len(plain[i] & plain[j]) >= percent * len(plain[i] | plain[j])}
        assert set(zip(x.tolist(), y.tolist())) == want


def test_groups_that_share_classes_become_one(spark):
    rows = [(b"g1", b"a"), (b"g1", b"b"), (b"g2", b"b"), (b"g2", b"c"), (b"g3", b"x"), (b"g3", b"y")]
    groups = spark.createDataFrame(rows, "grp binary, cls binary")
    classes = spark.createDataFrame([(c, 10) for c in (b"a", b"b", b"c", b"x", b"y", b"z")], "cls binary, n bigint")
    got = {(bytes(r.grp), bytes(r.cls), r.settled) for r in near_dedup.regrouped(spark, groups, classes).collect()}
    assert got == {(b"a", b"a", True), (b"a", b"b", True), (b"a", b"c", True), (b"x", b"x", True), (b"x", b"y", True)}
    got = {(bytes(r.grp), bytes(r.cls), r.settled) for r in near_dedup.regrouped(spark, groups, classes, members=2).collect()}
    assert got == {(*r, False) for r in rows[:4]} | {(b"x", b"x", True), (b"x", b"y", True)}
