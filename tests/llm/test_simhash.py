"""SimHash fingerprints and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from folioframe.llm import simhash


def plain_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c if c not in "\t\n\x0b\x0c\r" else " " for c in text or "").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps):
    """Least id reachable from each row."""
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3 and root[i] != root[j]:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    least = {}
    for r, i in zip(root, ids):
        least[r] = i if least.get(r) is None else least[r] if i is None else min(i, least[r])
    return [least[r] for r in root]


def test_texts_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "AT_ONCE", 7)
    rng = random.Random(1)
    base = [" ".join(rng.choice("Ab cdé EÉ f　g hi-J".split(" ")) + str(rng.randint(0, 60)) for _ in range(n)) for n in (1, 2, 3, 5, 40, 90, 300)]
    texts = [None, "", " \t\n", *base, *base]
    for t in base[3:]:
        for _ in range(12):
            words = t.split(" ")
            words[rng.randrange(len(words))] = "new"
            texts.append("\n".join(words))
    ids = [None if k in (3, 4) else k for k in range(len(texts))]
    docs = spark.createDataFrame([(i, t, "x") for i, t in zip(ids, texts)], "doc_id bigint, text string, fp string")
    got = simhash.clusters(spark, docs).collect()
    fps = [plain_print(t) for t in texts]
    want = sorted(zip(ids, fps, plain_components(ids, fps)), key=str)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == want
    assert simhash.clusters(spark, docs.limit(0)).count() == 0


@pytest.mark.parametrize("crowd", [4096, 40, 5])
def test_crowds_lose_no_link(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "SMALL", 8)
    rng = random.Random(crowd)
    fps = set()
    for _ in range(12):  # chains of three-bit steps in all places, and within one half
        at, half = rng.getrandbits(64), rng.random() < 0.5
        for _ in range(60):
            for b in rng.sample(range(32 if half else 64), rng.randint(1, 4)):
                at ^= 1 << b
            fps.add(at)
    fps = sorted(fps)
    rows = [(int(np.uint64(f).astype(np.int64)),) for f in fps]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        links = simhash.linked(spark, spark.createDataFrame(rows, "fp bigint").repartition(3), crowd).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    place = {f: k for k, (f,) in enumerate(rows)}
    assert all((fps[place[r.a]] ^ fps[place[r.b]]).bit_count() <= 64 for r in links)
    root = simhash.connected(len(fps), np.array([place[r.a] for r in links], int), np.array([place[r.b] for r in links], int))
    assert root.tolist() == plain_components(range(len(fps)), fps)
