"""Repeated byte strings over several shards, blocks of long texts, and hot anchors, against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np

from folioframe.llm import suffix_dedup as S


def prose(rng, n, letters="abcdefgh "):
    return "".join(rng.choice(letters) for _ in range(n)).encode()


def test_merged_shards_mark_what_brute_force_marks(monkeypatch):
    rng = random.Random(1)
    base = prose(rng, 3000)
    parts, copies = [], []
    for _ in range(60):
        a = rng.randrange(0, 2500)
        parts.append(prose(rng, rng.randrange(0, 80)) + base[a : a + rng.randrange(150, 500)] + prose(rng, rng.randrange(0, 80)))
        copies.append(rng.choice((1, 1, 1, 2)))
    seen = Counter()
    for p, n in zip(parts, copies):
        for k in range(len(p) - 199):
            seen[p[k : k + 200]] += n
    want = [[k for k in range(len(p) - 199) if seen[p[k : k + 200]] > 1] for p in parts]
    for size in (700, 5_000, 1 << 20):
        monkeypatch.setattr(S, "SHARD_BYTES", size)
        assert [x.tolist() for x in S.repeated(parts, copies)] == want


def test_blocks_of_long_texts_keep_equal_strings_together(monkeypatch):
    rng = random.Random(2)
    passage = prose(rng, 900)
    data = prose(rng, 2500) + passage + prose(rng, 3100) + passage + prose(rng, 400)
    for chunk in (1 << 20, 1000, 333):
        monkeypatch.setattr(S, "CHUNK", chunk)
        key, start, count = S.anchors(data)
        starts = np.concatenate([np.arange(a, a + n) for a, n in zip(start, count)])
        assert starts.tolist() == list(range(len(data) - 199))
        of = dict(zip(starts.tolist(), np.repeat(key, count).tolist()))
        assert all(of[2500 + k] == of[6500 + k] for k in range(701))


def test_whole_operator_on_shared_passages(spark):
    rng = random.Random(3)
    shared = [prose(rng, 450).decode() for _ in range(3)]
    texts = []
    for k in range(120):
        texts.append(prose(rng, rng.randrange(0, 300)).decode() + (shared[k % 3] if k % 2 else "") + prose(rng, rng.randrange(0, 300)).decode())
    texts += [texts[1], texts[1], None, "", "é" * 150, "é" * 99]
    ids = [None if k in (3, 5) else k % 100 for k in range(len(texts))]
    seen = Counter((t or "").encode()[k : k + 200] for t in texts for k in range(len((t or "").encode()) - 199))
    want = []
    for i, t in zip(ids, texts):
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 199):
            if seen[data[k : k + 200]] > 1:
                gone[k : k + 200] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        want.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest()))
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, texts)], "doc_id bigint, text string, places string, key int")
    order = lambda rows: sorted(map(tuple, rows), key=str)
    for key_bytes in (S.KEY_BYTES, 2_000, 1):
        assert order(S.remove_repeats(spark, docs, key_bytes=key_bytes).collect()) == order(want)
