"""Operators against plain versions, and the edge cases that their docstrings define."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from folioframe.llm import bpe, chroma, mixing, near_dedup, pii, quality_rules, suffix_dedup, token_files, toxicity
from folioframe.llm.oracle_near import OP7
from folioframe.llm.oracle_quality import OP2

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, label string"


def frame(spark, texts, ids=None):
    rows = [(None if ids and ids[i] is None else (ids or range(len(texts)))[i], t, ("en", None)[i % 2], ("s", "t", None)[i % 3], len(t or ""), "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    random.seed(5)
    words = ["ba", "cé", "dö", "fu", "gi", "Ho", "ju."]
    prose = lambda n: " ".join(random.choice(words) + random.choice(words) for _ in range(n))
    base = prose(300)
    near = base.replace(" ", "  ", 3).upper().lower()
    return [None, "", " \n\t", "one two", prose(60), base, base, near, base[:900] + " x " + base[900:], prose(4000), "a" * 5000, prose(80), "# $ % " * 40, prose(70) + "\n" + "same line\n" * 9]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_repeated_strings_by_brute_force(spark, texts, empty):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    expected = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - 199):
            if seen[d[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        expected.append((len(d), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(d, gone) if not g)).hexdigest()))
    for key_bytes in (suffix_dedup.KEY_BYTES, 1):
        got = suffix_dedup.remove_repeats(spark, frame(spark, texts), key_bytes=key_bytes).orderBy("doc_id").collect()
        assert [tuple(r)[1:] for r in got] == expected
    assert suffix_dedup.remove_repeats(spark, empty).count() == 0


def test_merge_gives_common_prefixes():
    random.seed(2)
    step, length = suffix_dedup.STEP, suffix_dedup.LENGTH
    base = bytes(random.choice(b"ab") for _ in range(900))
    pieces = [base[:400], base[100:500], base[600:900]]
    shards = [suffix_dedup.Shard([p], [1]) for p in pieces]
    interleave, common = suffix_dedup.merge(shards)
    order = np.empty(len(common), object)
    for k, s in enumerate(shards):
        order[interleave == k] = [pieces[k][i:] for i in s.order]
    whole = [(x, y, c) for x, y, c in zip(order[:-1], order[1:], common[1:]) if len(x) >= length and len(y) >= length]
    assert whole
    for x, y, c in whole:
        same = next((i for i in range(length) if x[i] != y[i]), length)
        assert c == same // step


def compared(spark, tmp_path, df, query, sql):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(sql).df()
    got = query(spark, str(tmp_path)).toPandas()[list(want.columns)]
    text = lambda d: sorted(map(str, d.astype(object).where(d.notna(), None).itertuples(index=False, name=None)))
    assert text(got) == text(want)


def test_quality_equals_sql(spark, texts, tmp_path, empty):
    compared(spark, tmp_path, frame(spark, texts), quality_rules.op2_quality_rules, OP2)
    kept = quality_rules.filter_documents(spark, frame(spark, texts))
    assert kept.columns == frame(spark, texts).columns
    assert quality_rules.filter_documents(spark, empty).count() == 0


def test_sketch_bins(spark):
    xs = [0, 1, 31, 32, 33, 63, 64, 1000, 123456]
    rows = spark.createDataFrame([(x,) for x in xs], "x bigint").select("x", quality_rules.sketch_bin(F.col("x")).alias("b")).select("x", "b", quality_rules.bin_top(F.col("b")).alias("top")).collect()
    assert all(r.x <= r.top <= r.x * 17 / 16 + 1 for r in rows)
    assert [r.b for r in rows] == sorted(r.b for r in rows)


def test_near_duplicates_equal_sql(spark, texts, tmp_path, empty):
    compared(spark, tmp_path, frame(spark, texts), near_dedup.op7_near_dedup, OP7)
    kept = near_dedup.keep_one(spark, frame(spark, [*texts, texts[4]], [*range(len(texts)), 4]), size=5)
    ids = [r.doc_id for r in kept.collect()]
    assert 5 in ids and 6 not in ids and 7 not in ids and ids.count(4) == 1 and {0, 1, 2} <= set(ids)
    assert near_dedup.clusters(spark, empty).count() == 0


def near_components(texts, percent=80):
    sets = [set(near_dedup.shingles(t).tolist()) for t in texts]
    of = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if of[a] != of[b] and 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                low, high = sorted((of[a], of[b]))
                of = [low if x == high else x for x in of]
    return of


def test_near_duplicates_in_a_crowded_region_by_brute_force(spark, monkeypatch):
    random.seed(8)
    base = [f"w{k}" for k in range(300)]
    noisy = []
    for d in range(240):
        words = list(base)
        for k in random.sample(range(300), 6):
            words[k] = f"x{d}-{k}"
        noisy.append(" ".join(words))
    want = near_components(noisy)
    assert 1 < len(set(want)) < len(noisy)
    docs = frame(spark, noisy)
    for leaf in (near_dedup.LEAF, 16):
        monkeypatch.setattr(near_dedup.again, "__defaults__", (leaf,))
        assert {r.doc_id: r.component_id for r in near_dedup.clusters(spark, docs, leaf=leaf).collect()} == dict(enumerate(want)), leaf


def test_near_duplicates_of_a_null_id(spark):
    changed = lambda at: " ".join(f"x{k}" if k in at else f"w{k}" for k in range(300))
    few, more = range(20, 100, 20), range(20, 180, 20)
    docs = frame(spark, [changed(()), changed(few), changed(more), "other words of another text"], [4, None, 6, 7])
    assert {r.doc_id: r.component_id for r in near_dedup.clusters(spark, docs).collect()} == {4: 4, None: 4, 6: 4, 7: 7}


def test_toxicity_learns_and_scores(spark, empty):
    random.seed(1)
    words = ["sun", "tree", "river", "house", "stone"]
    rows = [(i, " ".join(random.choices(words, k=20)) + (" vile scum" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1000, None), (1001, "")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1000, 1), (None, 1), (5, None)], "doc_id bigint, toxic int")
    machine = toxicity.train(*toxicity.training_rows(docs, labels))
    got = {r.doc_id: r for r in toxicity.score(spark, docs, machine).collect()}
    assert all(got[i].predicted == y and got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, y in rows)
    assert 0 <= got[1001].score <= 1 and got[1000].score == got[1001].score
    assert toxicity.score(spark, empty, toxicity.train([], np.zeros(0))).count() == 0


def test_factors_see_pairs():
    rows = [[1, 2], [1], [2], []] * 400
    labels = np.array([1.0, 0, 0, 0] * 400)
    m = toxicity.train(rows, labels)
    assert m.score([1, 2]) > 0.5 > max(m.score([1]), m.score([2]), m.score([]))


def test_chroma_aligns_shifted_recordings(spark, empty):
    rng = np.random.default_rng(0)
    notes = lambda: rng.normal(size=64)
    sound = lambda v, pad: (chroma.melody({"v": list(v), "pad": pad}) * 20000).astype("<i2").tobytes()
    a = notes()
    media = [(1, sound(a, 0)), (2, sound(a + 0.02 * rng.normal(size=64), 3)), (3, sound(notes(), 1)), (4, None), (5, b""), (6, sound(a, 0)), (6, sound(a, 0))]
    df = spark.createDataFrame(media, "id bigint, media binary")
    got = {r.id: r for r in chroma.align(spark, chroma.fingerprints(df)).collect()}
    assert got[1].class_id == got[2].class_id == got[6].class_id == 1 and got[3].class_id == 3
    assert got[2].offset == -3 and got[4].n_prints == 0 and got[5].class_id == 5
    assert chroma.align(spark, chroma.fingerprints(df.limit(0))).count() == 0


def test_mixing_keeps_to_shares(spark, texts, empty):
    random.seed(4)
    for _ in range(60):
        weights = [(f"s{i}", random.randint(1, 9)) for i in range(random.randint(1, 7))]
        total, done = sum(w for _, w in weights), Counter()
        for t, (s, _, _) in enumerate(mixing.period(weights)):
            done[s] += 1
            assert all(abs((t + 1) * w - done[q] * total) < total for q, w in weights)
    docs = frame(spark, texts)
    mixed = mixing.mixed(spark, docs, {"s": 2}, block_chars=500)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, docs.collect())) and mixed.columns == docs.columns
    assert mixing.mixed(spark, empty).count() == 0


def test_personal_data(spark, empty):
    cases = {
        "write a.b@c.de now": [("email", 6, 14)],
        "10.0.0.1 and 300.1.1.1": [("ip", 0, 8)],
        "4111 1111 1111 1111": [("card", 0, 19)],
        "4111 1111 1111 1112": [],
        "+1 (974) 555-3436": [("phone", 0, 17)],
        "iban DE89 3704 0044 0532 0130 00 x": [("iban", 5, 32)],
        "iban DE89 3704 0044 0532 0130 01 x": [],
        "my phone 089 123 4567 now": [("local_phone", 9, 21)],
        "sum 089 123 4567 now": [],
    }
    for text, want in cases.items():
        assert [x[:3] for x in pii.findings(text) if x[0] != "card" or want] == want, text
    got = pii.redact(frame(spark, [None, "", "to a.b@c.de"])).orderBy("doc_id").collect()
    assert [r.text for r in got] == [None, "", "to <EMAIL>"] and got[2].n_chars == 10
    assert pii.digest(empty).count() == 0 and pii.digest(frame(spark, [None])).first().n_email == 0


def test_bpe_equals_library(spark, texts, empty):
    path = bpe.vocabulary("byte_bpe_50k.json")
    t, own = Tokenizer.from_file(path), bpe.SegmentTreeBPE(bpe.read_definition(path))
    random.seed(9)
    odd = ["".join(random.choice("aé ñ漢🙂 \n\t1²'st_-<|>‍́\x85\xa0\x1cﬁ") for _ in range(40)) for _ in range(300)]
    for x in [*[x or "" for x in texts], *odd, "a<|endoftext|>b"]:
        ids = t.encode(x, add_special_tokens=False).ids
        assert own.encode(x) == ids and own.decode(ids) == t.decode(ids, skip_special_tokens=False)
    some = [random.randrange(50257) for _ in range(200)]
    assert own.decode(some) == t.decode(some, skip_special_tokens=False)
    back = bpe.decode(spark, bpe.encode(spark, frame(spark, texts), path), path).orderBy("doc_id").collect()
    assert [r.text for r in back] == [x or "" for x in texts]
    assert bpe.digest(spark, empty, path).count() == 0


def test_token_files(spark, texts, tmp_path, empty):
    path = bpe.vocabulary("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    ids = [3, 1, 2, 0, *range(4, len(texts))]
    folder = f"file://{tmp_path}/ids"
    manifest = token_files.write_files(spark, frame(spark, texts, ids), path, folder)
    want, at = [], 0
    for i, x in sorted(zip(ids, texts, strict=True)):
        a = np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, at, len(a), zlib.crc32(a.tobytes())))
        at += len(a)
    assert sorted(map(tuple, token_files.read_files(spark, manifest, folder).collect())) == want
    none = token_files.write_files(spark, empty, path, f"{folder}-none")
    assert token_files.read_files(spark, none, f"{folder}-none").count() == 0
    for bits in (1, 7, 11, 16, 17):
        x = np.random.default_rng(bits).integers(0, 1 << bits, 1001).astype("<u4")
        assert (token_files.unpack(token_files.pack(x, bits), bits, len(x)) == x).all() and len(token_files.pack(x, bits)) == -(-1001 * bits // 8)


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == docs.columns, name
        at.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
    out = corpus_pipeline.STAGES[-1][1](spark, at, str(tmp_path)).toPandas()
    assert 0 < len(out) == at.count() < docs.count()
    mine = pd.DataFrame([(r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in at.collect()], columns=["doc_id", "sha"])
    assert out.merge(mine, on="doc_id").eval("decoded_sha256 == sha").all()


def test_pipeline_returns_the_mix(spark, tmp_path, monkeypatch):
    rows = [(i, f"{i} " + "some more words " * 250, "en", "src0" if i % 7 < 5 else f"src{i % 7 - 4}", 0) for i in range(1050)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[-2:])
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in out) == list(range(1050))
    out.sort(key=lambda r: (r.slot, r["rank"]))
    mixed = [r.doc_id for r in mixing.mixed(spark, docs).collect()]
    assert [r.doc_id for r in out] == mixed
    volumes = Counter()
    for r in rows:
        volumes[r[3]] += len(r[1])
    weights = mixing.tempered(volumes)
    total = sum(weights.values())
    assert weights["src0"] == mixing.UNITS > 2 * weights["src1"]
    blocks = {s: v // mixing.BLOCK_CHARS + 1 for s, v in volumes.items()}
    taken = {r.slot: rows[r.doc_id][3] for r in out}
    for end in range(1, total + 1):
        for source, weight in weights.items():
            got = sum(taken.get(t) == source for t in range(end))
            assert got >= blocks[source] - 1 or abs(got - weight * end / total) < 1
