"""The stages of the pipeline against plain versions, and with nulls, ties, empty tables and clashing names."""

import random

import corpus_pipeline
from folioframe.llm import pii, quality_rules
from folioframe.llm.oracle_near import components_sql
from folioframe.llm.oracle_quality import measured_sql

import duckdb

STAGE = dict(corpus_pipeline.STAGES)


def documents(spark, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")


def test_stages_equal_plain_versions(spark, tmp_path):
    docs = documents(spark)
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    kept = STAGE["quality"](spark, docs, "")
    want = {r[0] for r in con.execute(f"WITH {measured_sql('documents')} SELECT doc_id FROM judged WHERE kept").fetchall()}
    assert {r.doc_id for r in kept.collect()} == want
    kept.write.parquet(f"{tmp_path}/quality.parquet")
    con.execute(f"CREATE VIEW good AS SELECT * FROM '{tmp_path}/quality.parquet/*.parquet'")
    one = STAGE["near_duplicates"](spark, spark.read.parquet(f"{tmp_path}/quality.parquet"), "").collect()
    want = {r[0] for r in con.execute(f"WITH RECURSIVE {components_sql('good', 5, 80)} SELECT doc_id FROM near_components WHERE doc_id = component_id").fetchall()}
    assert {r.doc_id for r in one} == want and len(one) == len(want)
    clean = {r.doc_id: r for r in STAGE["personal_data"](spark, spark.createDataFrame(one, docs.schema), "").collect()}
    for r in one:
        text, found = r.text, sorted(pii.findings(r.text), key=lambda x: (x[1], -x[2]))
        chosen, reach = [], 0
        for kind, a, b, _ in found:
            if a >= reach:
                chosen.append((kind, a, b))
            reach = max(reach, b)
        for kind, a, b in reversed(chosen):
            text = text[:a] + f"<{kind.upper()}>" + text[b:]
        assert clean[r.doc_id].text == text and clean[r.doc_id].n_chars == len(text)


def test_edge_cases_of_every_stage(spark):
    rng = random.Random(2)
    text = lambda: " ".join("".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(90))
    same = text()
    rows = [(1, same, "en", "s", 0), (2, same, None, None, 0), (2, same, None, None, 0), (None, text(), "en", None, 0), (3, None, "en", "s", 0), (4, "", "en", "s", 0), (5, text() + " a@b.cd", "en", "s", 0)]
    clashing = [(*r, 9, "k", "h", 3) for r in rows]
    docs = spark.createDataFrame(clashing, "doc_id bigint, text string, lang string, source string, n_chars bigint, slot int, _row string, hash string, id int")
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        none = stage(spark, docs.limit(0), "")
        assert none.columns == docs.columns and none.count() == 0, name
        at = stage(spark, at, "")
        assert at.columns == docs.columns, name
        at = spark.createDataFrame(at.collect(), docs.schema)
    assert sorted((r.doc_id or 0) for r in at.collect()) == [0, 1, 5]
    out = STAGE["encode"](spark, at.select("doc_id", "text", "source"), "")
    assert out.count() == 3 and STAGE["encode"](spark, docs.limit(0), "").count() == 0
    assert quality_rules.filter_documents(spark, docs.limit(0)).count() == 0
