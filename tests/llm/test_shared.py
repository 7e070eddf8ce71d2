"""Lifetimes of the tables that operators write, and sessions without a shared folder."""

import os
import subprocess
import sys
from pathlib import Path

from folioframe.llm import near_dedup, shared, simhash

DOCS = [(k, f"one two three four five {k // 2} six seven eight nine ten eleven twelve") for k in range(20)]
SCHEMA = "doc_id bigint, text string"


def folder_of(path):
    return Path(path.split("://")[-1].replace("file:", ""))


def test_results_outlive_the_jobs_of_others(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    before = simhash.clusters(spark, docs)
    with shared.job(spark) as folder:
        inside = near_dedup.clusters(spark, docs)
        kept = shared.written(spark, inside, "result", kept=True)
        assert inside.count() == 20 and any(folder_of(folder).iterdir())
    assert not folder_of(folder).exists()
    assert before.count() == 20 and kept.count() == 20


def test_inner_tables_go_with_their_operator(spark):
    with shared.job(spark) as folder:
        near_dedup.clusters(spark, spark.createDataFrame(DOCS, SCHEMA)).count()
        left = {p.name.rsplit("-", 1)[0] for p in folder_of(folder).iterdir()}
        assert left == {"signatures", "class-components"}


def test_session_without_a_shared_folder(tmp_path):
    code = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from folioframe.llm import shared, simhash
docs = spark.createDataFrame([(1, "a b c"), (2, "a b c")], "doc_id bigint, text string")
assert [r.component_id for r in simhash.clusters(spark, docs).collect()] == [1, 1]
print(shared._application_folder(spark))
"""
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(Path(__file__).parents[2])}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert not folder_of(done.stdout.split()[-1]).exists()  # its tables went at the end
