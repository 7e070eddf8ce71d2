"""Five stages from raw documents to token ids.

Each stage gets what the one before kept, written as Parquet and read again. The quality rules drop documents, near
duplicates leave one document of each group, personal data is replaced in the texts, the mix orders the documents so
that any stretch of the files follows the sources' target weights, and the last stage encodes the texts. Files may be read
in any order, so the last stage finds each document's slot and rank again, from its rows alone, and returns them: the
result ordered by slot and rank is the mix.

Edge cases, in every stage: an empty table gives an empty one; columns beyond those of documents, of any name, pass through
all but the last; documents without a text go in the first stage, as they fail the base rules; rows with a null doc_id, lang
or source are rows like others; of near duplicates without ids one of each class stays; repeated rows count as copies of
each other, so one stays; texts of any length are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioframe.llm import bpe, mixing, near_dedup, pii, quality_rules
from folioframe.llm.shared import discard, job, table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.filter_documents(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words to a shingle, similarity 0.8 or more."""
    return near_dedup.keep_one(spark, docs, size=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mix."""
    return mixing.mixed(spark, docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens, digests of ids and decoded text, and place in the mix (slot and rank) of each document."""
    at = mixing.slotted(spark, docs, ["doc_id", "text"]).select("_row.*", "slot", "rank")
    return bpe.digest(spark, at, bpe.vocabulary("byte_bpe_50k.json"), ("slot", "rank"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mix", mix), ("encode", encode)]

#: SQL can't express the merges of the last stage; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, kept = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with job(spark):  # what the stage writes on its way goes with it
            docs = written(spark, stage(spark, docs, sf_dir), f"stage-{name}", kept=True)
        discard(spark, *kept)
        kept = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
