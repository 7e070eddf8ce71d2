"""The queries of this subpackage and, where SQL can express one, its DuckDB form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioframe.llm.bpe import op9_bpe
from folioframe.llm.chroma import op4_chroma
from folioframe.llm.conversations import op11_conversations
from folioframe.llm.mixing import op6_mixing
from folioframe.llm.near_dedup import op7_near_dedup
from folioframe.llm.negatives import ORACLE as OP13
from folioframe.llm.negatives import op13_negatives
from folioframe.llm.oracle_near import OP7
from folioframe.llm.oracle_quality import OP2
from folioframe.llm.pii import op8_pii
from folioframe.llm.quality_rules import op2_quality_rules
from folioframe.llm.token_files import op10_token_files
from folioframe.llm.secrets import op5_secrets
from folioframe.llm.simhash import op12_simhash
from folioframe.llm.suffix_dedup import op1_suffix_dedup
from folioframe.llm.toxicity import op3_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_toxicity": op3_toxicity,
    "op4_chroma": op4_chroma,
    "op5_secrets": op5_secrets,
    "op6_mixing": op6_mixing,
    "op7_near_dedup": op7_near_dedup,
    "op8_pii": op8_pii,
    "op9_bpe": op9_bpe,
    "op10_token_files": op10_token_files,
    "op11_conversations": op11_conversations,
    "op12_simhash": op12_simhash,
    "op13_negatives": op13_negatives,
}

ORACLES: dict[str, str] = {
    "op2_quality_rules": OP2,
    "op7_near_dedup": OP7,
    "op13_negatives": OP13,
}
