"""A training corpus from the raw documents, stage by stage.

Each stage reads what its predecessor wrote (Parquet in the shared checkpoint
folder), so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordloom.llm.common import store, table
from wordloom.llm.decontam import decontaminate_stage
from wordloom.llm.lang_id import language_stage
from wordloom.llm.minhash import dedup_stage
from wordloom.llm.mixing import mix_stage
from wordloom.llm.token_output import tokens_stage

STAGES = [
    ("language", language_stage),
    ("near_dedup", dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mix", mix_stage),
    ("tokens", tokens_stage),
]

# The language model has no SQL form; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = store(docs, f"stage-{name}")
    return docs
