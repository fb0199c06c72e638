"""The corpus pipeline: five stages, each applied to all documents that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from transferlens.llm import stages
from transferlens.llm.common import staged, table

STAGES = [
    ("language", stages.language),
    ("near_dedup", stages.near_dedup),
    ("decontaminate", stages.decontaminate),
    ("mix", stages.mix),
    ("tokenise", stages.tokenise),
]

# Language scores, min-wise sampling and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
