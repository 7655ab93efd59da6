"""Corpus pipeline: documents through quality rules, near-duplicate removal, benchmark
decontamination, secret masking and sequence packing.

Each stage is one operator of ``seawake.llm`` and works on everything its predecessor kept; its
result is written as Parquet and read again as the next stage's documents. All stages but the last
return the columns of ``documents``. No stage depends on another's internals, so each can be run and
judged alone.

SQL cannot express the fingerprints, the tilings or the token ids, so there is no ``ORACLE_SQL``;
``tests/llm/test_pipeline.py`` compares ``run`` with a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seawake.llm.common import prepare, settle, table
from seawake.llm.decontam import drop_contaminated
from seawake.llm.packing import pack
from seawake.llm.rules import keep_good
from seawake.llm.secrets import mask_secrets
from seawake.llm.simhash import keep_one

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    prepare(spark)
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    prepare(spark)
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark passage."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked in their texts."""
    prepare(spark)
    return mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences."""
    prepare(spark)
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
