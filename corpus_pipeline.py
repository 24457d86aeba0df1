"""A corpus pipeline: each stage calls one operator on what the stage before kept.

Every function takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which
is written as Parquet and read again as the next stage's ``docs``.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starloom.llm import decontam, fertility, piece_fst, simhash, toxicity
from starloom.llm.common import store, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the fertility bands keep."""
    return fertility.keep(docs, public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; learned from the labels of the documents at hand."""
    return toxicity.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest id."""
    return simhash.dedup(docs, shingle=4, distance=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark's passages don't contaminate."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, decoded again to check them."""
    return piece_fst.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality rules", quality_rules), ("toxicity", toxicity_filter), ("near duplicates", near_duplicates),
          ("decontamination", decontamination), ("sentencepiece", sentencepiece)]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
