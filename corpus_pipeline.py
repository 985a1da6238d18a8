"""A corpus pipeline over documents: each stage reads what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadloom.llm import common
from roadloom.llm.bpe import tokenized
from roadloom.llm.line_dedup import drop_lines
from roadloom.llm.mixing import mix
from roadloom.llm.near_dedup import drop_near_duplicates
from roadloom.llm.quality_rules import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules reject go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go; n_chars follows."""
    return drop_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (5-word shingles, 0.8)."""
    return drop_near_duplicates(docs, width=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document comes as often as it is taken."""
    return mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document of the mix, with digests of ids and decoded text."""
    return tokenized(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("encoding", encoding)]

#: Rules weighed by EM, near-duplicate groups, pivotal rounding and byte pair merges have no
#: SQL form; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is cut into the shared folder."""
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
