"""The cleaning pipeline over ``documents``: each stage reads what its predecessor wrote.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
they were given. Null texts count as empty; a null ``doc_id`` is kept; an empty table passes
through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchloom.llm import mixing, near_copies, quality_trees, spaced_seeds, winnow
from matchloom.llm.base import remainder
from matchloom.session import load, materialize

LEAST_QUALITY = 0.5
SHINGLE = 5
TARGETS = {"good": 0.92, "poor": 0.05, "toxic": 0.03}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    trees = quality_trees.train(docs, load(spark, sf_dir, "labels"), remainder(3) != 1)
    return quality_trees.keep(docs, trees, LEAST_QUALITY)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines and sentences that an earlier document (or an earlier part) has are deleted."""
    return winnow.dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard 0.8 or more) stays."""
    return near_copies.one_of_each(docs, SHINGLE)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return spaced_seeds.clean(docs, load(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets the rate at which it is to be drawn, and whole copies that meet the rates."""
    return mixing.mixed(docs, mixing.domain_labels(load(spark, sf_dir, "labels")), TARGETS)


STAGES = [
    ("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
    ("decontaminate", decontaminate), ("mix", mix),
]

#: Trees, components and fitted rates have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
