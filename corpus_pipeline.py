"""The corpus pipeline: quality rules, exact dedup, near-dedup, mixing, tokenisation.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; every result is written as Parquet
and read again.

What a stage writes on its way is deleted at its end, and the table of ids that its result reads once that result is written.

Null texts count as empty. An empty table gives an empty result. Extra columns, whatever their names, go through to the last stage.
Stages tell rows apart by a key of their own, not by doc_id: rows with a null doc_id and rows that share one go through like all others.
Of exact repeats one row stays. Where the smallest doc_id decides, the first row of a doc_id comes in its place, its other rows and rows
without doc_id after all others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortmark.llm import exact_dup, mixing, near_dup, piece_codec, quality
from cohortmark.llm.catalog import piece_model
from cohortmark.llm.runtime import passing, stored  # noqa: F401  (tests write stages as run does)
from cohortmark.llm.stages import kept


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kept(docs, quality.quality)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kept(docs, exact_dup.exact_dup)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kept(docs, near_dup.near_dup)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_codec.digests(docs, piece_model())


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing_sources", mixing_sources),
    ("sentencepiece", sentencepiece),
]

#: The verdicts of perplexity, MinHash and seeded draws are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with passing(spark) as keep:  # the stage's table of ids goes, its result stays
            docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
