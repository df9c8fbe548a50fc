"""Corpus pipeline: quality rules, near duplicates, decontamination, mixing, token blocks.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the last
return the columns of ``documents``, whatever further columns it has. Repeated rows are documents of
their own until near duplicates go, null ids are ids like others, an empty table stays empty. ``run`` writes every stage's result as Parquet in the shared
folder and rereads it for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelgraph.llm import decontaminate, jaccard_join, mixing, quality_rules, token_blocks
from labelgraph.llm.common import carried, read_table, stored
from labelgraph.llm.queries import END_ID, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects; those without words (null, empty) are rejected."""
    own, restore = carried(docs, "doc_id", "text")
    led = quality_rules.ledger(quality_rules.measure(own))
    return restore(quality_rules.apply_policy(led).filter("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id; texts without
    words are in no group."""
    own, restore = carried(docs, "doc_id", "text")
    return restore(jaccard_join.keep_one(own))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark contamination; texts without words have none."""
    return decontaminate.remove_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights: a document as many times as it is taken; null is a source."""
    own, restore = carried(docs, "doc_id", "text", "source")
    return restore(mixing.repeat_rows(mixing.mix(own), own.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in binary files, and the documents' index read back from them."""
    return token_blocks.encode_documents(docs, tokenizer_path(), END_ID)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("token_blocks", tokens),
]

#: Tokenization isn't expressible in SQL; tests compare ``run`` with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
