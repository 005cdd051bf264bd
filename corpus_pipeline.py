"""Documents to training tokens: quality, near duplicates, repeated passages, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; what it returns is written as Parquet and
reread as the next one's docs. All but the last return the columns of documents; further columns, whatever their names, pass through those four.

In every stage: null texts stay null and empty ones empty, unless the stage drops the row; they have no words, so they are near duplicates of nothing,
hold no passage, and have no tokens. Repeated rows are near duplicates of each other, so one stays. doc_id may be null or repeat. A very long text
is taken whole, as one row. Ties (of labels, scores, groups) are settled as the operators' docstrings say. An empty table gives an empty
result with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanledger.llm import decontaminate as leaks
from spanledger.llm import jaccard, pieces, quality_model, suffix_dedup
from spanledger.llm.common import table, written

# Bytes of a passage that counts as repeated, and of its anchors. Mostly 50 words; the limit is bytes, so more words that are short stay.
PASSAGE, ANCHOR = 240, 64


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the compression classifier rejects."""
    return quality_model.filter_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates."""
    return jaccard.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that are anywhere else too."""
    return suffix_dedup.remove_repeats(docs, PASSAGE, ANCHOR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages."""
    return leaks.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes what is left, in little memory: the stages before have filled the executors' heaps."""
    return pieces.encode(docs, pieces.read_model(pieces.default_model()), small=True)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontaminate", decontaminate),
    ("tokens", tokens),
]

# Neither compression nor minimal hashes nor the piece lattice can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
