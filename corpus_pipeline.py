"""The corpus pipeline: five stages, each over all that the one before it kept.

Every stage but the last returns the columns of documents. `run` applies them to the documents table in turn; its rows
are those of the last stage. SQL cannot express the stages (a learned model, a tokenizer), so ORACLE_SQL is None.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataforge.llm.common import cut, read_table
from strataforge.llm.decontaminate import keep_clean
from strataforge.llm.jaccard_join import keep_one
from strataforge.llm.line_dedup import drop_lines
from strataforge.llm.quality_rank import keep_good
from strataforge.llm.sentence_pieces import encode_digests


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line makes redundant."""
    return drop_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8 or more."""
    return keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encoded and decoded documents, with spans."""
    return encode_digests(docs)


STAGES = [("quality_rank", quality), ("line_dedup", lines), ("jaccard_join", near_copies), ("decontaminate", benchmark), ("sentence_pieces", pieces)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is cut to the shared folder before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
