"""From raw documents to token ids: quality, repeated lines, near copies, benchmark items, encoding.

Each stage takes (spark, docs, folder of the tables) and works on all its predecessor kept. Its result is written as
Parquet in the shared folder and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relata.llm import bpe, decontaminate, line_dedup, nbsvm, simhash
from relata.llm.catalog_files import tokenizer_file
from relata.llm.frames import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return nbsvm.keep(docs, nbsvm.train(docs, table(spark, sf_dir, "labels")))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line runs that occur earlier; one of which nothing is left goes."""
    found = line_dedup.remove_repeats(docs)
    left = F.btrim("text", F.lit(line_dedup.SPACE)) != ""
    return found.where((F.col("n_removed") == 0) | left).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_per_group(docs)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    return bpe.encode(docs, tokenizer_file())


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", repeated_lines),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark_items),
    ("bpe_encoding", tokens),
]

#: The stages fit models and compare texts in ways that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage: doc_id, n_tokens, token_ids."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
