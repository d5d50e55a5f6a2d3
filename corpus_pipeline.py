"""From raw documents to token files: quality, near duplicates, benchmark passages, mixing, tokens.

Each stage takes what the one before kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termspace.llm import decontaminate, mixing, quality, simhash, token_output
from termspace.llm.common import remainder, table
from termspace.llm.queries import END_ID, TOKENIZER
from termspace.session import remove, scratch_path

# The stages draw at random and train a model: no SQL gives the same rows.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; its labels are those of four fifths of the ids."""
    labels = table(spark, sf_dir, "labels").filter(remainder("doc_id", 5) != 0)
    return quality.drop_low_quality(docs, quality.fit_quality(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place and checksum of every document in the token files, read back from them."""
    folder = scratch_path(spark, "tokens")
    token_output.write_tokens(docs, folder, TOKENIZER, END_ID)
    return token_output.read_documents(spark, folder)


STAGES = [
    ("quality", keep_good),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark),
    ("mix", mix_sources),
    ("tokens", write_token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage has written goes when the next one has read it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
