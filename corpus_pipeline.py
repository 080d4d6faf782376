"""The corpus pipeline: toxicity, near duplicates, benchmark decontamination, mixing, token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontaminate, mixing, simhash, token_files, toxicity
from ledgerloom.llm.queries import tokenizer_path
from ledgerloom.llm.text import documents, stored, text_batches
from ledgerloom.session import new_shared_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more go."""
    with text_batches(spark):  # stored here, as the batches hold for what runs now
        return stored(toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), "not-toxic")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, the one with the smallest id."""
    return simhash.keep_one(docs, simhash.SHINGLE, simhash.DISTANCE)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a document taken twice is two rows."""
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as token files, and what they say about each document in them."""
    path = new_shared_path(spark, "tokens")
    token_files.write_tokens(docs, path, tokenizer_path())
    return token_files.read_tokens(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_output", token_output),
]

ORACLE_SQL = None  # nearest examples, fingerprints, random rounding and tokenizers are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
