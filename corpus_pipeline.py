"""From raw documents to token ids: each stage's rows are written as Parquet and read again as the next stage's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, simhash, tokenids, toxicity
from tidemark.llm.common import stored, table
from tidemark.llm.queries import TOKENIZER
from tidemark.session import scratch_folder
from tidemark.sources.swap import remove


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject; it learns from the labelled rows of ``docs``."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a Jaccard similarity of 0.8 or more."""
    return simhash.drop_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than 0.8 of the five-word shingles of every benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written as files and read back: place, length and checksum of each document."""
    return tokenids.token_digest(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("source_mixing", mix_sources),
    ("token_ids", token_ids),
]

#: The classifier and the tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result of the last stage. A stage's own tables and its input go once its output is stored."""
    docs, kept = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch_folder(spark, name) as own:
            found = stage(spark, docs, sf_dir)
        with scratch_folder(spark, f"{name}-output") as output:
            docs = stored(found, name)
        for done in (own, kept):
            if done is not None:
                remove(spark, done)
        kept = output
    return STAGES[-1][1](spark, docs, sf_dir)
