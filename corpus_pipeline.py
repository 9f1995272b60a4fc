"""A training corpus from raw documents, in five stages.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. ``run`` applies them to the table of documents in turn;
each stage's result is written as Parquet in the shared folder and read again as
the next one's documents. All stages but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard_join, mixing, quality, suffix_dedup
from tidemark.llm.stage import Scratch, read


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, a similarity of 0.8 or more."""
    return jaccard_join.keep_one(docs, k=5, percent=80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that an earlier document has; n_chars follows the text."""
    carry = [c for c in docs.columns if c != "text"]
    kept = suffix_dedup.removed_bytes(docs, output="text", carry=carry)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark items don't contaminate."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixture),
]

#: The classifier is a trained model, which SQL can't express; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
