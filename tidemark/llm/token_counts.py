"""Exact token-length histogram: one aggregation answers every context limit.

Documents are encoded with a public tokenizer and reduced to their number of
tokens inside the tasks; the histogram of lengths is aggregated with map-side
combine, so that only (length, count) pairs are shuffled. Suffix sums over the
histogram give totals, quantiles and truncated totals for every limit. They are
taken in two levels, within ranges of lengths and over the ranges, so no task
sees more than one range, whatever the longest document is.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.stage import Scratch

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-tokenisation pattern that belongs to the 50k byte-level BPE vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY_BYTES = 64 << 20
RANGE = 4096

_encoders: dict[int, object] = {}


def _encoder(data: bytes, pattern: str):
    key = hash((data, pattern))
    if key not in _encoders:
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}
        _encoders[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[key]


def encoded_lengths(docs: DataFrame, *, text: str = "text", path: str = TOKENIZER, pattern: str = PATTERN) -> DataFrame:
    """Rows (n_tokens, n_docs) per batch: the tokens of each document, whole text, ordinary text
    only (a special token's string has no meaning). Null and empty texts have 0 tokens."""
    spark: SparkSession = docs.sparkSession
    if os.path.getsize(path) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes and is not broadcast")
    with open(path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, pattern)
        for b in batches:
            lengths = np.fromiter((len(encoder.encode_ordinary(t)) if t else 0
                                   for t in (x.as_py() for x in b.column(0))), np.int64, b.num_rows)
            n, docs_ = np.unique(lengths, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(docs_.astype(np.int64))], ["n_tokens", "n_docs"])

    return docs.select(F.col(text).alias("text")).mapInArrow(count, "n_tokens long, n_docs long")


def length_histogram(docs: DataFrame, **options) -> DataFrame:
    """(n_tokens, n_docs): how many documents have each encoded length."""
    return encoded_lengths(docs, **options).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(histogram: DataFrame, width: int = RANGE) -> DataFrame:
    """For each length L that occurs: n_docs and tokens at L; docs_upto and tokens_upto (documents no
    longer than L); docs_over and tokens_over; truncated_total (all tokens when each document is cut
    at L), lost_tokens, and quantile, the share of documents no longer than L."""
    tokens = F.col("n_tokens") * F.col("n_docs")
    h = histogram.withColumn("tokens", tokens).withColumn("part", F.floor(F.col("n_tokens") / width))
    within = Window.partitionBy("part").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    parts = h.groupBy("part").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    parts = parts.select(
        F.col("part").alias("p"), F.coalesce(F.sum("d").over(before.orderBy("part")), F.lit(0)).alias("d0"),
        F.coalesce(F.sum("t").over(before.orderBy("part")), F.lit(0)).alias("t0"),
        F.sum("d").over(everything).alias("all_docs"), F.sum("t").over(everything).alias("all_tokens"))
    out = h.join(parts, h["part"] == parts["p"]).select(
        "n_tokens", "n_docs", "tokens",
        (F.col("d0") + F.sum("n_docs").over(within)).alias("docs_upto"),
        (F.col("t0") + F.sum("tokens").over(within)).alias("tokens_upto"), "all_docs", "all_tokens")
    return out.select(
        "n_tokens", "n_docs", "tokens", "docs_upto", "tokens_upto",
        (F.col("all_docs") - F.col("docs_upto")).alias("docs_over"),
        (F.col("all_tokens") - F.col("tokens_upto")).alias("tokens_over"),
        (F.col("tokens_upto") + F.col("n_tokens") * (F.col("all_docs") - F.col("docs_upto"))).alias("truncated_total"),
        (F.col("all_tokens") - F.col("tokens_upto") - F.col("n_tokens") * (F.col("all_docs") - F.col("docs_upto"))).alias("lost_tokens"),
        (F.col("docs_upto") / F.col("all_docs")).alias("quantile"))


def at_limit(sums: DataFrame, limit: int) -> DataFrame:
    """One row for any context limit, also one that no document has: total and truncated tokens,
    documents that fit. From the last length that occurs at or below the limit; what is longer
    counts ``limit`` tokens each."""
    fits = F.col("n_tokens") <= limit
    found = sums.agg(F.max(F.when(fits, F.col("docs_upto"))).alias("fit"), F.max(F.when(fits, F.col("tokens_upto"))).alias("whole"),
                     F.sum("n_docs").alias("n"), F.sum("tokens").alias("total"))
    fit, whole = F.coalesce("fit", F.lit(0)), F.coalesce("whole", F.lit(0))
    return found.select(
        F.lit(limit).cast("long").alias("context_limit"), fit.alias("docs_that_fit"), F.coalesce("total", F.lit(0)).alias("total_tokens"),
        (whole + F.lit(limit) * (F.coalesce("n", F.lit(0)) - fit)).alias("truncated_total"))


def token_counts(docs: DataFrame, **options) -> DataFrame:
    """The histogram of encoded lengths with its suffix sums, a row per length that occurs.

    Null and empty texts are documents of 0 tokens; repeated rows count as often as they occur; other
    columns are ignored. An empty table gives no rows. The histogram, a row per length, is written
    once, as the sums read it twice and texts are to be encoded once.
    """
    return suffix_sums(Scratch(docs.sparkSession, "token-counts").save(length_histogram(docs, **options), "histogram"))
