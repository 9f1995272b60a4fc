"""Fact x dimension enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

class DuplicateKeyError(ValueError):
    pass


def assert_unique(df: DataFrame, keys) -> None:
    keys = [keys] if isinstance(keys, str) else list(keys)
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count()
    if dup:
        raise DuplicateKeyError(f"dimension key {keys} is not unique")


def enrich(fact: DataFrame, dim: DataFrame, key: str, check_unique: bool = True) -> DataFrame:
    """Left outer join of ``fact`` to ``dim`` on ``key``.

    A duplicate dimension key would multiply fact rows, so uniqueness is
    asserted first. Spark broadcasts the dimension where its size (from
    statistics, or measured by AQE at run time) is below the session's
    threshold, and shuffles otherwise.
    """
    if check_unique:
        assert_unique(dim, key)
    return fact.join(dim, key, "left")


def match_rate(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Share of fact rows whose key finds a dimension row (one pass, semi-join)."""
    flagged = fact.select(key).join(
        dim.select(key).distinct().withColumn("_hit", F.lit(1)), key, "left")
    return flagged.agg(F.count(F.lit(1)).alias("fact_rows"),
                       F.count("_hit").alias("matched_rows"))
