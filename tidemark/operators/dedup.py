"""Keep the latest row per business key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Total order of versions of one transaction, newest first: the batch stamp,
# then every business column, so equal-stamp duplicates resolve the same way
# on every run (identical rows are interchangeable).
TRANSACTION_TIEBREAK = ("transaction_date", "amount", "points_earned", "redemption_points",
                        "store_id", "member_id", "channel", "tier")


def ingest_order(df: DataFrame, stamps=("ingested_at", "batch_id"),
                 tiebreak=TRANSACTION_TIEBREAK) -> list[Column]:
    cols = [c for c in (*stamps, *tiebreak) if c in df.columns]
    return [F.col(c).desc_nulls_last() for c in cols]


def latest_per_key(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order) = 1``.

    Spark plans this as WindowGroupLimit (partial, before the shuffle) +
    Window, so each map task already keeps one row per key: a key that holds
    a large share of the rows does not travel through the shuffle in full.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))
