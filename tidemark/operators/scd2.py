"""Type 2 history of a member attribute (the tier), with point-in-time lookup.

Periods are closed-closed: a period closed on day d has ``expiry_date = d - 1``
and the next one starts on d. Lookup uses ``effective_date <= x <= expiry_date``
so the last day of a closed period still finds its row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import OPEN_EXPIRY, to_date_lit
from tidemark.operators.merge import CHANGE_TYPE

HISTORY_COLUMNS = ("member_id", "current_tier", "effective_date", "expiry_date", "is_current")


def init_history(summary: DataFrame, as_of, key: str = "member_id",
                 attr: str = "current_tier") -> DataFrame:
    """One open period per member starting on ``as_of``."""
    return summary.select(key, attr,
                          to_date_lit(as_of).alias("effective_date"),
                          F.lit(OPEN_EXPIRY).cast("date").alias("expiry_date"),
                          F.lit(True).alias("is_current"))


def tier_changes(summary: DataFrame, history: DataFrame, key: str = "member_id",
                 attr: str = "current_tier") -> DataFrame:
    """Members whose current value differs from their open period, or who
    have no open period (new members): key, new_tier, old_tier, open_since.

    Both sides are member-sized, so no broadcast hint: AQE chooses.
    """
    active = (history.where(F.col("is_current"))
                     .select(key, F.col(attr).alias("old_tier"),
                             F.col("effective_date").alias("open_since")))
    return (summary.select(key, F.col(attr).alias("new_tier"))
                   .join(active, key, "left")
                   .where(F.col("old_tier").isNull() |
                          ~F.col("new_tier").eqNullSafe(F.col("old_tier"))))


def apply_tier_changes(history: DataFrame, summary: DataFrame, as_of, key: str = "member_id",
                       attr: str = "current_tier") -> tuple[DataFrame, DataFrame]:
    """Close changed open periods on ``as_of - 1`` and open new ones on ``as_of``.

    Returns (new_history, changes) as one snapshot, so a crash never leaves
    closed periods without their successor. A second change on the same day
    rewrites that day's open period in place instead of producing a period
    that ends before it starts. Members absent from ``summary`` keep their
    open period.
    """
    d = to_date_lit(as_of)
    ch = tier_changes(summary, history, key, attr)
    marks = ch.select(key, "new_tier", F.lit(True).alias("_chg"))
    h = history.join(marks, key, "left")
    cur_chg = F.col("is_current") & F.coalesce(F.col("_chg"), F.lit(False))
    same_day = cur_chg & (F.col("effective_date") == d)
    close = cur_chg & ~same_day
    new_cols = [
        F.col(key),
        F.when(same_day, F.col("new_tier")).otherwise(F.col(attr)).alias(attr),
        F.col("effective_date"),
        F.when(close, F.date_sub(d, 1)).otherwise(F.col("expiry_date")).alias("expiry_date"),
        F.when(close, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
    ]
    kept = h.select(*new_cols)
    opened = (ch.where(F.col("old_tier").isNull() | (F.col("open_since") != d))
                .select(key, F.col("new_tier").alias(attr), d.alias("effective_date"),
                        F.lit(OPEN_EXPIRY).cast("date").alias("expiry_date"),
                        F.lit(True).alias("is_current")))
    new_history = kept.unionByName(opened)

    touched = h.where(cur_chg)
    pre = touched.select(key, attr, "effective_date", "expiry_date", "is_current") \
                 .withColumn(CHANGE_TYPE, F.lit("update_preimage"))
    post = touched.select(*new_cols).withColumn(CHANGE_TYPE, F.lit("update_postimage"))
    ins = opened.withColumn(CHANGE_TYPE, F.lit("insert"))
    return new_history, pre.unionByName(post).unionByName(ins)


def tier_as_of(history: DataFrame, when, key: str = "member_id",
               attr: str = "current_tier") -> DataFrame:
    """Value of the attribute per member on day ``when``."""
    d = to_date_lit(when if not isinstance(when, dt.datetime) else when.date())
    return (history.where((F.col("effective_date") <= d) & (F.col("expiry_date") >= d))
                   .select(key, attr))
