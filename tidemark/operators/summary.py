"""Gold member summary: full and affected-members-only recomputation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import (DEFAULT_TIERS, round_ratio_decimal,
                                      round_ratio_half_up, tier_of, to_date_lit)

SUMMARY_COLUMNS = ("member_id", "total_transactions", "lifetime_spend", "last_active_date",
                   "total_points_earned", "total_points_redeemed", "reward_breakage_rate",
                   "current_tier", "annual_ltv", "days_since_last_txn",
                   "avg_transaction_value", "preferred_channel", "last_updated_ts")


def member_summary(txns: DataFrame, as_of, tiers=DEFAULT_TIERS,
                   run_ts: dt.datetime | None = None, key: str = "member_id") -> DataFrame:
    """One row per member with the twelve Gold measures.

    ``as_of`` replaces CURRENT_DATE and ``run_ts`` CURRENT_TIMESTAMP, so a run
    is reproducible. Ratios are rounded half-up on exact integers (cents,
    points, days). Transactions are aggregated by (member, channel) first, with
    partial sums of primitive types next to the scan, so that a member holding
    a large share of the rows is reduced before the shuffle; what is left, a
    few rows per member, gives the measures and the preferred channel.
    """
    base = txns.select(
        key, "transaction_date", "amount", "points_earned", "redemption_points", "channel",
        (F.col("amount") * 100).cast("long").alias("_c"))
    per_channel = base.groupBy(key, "channel").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("spend"), F.sum("_c").alias("cents"),
        F.sum("points_earned").alias("earned"), F.sum("redemption_points").alias("redeemed"),
        F.min("transaction_date").alias("first_date"), F.max("transaction_date").alias("last_date"))
    return _by_member(per_channel, as_of, tiers, run_ts, key)


def _by_member(per_channel: DataFrame, as_of, tiers, run_ts, key: str) -> DataFrame:
    """Measures of a member from its (member, channel) sums. The preferred channel is the
    non-NULL channel with the highest count, ties to the smallest."""
    if run_ts is None:
        run_ts = dt.datetime.combine(as_of if isinstance(as_of, dt.date)
                                     else dt.date.fromisoformat(as_of), dt.time())
    rank = F.struct(F.col("channel").isNull().alias("no_channel"), (-F.col("n")).alias("k"),
                    F.col("channel"))
    agg = per_channel.groupBy(key).agg(
        F.sum("n").alias("total_transactions"),
        F.sum("spend").cast("decimal(20,2)").alias("lifetime_spend"),
        F.max("last_date").alias("last_active_date"),
        F.min("first_date").alias("_first_date"),
        F.sum("earned").alias("total_points_earned"),
        F.sum("redeemed").alias("total_points_redeemed"),
        F.sum("cents").alias("_cents"),
        F.min_by("channel", rank).alias("preferred_channel"))
    return _finish(agg, to_date_lit(as_of), tiers, run_ts, key)


def _finish(agg: DataFrame, as_of_col, tiers, run_ts, key: str) -> DataFrame:
    return agg.select(
        key,
        "total_transactions",
        "lifetime_spend",
        "last_active_date",
        "total_points_earned",
        "total_points_redeemed",
        # (1 - redeemed / earned) * 100, two decimals
        round_ratio_half_up("100 * (total_points_earned - total_points_redeemed)",
                            "total_points_earned").alias("reward_breakage_rate"),
        tier_of(F.col("lifetime_spend"), tiers).alias("current_tier"),
        # spend per 365 days of activity; NULL for single-day members
        round_ratio_decimal("_cents * 365", "datediff(last_active_date, _first_date) * 100",
                            27).alias("annual_ltv"),
        F.datediff(as_of_col, F.col("last_active_date")).alias("days_since_last_txn"),
        round_ratio_decimal("_cents", "total_transactions * 100", 21)
        .alias("avg_transaction_value"),
        "preferred_channel",
        F.lit(run_ts).cast("timestamp").alias("last_updated_ts"),
    )


ROLLUP_KEYS = ("member_id", "transaction_month", "channel")


def _in_cents(df: DataFrame, column: str) -> bool:
    """Whether a column of amounts is whole cents in a long at most: its sum is that of the cents then, and
    needn't be kept next to it in a shuffle, where it is the widest field."""
    t = df.schema[column].dataType
    return isinstance(t, T.DecimalType) and t.scale == 2 and t.precision <= 26


def _spend(cents: Column, digits: int) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(f"decimal({digits},2)")


def member_rollup(txns: DataFrame, month_col: str = "transaction_month", buckets: int | None = None) -> DataFrame:
    """Additive per-(member, month, channel) state behind the member summary.

    Every Gold measure is a function of these sums, counts and date bounds,
    so the summary of a member can be rebuilt from its rollup rows without
    reading transactions. A month's rows depend only on that month's
    transactions: when a merge rewrites some months, only those are
    re-aggregated (partition-pruned read).

    With ``buckets`` the rows are shuffled by month and as many buckets of members, which serves the
    aggregation and leaves a month's rows in that many tasks at most: written in folders of months
    they make few files, without another shuffle. A member's rows of one month meet in one task.
    """
    exact = _in_cents(txns, "amount")
    base = txns.select("member_id", month_col, "channel", "transaction_date", *([] if exact else ["amount"]),
                       "points_earned", "redemption_points", (F.col("amount") * 100).cast("long").alias("_c"))
    keys = ["member_id", month_col, "channel"]
    if buckets:
        base = base.withColumn("_bucket", F.pmod(F.xxhash64("member_id"), F.lit(int(buckets)))).repartition(month_col, "_bucket")
        keys.append("_bucket")
    rollup = (base.groupBy(*keys)
                  .agg(F.count(F.lit(1)).alias("n"),
                       *([] if exact else [F.sum("amount").alias("spend")]),
                       F.sum("_c").alias("cents"),
                       F.sum("points_earned").alias("earned"),
                       F.sum("redemption_points").alias("redeemed"),
                       F.min("transaction_date").alias("first_date"),
                       F.max("transaction_date").alias("last_date")))
    if exact:
        rollup = rollup.withColumn("spend", _spend(F.col("cents"), txns.schema["amount"].dataType.precision + 10))
    return rollup.select("member_id", month_col, "channel", "n", "spend", "cents", "earned", "redeemed", "first_date", "last_date")


def summary_from_rollup(rollup: DataFrame, as_of, tiers=DEFAULT_TIERS,
                        run_ts: dt.datetime | None = None, key: str = "member_id") -> DataFrame:
    """The member summary rebuilt from rollup rows (equal to ``member_summary``
    on the underlying transactions, including the preferred-channel tie rule:
    highest count, then smallest value)."""
    # one partitioning by member serves both aggregations; spend is made of the cents behind it
    spend = _spend(F.sum("cents"), 38) if _in_cents(rollup, "spend") else F.sum("spend")
    per_channel = rollup.repartition(key).groupBy(key, "channel").agg(
        F.sum("n").alias("n"), spend.alias("spend"), F.sum("cents").alias("cents"),
        F.sum("earned").alias("earned"), F.sum("redeemed").alias("redeemed"),
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))
    return _by_member(per_channel, as_of, tiers, run_ts, key)


def affected_keys(changes: DataFrame, key: str = "member_id") -> DataFrame:
    """Distinct keys touched by a change feed, from every change type.

    Pre-images and deletes count too: a transaction that moves from member A
    to member B changes both summaries.
    """
    return changes.select(key).where(F.col(key).isNotNull()).distinct()


def recompute_affected(txns: DataFrame, keys: DataFrame, as_of, tiers=DEFAULT_TIERS,
                       run_ts=None, key: str = "member_id") -> DataFrame:
    """Summaries for the affected keys only (semi-join to the full history).

    No broadcast hint: the key set can be member-sized, AQE picks broadcast
    or shuffle from the runtime size of the key set.
    """
    scoped = txns.join(keys, key, "left_semi")
    return member_summary(scoped, as_of, tiers, run_ts, key)


def vanished_keys(keys: DataFrame, recomputed: DataFrame, key: str = "member_id") -> DataFrame:
    """Affected keys that no longer have any transaction (to delete from Gold)."""
    return keys.join(recomputed.select(key), key, "left_anti")
