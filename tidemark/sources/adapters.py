"""Driver tables -> the loyalty data model.

The driver supplies TPC-H-like tables. A transaction is one ``lineitem`` row
joined to its ``orders`` row; a store is a ``supplier`` with its nation and
region. All mappings are plain column expressions, so the scan keeps only the
columns it needs and the join is an ordinary equi-join planned by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values (must stay as given) ------------------------------------
# Order priority -> sales channel; other priorities have no channel (NULL).
CHANNEL_BY_PRIORITY = (("1-URGENT", "POS"), ("2-HIGH", "POS"),
                       ("3-MEDIUM", "mobile_app"), ("5-LOW", "partner_api"))
# Upstream tier label by order total, highest first.
UPSTREAM_TIER_BY_TOTAL = (("platinum", 400000), ("gold", 300000), ("silver", 150000))
# Deterministic fault injection: (column affected, key column, modulus).
FAULT_NULL_MEMBER = ("l_orderkey", 97)
FAULT_NULL_AMOUNT = ("l_partkey", 101)
FAULT_NEGATIVE_AMOUNT = ("l_suppkey", 53)
# ---------------------------------------------------------------------------

TRANSACTION_COLUMNS = ("transaction_id", "member_id", "transaction_date", "amount",
                       "points_earned", "channel", "store_id", "tier",
                       "redemption_points")


def read_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _channel(priority):
    expr = None
    for prio, channel in CHANNEL_BY_PRIORITY:
        cond = priority == F.lit(prio)
        expr = F.when(cond, F.lit(channel)) if expr is None else expr.when(cond, F.lit(channel))
    return expr


def _upstream_tier(total):
    expr = None
    for name, threshold in UPSTREAM_TIER_BY_TOTAL:
        cond = total >= F.lit(threshold)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit("bronze"))


def batch_id_of(date_col):
    """Landing batch key: ``yyyyMM`` of the business date, as an int."""
    return (F.year(date_col) * 100 + F.month(date_col)).cast("int")


def landing_transactions(spark: SparkSession, sf_dir: str, faults: bool = True) -> DataFrame:
    """Raw landing rows (one per ``lineitem``), with ``batch_id``.

    ``transaction_id`` repeats naturally in the driver's data: repeats play the
    part of late arrivals and upstream retries. With ``faults`` three fixed
    rules null the member, null the amount or negate it, so quality rules have
    something to catch.
    """
    tdate = F.col("l_shipdate").cast("date")
    amount = F.col("l_extendedprice").cast("decimal(10,2)")
    member = F.concat(F.lit("MBR"), F.col("o_custkey").cast("string"))
    if faults:
        key, mod = FAULT_NULL_MEMBER
        member = F.when(F.col(key) % mod == 0, F.lit(None).cast("string")).otherwise(member)
        key_n, mod_n = FAULT_NULL_AMOUNT
        key_neg, mod_neg = FAULT_NEGATIVE_AMOUNT
        amount = (F.when(F.col(key_n) % mod_n == 0, F.lit(None).cast("decimal(10,2)"))
                  .when(F.col(key_neg) % mod_neg == 0, -amount)
                  .otherwise(amount))
    # what either side's columns give is made before the join, as it is less to shuffle
    li = read_source(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", tdate.alias("transaction_date"), amount.alias("amount"),
        F.col("l_quantity").cast("int").alias("qty"))
    od = read_source(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", _channel(F.col("o_orderpriority")).alias("channel"),
        _upstream_tier(F.col("o_totalprice")).alias("tier"))
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    tdate, qty = F.col("transaction_date"), F.col("qty")
    return j.select(
        F.concat(F.lit("TXN_"), F.col("l_orderkey").cast("string"), F.lit("_"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        member.alias("member_id"),
        "transaction_date",
        "amount",
        (qty * 10).alias("points_earned"),
        "channel",
        F.concat(F.lit("STR"), F.col("l_suppkey").cast("string")).alias("store_id"),
        "tier",
        (qty * F.col("l_linenumber")).alias("redemption_points"),
        batch_id_of(tdate).alias("batch_id"),
    )


def store_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """store_id, store_name, state, region from supplier -> nation -> region."""
    s = read_source(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read_source(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_source(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
             .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
             .select(F.concat(F.lit("STR"), F.col("s_suppkey").cast("string")).alias("store_id"),
                     F.col("s_name").alias("store_name"),
                     F.col("n_name").alias("state"),
                     F.col("r_name").alias("region")))
