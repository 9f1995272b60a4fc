"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` plus oracle SQL.

Each query reads the driver's tables (or tables Spark derived from them in
the run's work folder) in full; nothing is capped, sampled or id-filtered.
Decimal outputs are cast to DOUBLE and timestamps that depend on the wall
clock are left out, so results compare exactly with the DuckDB oracle.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidemark.functions.exprs import FIXTURE_TIERS, month_of
from tidemark.operators.dedup import ingest_order, latest_per_key
from tidemark.operators.quality import split_rules
from tidemark.operators.summary import member_summary
from tidemark.plans import analytics as an
from tidemark.plans import oracles as o
from tidemark.session import configure
from tidemark.sources.adapters import landing_transactions

# ---- scenario parameters (fixed) -------------------------------------------
AS_OF = dt.date(2001, 12, 31)
RUN_TS = dt.datetime(2002, 1, 1, 5, 0, 0)
TIERS = FIXTURE_TIERS
# ---------------------------------------------------------------------------

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def comparable(df: DataFrame, drop=("last_updated_ts", "quarantine_ts", "ingested_at")) -> DataFrame:
    """Cast decimals to double and drop wall-clock columns."""
    cols = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        c = F.col(f"`{f.name}`")
        cols.append(c.cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else c)
    return df.select(*cols)


# ---- shared in-memory plans --------------------------------------------------

def silver_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """landing -> row rules -> latest per transaction -> month column."""
    clean, _ = split_rules(landing_transactions(spark, sf_dir))
    latest = latest_per_key(clean, "transaction_id", ingest_order(clean))
    return latest.withColumn("transaction_month", month_of(F.col("transaction_date")))


def gold_frame(spark: SparkSession, sf_dir: str, as_of=AS_OF) -> DataFrame:
    return member_summary(silver_frame(spark, sf_dir), as_of, TIERS, RUN_TS)


def published(spark: SparkSession, sf_dir: str, layer: str) -> DataFrame:
    """Latest published Gold / Silver of the three-run scenario.

    Analytics read the published tables (member-sized Gold, month-partitioned
    Silver) instead of re-deriving them from the raw join on every query.
    """
    from tidemark.plans import pipeline as pl
    from tidemark.plans.scenario import scenario
    return scenario(spark, sf_dir).read_table({"gold": pl.GOLD, "silver": pl.SILVER}[layer])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LTV by tier computed end to end from the raw tables (no stored state)."""
    return an.ltv_by_tier(gold_frame(spark, sf_dir))


SILVER_SQL = o.silver_ctes()
GOLD_SQL = f"{SILVER_SQL},\n{o.gold_cte('gold', 'silver', AS_OF, TIERS)}"


# ---- member summary and analytics -------------------------------------------

@register("member_summary", f"WITH {GOLD_SQL}\nSELECT {o.GOLD_COLUMNS_SQL} FROM gold")
def q_member_summary(spark, sf_dir):
    return comparable(gold_frame(spark, sf_dir))


@register("ltv_by_tier", f"""WITH {GOLD_SQL},
g AS (SELECT current_tier, CAST(lifetime_spend * 100 AS BIGINT) AS sc,
             CAST(annual_ltv * 100 AS BIGINT) AS lc,
             CAST(avg_transaction_value * 100 AS BIGINT) AS bc, total_transactions FROM gold),
a AS (SELECT current_tier, COUNT(*) AS member_count, SUM(sc) AS sc, SUM(lc) AS lc,
             COUNT(lc) AS ln, SUM(bc) AS bc, SUM(total_transactions) AS tx
      FROM g GROUP BY current_tier)
SELECT current_tier, member_count,
       {o.rounded('sc', 'member_count * 100')} AS avg_lifetime_spend,
       {o.rounded('lc', 'ln * 100')} AS avg_annual_ltv,
       CAST(sc AS DOUBLE) / 100.0 AS total_lifetime_spend,
       {o.rounded('bc', 'member_count * 100')} AS avg_basket_size,
       {o.rounded('tx', 'member_count', 10)} AS avg_transactions_per_member
FROM a""")
def q_ltv_by_tier(spark, sf_dir):
    return an.ltv_by_tier(published(spark, sf_dir, "gold"))


@register("breakage_by_tier", f"""WITH {GOLD_SQL},
a AS (SELECT current_tier, COUNT(*) AS member_count,
             SUM(CAST(round(reward_breakage_rate * 100) AS BIGINT)) AS b,
             COUNT(reward_breakage_rate) AS bn,
             CAST(SUM(total_points_earned) AS BIGINT) AS total_points_issued,
             CAST(SUM(total_points_redeemed) AS BIGINT) AS total_points_redeemed
      FROM gold GROUP BY current_tier)
SELECT current_tier, member_count, {o.rounded('b', 'bn * 100')} AS avg_breakage_rate_pct,
       total_points_issued, total_points_redeemed,
       total_points_issued - total_points_redeemed AS total_points_unredeemed
FROM a""")
def q_breakage_by_tier(spark, sf_dir):
    return an.breakage_by_tier(published(spark, sf_dir, "gold"))


@register("channel_engagement", f"""WITH {GOLD_SQL},
c AS (SELECT current_tier, preferred_channel, COUNT(*) AS member_count
      FROM gold WHERE preferred_channel IS NOT NULL GROUP BY current_tier, preferred_channel)
SELECT current_tier, preferred_channel, member_count,
       {o.rounded('member_count * 100', 'SUM(member_count) OVER (PARTITION BY current_tier)', 10)}
         AS pct_of_tier
FROM c""")
def q_channel_engagement(spark, sf_dir):
    return an.channel_engagement(published(spark, sf_dir, "gold"))


@register("churn_propensity", f"""WITH {GOLD_SQL}
SELECT member_id, current_tier, days_since_last_txn, CAST(lifetime_spend AS DOUBLE) AS lifetime_spend,
       CAST(avg_transaction_value AS DOUBLE) AS avg_transaction_value, total_transactions,
       {o.churn_case('days_since_last_txn')} AS churn_segment
FROM gold""")
def q_churn_propensity(spark, sf_dir):
    return comparable(an.churn_propensity(published(spark, sf_dir, "gold"), AS_OF))


@register("high_value_at_risk", f"""WITH {GOLD_SQL}
SELECT member_id, current_tier, CAST(lifetime_spend AS DOUBLE) AS lifetime_spend,
       CAST(annual_ltv AS DOUBLE) AS annual_ltv, days_since_last_txn, last_active_date,
       preferred_channel
FROM gold WHERE current_tier IN ('platinum', 'gold') AND days_since_last_txn >= 90""")
def q_high_value_at_risk(spark, sf_dir):
    return comparable(an.high_value_at_risk(published(spark, sf_dir, "gold"), AS_OF))


@register("monthly_active", f"""WITH {SILVER_SQL}
SELECT transaction_month, COUNT(DISTINCT member_id) AS active_members,
       CAST(SUM(CAST(amount * 100 AS BIGINT)) AS DOUBLE) / 100.0 AS total_revenue,
       {o.rounded('SUM(CAST(amount * 100 AS BIGINT))', 'COUNT(*) * 100')} AS avg_transaction_value,
       COUNT(*) AS total_transactions
FROM silver GROUP BY transaction_month""")
def q_monthly_active(spark, sf_dir):
    return an.monthly_active(published(spark, sf_dir, "silver"))


@register("preferred_channel", f"""WITH {GOLD_SQL}
SELECT member_id, preferred_channel FROM gold""")
def q_preferred_channel(spark, sf_dir):
    return gold_frame(spark, sf_dir).select("member_id", "preferred_channel")


@register("member_tier", f"""WITH {GOLD_SQL}
SELECT member_id, CAST(lifetime_spend AS DOUBLE) AS lifetime_spend, current_tier FROM gold""")
def q_member_tier(spark, sf_dir):
    return comparable(gold_frame(spark, sf_dir).select("member_id", "lifetime_spend",
                                                       "current_tier"))


# ---- silver entry: rules, dedup --------------------------------------------

@register("dedup_latest", f"""WITH {SILVER_SQL}
SELECT transaction_id, member_id, transaction_date, CAST(amount AS DOUBLE) AS amount,
       points_earned, channel, store_id, tier, redemption_points, batch_id FROM silver""")
def q_dedup_latest(spark, sf_dir):
    clean, _ = split_rules(landing_transactions(spark, sf_dir))
    return comparable(latest_per_key(clean, "transaction_id", ingest_order(clean)))


@register("dq_clean", f"""WITH {o.landing_cte()}
SELECT transaction_id, member_id, transaction_date, CAST(amount AS DOUBLE) AS amount,
       points_earned, channel, store_id, tier, redemption_points, batch_id
FROM landing WHERE {o.CLEAN_PRED}""")
def q_dq_clean(spark, sf_dir):
    clean, _ = split_rules(landing_transactions(spark, sf_dir))
    return comparable(clean)


@register("dq_quarantine", f"""WITH {o.landing_cte()}
SELECT transaction_id, member_id, transaction_date, CAST(amount AS DOUBLE) AS amount, batch_id,
       'failed_dq_check' AS quarantine_reason,
       concat_ws(',', CASE WHEN NOT COALESCE(amount > 0, FALSE) THEN 'amount_positive' END,
                      CASE WHEN member_id IS NULL THEN 'member_present' END,
                      CASE WHEN transaction_date IS NULL THEN 'date_present' END) AS failed_rules
FROM landing WHERE NOT ({o.CLEAN_PRED})""")
def q_dq_quarantine(spark, sf_dir):
    _, bad = split_rules(landing_transactions(spark, sf_dir))
    return comparable(bad.select("transaction_id", "member_id", "transaction_date", "amount",
                                 "batch_id", "quarantine_reason",
                                 F.array_join("failed_rules", ",").alias("failed_rules")))


@register("silver_month", f"""WITH {SILVER_SQL}
SELECT transaction_id, transaction_date, transaction_month FROM silver""")
def q_silver_month(spark, sf_dir):
    return silver_frame(spark, sf_dir).select("transaction_id", "transaction_date",
                                              "transaction_month")


def _load_all() -> None:
    # table/pipeline queries register themselves on import
    from tidemark.plans import queries_incremental, queries_tables  # noqa: F401


def oracle_sql() -> dict:
    _load_all()
    return dict(ORACLES)


def queries() -> dict:
    _load_all()
    return dict(QUERIES)
