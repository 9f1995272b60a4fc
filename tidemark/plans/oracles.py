"""DuckDB SQL for the independent oracle of every registered query.

The oracle restates each query from the raw driver tables in plain SQL
(CTEs over ``lineitem``, ``orders``, ``supplier``, ...). It shares no
DataFrame code with the Spark side; only the fixed parameters (fault rules,
thresholds, dates) are the same values.
"""

from __future__ import annotations

from tidemark.functions.exprs import CHURN_BANDS, DEFAULT_TIERS, TIER_ORDER
from tidemark.sources.adapters import (CHANNEL_BY_PRIORITY, FAULT_NEGATIVE_AMOUNT,
                                       FAULT_NULL_AMOUNT, FAULT_NULL_MEMBER,
                                       UPSTREAM_TIER_BY_TOTAL)


def units(num: str, den: str, scale: int = 100) -> str:
    """Exact half-away-from-zero round(num/den*scale) on integers (DuckDB)."""
    n = f"(CAST(({num}) AS BIGINT) * {scale})"
    d = f"CAST(({den}) AS BIGINT)"
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE "
            f"CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END"
            f" * ((2 * abs({n}) + abs({d})) // (2 * abs({d}))) END)")


def rounded(num: str, den: str, scale: int = 100) -> str:
    return f"(CAST({units(num, den, scale)} AS DOUBLE) / {float(scale)})"


def date_lit(d) -> str:
    return f"DATE '{d}'"


def _case(col: str, pairs, cmp: str, other: str | None) -> str:
    parts = " ".join(f"WHEN {col} {cmp} {v!r} THEN '{k}'" if cmp != "=" else
                     f"WHEN {col} = '{k}' THEN '{v}'" for k, v in pairs)
    tail = f" ELSE '{other}'" if other else ""
    return f"CASE {parts}{tail} END"


def tier_case(expr: str, tiers=DEFAULT_TIERS) -> str:
    return _case(expr, tiers, ">=", "bronze")


def tier_rank_case(expr: str) -> str:
    return "CASE " + " ".join(f"WHEN {expr} = '{t}' THEN {i}"
                              for i, t in enumerate(TIER_ORDER, 1)) + " END"


def churn_case(expr: str) -> str:
    return _case(expr, CHURN_BANDS, ">", "active")


def landing_cte(faults: bool = True) -> str:
    amount = "CAST(l.l_extendedprice AS DECIMAL(10,2))"
    member = "'MBR' || CAST(o.o_custkey AS VARCHAR)"
    if faults:
        k1, m1 = FAULT_NULL_MEMBER
        k2, m2 = FAULT_NULL_AMOUNT
        k3, m3 = FAULT_NEGATIVE_AMOUNT
        member = f"CASE WHEN l.{k1} % {m1} = 0 THEN NULL ELSE {member} END"
        amount = (f"CASE WHEN l.{k2} % {m2} = 0 THEN NULL WHEN l.{k3} % {m3} = 0 "
                  f"THEN -{amount} ELSE {amount} END")
    channel = _case("o.o_orderpriority", CHANNEL_BY_PRIORITY, "=", None)
    utier = _case("o.o_totalprice", UPSTREAM_TIER_BY_TOTAL, ">=", "bronze")
    return f"""landing AS (
  SELECT 'TXN_' || CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_linenumber AS VARCHAR)
           AS transaction_id,
         {member} AS member_id,
         CAST(l.l_shipdate AS DATE) AS transaction_date,
         {amount} AS amount,
         CAST(l.l_quantity AS INTEGER) * 10 AS points_earned,
         {channel} AS channel,
         'STR' || CAST(l.l_suppkey AS VARCHAR) AS store_id,
         {utier} AS tier,
         CAST(l.l_quantity AS INTEGER) * l.l_linenumber AS redemption_points,
         CAST(year(l.l_shipdate) * 100 + month(l.l_shipdate) AS INTEGER) AS batch_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


CLEAN_PRED = ("COALESCE(amount > 0, FALSE) AND member_id IS NOT NULL "
              "AND transaction_date IS NOT NULL")

INGEST_ORDER = ", ".join(f"{c} DESC NULLS LAST" for c in (
    "batch_id", "transaction_date", "amount", "points_earned", "redemption_points",
    "store_id", "member_id", "channel", "tier"))


def silver_ctes(faults: bool = True, src: str = "landing") -> str:
    """landing -> clean -> silver (latest per transaction_id, with month)."""
    return f"""{landing_cte(faults)},
clean AS (SELECT * FROM {src} WHERE {CLEAN_PRED}),
silver AS (
  SELECT * EXCLUDE (rn), strftime(transaction_date, '%Y-%m') AS transaction_month
  FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {INGEST_ORDER}) AS rn
        FROM clean)
  WHERE rn = 1)"""


def gold_cte(name: str, src: str, as_of, tiers) -> str:
    """Member summary of ``src`` as CTEs ``<name>_pref`` and ``<name>``."""
    return f"""{name}_pref AS (
  SELECT member_id, channel AS preferred_channel FROM (
    SELECT member_id, channel,
           row_number() OVER (PARTITION BY member_id ORDER BY COUNT(*) DESC, channel ASC) AS rn
    FROM {src} WHERE channel IS NOT NULL GROUP BY member_id, channel)
  WHERE rn = 1),
{name}_agg AS (
  SELECT member_id,
         COUNT(*) AS total_transactions,
         SUM(amount) AS lifetime_spend,
         MAX(transaction_date) AS last_active_date,
         MIN(transaction_date) AS first_date,
         CAST(SUM(points_earned) AS BIGINT) AS total_points_earned,
         CAST(SUM(redemption_points) AS BIGINT) AS total_points_redeemed,
         SUM(CAST(amount * 100 AS BIGINT)) AS cents
  FROM {src} GROUP BY member_id),
{name} AS (
  SELECT a.member_id, total_transactions, lifetime_spend, last_active_date,
         total_points_earned, total_points_redeemed,
         {rounded('100 * (total_points_earned - total_points_redeemed)', 'total_points_earned')}
           AS reward_breakage_rate,
         {tier_case('lifetime_spend', tiers)} AS current_tier,
         {rounded('cents * 365', "datediff('day', first_date, last_active_date) * 100")}
           AS annual_ltv,
         CAST(datediff('day', last_active_date, {date_lit(as_of)}) AS INTEGER)
           AS days_since_last_txn,
         {rounded('cents', 'total_transactions * 100')} AS avg_transaction_value,
         p.preferred_channel
  FROM {name}_agg a LEFT JOIN {name}_pref p ON a.member_id = p.member_id)"""


GOLD_COLUMNS_SQL = ("member_id, total_transactions, CAST(lifetime_spend AS DOUBLE) AS lifetime_spend, "
                    "last_active_date, total_points_earned, total_points_redeemed, "
                    "reward_breakage_rate, current_tier, CAST(annual_ltv AS DOUBLE) AS annual_ltv, "
                    "days_since_last_txn, CAST(avg_transaction_value AS DOUBLE) AS avg_transaction_value, "
                    "preferred_channel")


def dedup_cte(name: str, where: str = "TRUE") -> str:
    """Latest clean row per transaction among rows matching ``where``."""
    return f"""{name} AS (
  SELECT * EXCLUDE (rn), strftime(transaction_date, '%Y-%m') AS transaction_month
  FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {INGEST_ORDER}) AS rn
        FROM clean WHERE {where})
  WHERE rn = 1)"""


SILVER_COLUMNS_SQL = ("transaction_id, member_id, transaction_date, CAST(amount AS DOUBLE) AS amount, "
                      "points_earned, channel, store_id, tier, redemption_points, batch_id")
