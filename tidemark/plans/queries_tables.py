"""Registered queries over the pipeline's tables and the table operators.

Queries here read tables the three-run scenario wrote (``scenario.py``) or
apply merge / change-capture / reconcile operators to frames derived from
the driver's tables. The oracle SQL restates each result from the raw
tables: Silver after a run is "latest clean row per transaction among the
landing batches ingested so far".
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.dates import filter_dates, next_batch_date, scan_share
from tidemark.functions.exprs import TIER_ORDER, month_of
from tidemark.operators.dedup import TRANSACTION_TIEBREAK, ingest_order, latest_per_key
from tidemark.operators.enrich import enrich
from tidemark.operators.merge import CHANGE_TYPE, capture_changes, upsert
from tidemark.operators.quality import (default_suite, duplicate_keys, expectation_report,
                                        sample_by_key, split_rules)
from tidemark.operators.schema import reconcile_schema
from tidemark.operators.scd2 import tier_as_of, tier_changes
from tidemark.operators.summary import affected_keys
from tidemark.plans import analytics as an
from tidemark.plans import oracles as o
from tidemark.plans import pipeline as pl
from tidemark.plans.queries import TIERS, comparable, register
from tidemark.plans.scenario import RUNS, scenario
from tidemark.session import new_work_dir
from tidemark.sources.adapters import landing_transactions, store_dim
from tidemark.sources.tables import TableStore
from tidemark.streaming.silver_stream import stream_silver

# ---- scenario cut-offs (fixed, from scenario.RUNS) ---------------------------
(A_DATE, A_UPTO, _), (B_DATE, B_UPTO, _), (C_DATE, C_UPTO, _) = RUNS
# An old month delivered with the last run only, and a known month delivered twice.
LATE_MONTH, REPEATED_MONTH = 199706, 199803
RANGE_START, RANGE_END = dt.date(1998, 1, 1), dt.date(1998, 6, 30)
LOOKUP_DATE = dt.date(1999, 6, 30)
# ------------------------------------------------------------------------------

LANDING_COLS = ("transaction_id", "member_id", "transaction_date", "amount", "points_earned",
                "channel", "store_id", "tier", "redemption_points", "batch_id")
SILVER_OUT = LANDING_COLS + ("transaction_month",)


def _clean(spark, sf_dir):
    return split_rules(landing_transactions(spark, sf_dir))[0]


def silver_between(spark, sf_dir, lo=None, hi=None):
    """Latest clean row per transaction among landing batches in (lo, hi]."""
    c = _clean(spark, sf_dir)
    if lo is not None:
        c = c.where(F.col("batch_id") > lo)
    if hi is not None:
        c = c.where(F.col("batch_id") <= hi)
    return (latest_per_key(c, "transaction_id", ingest_order(c))
            .withColumn("transaction_month", month_of(F.col("transaction_date"))))


def _sel(df, cols=SILVER_OUT):
    return comparable(df.select(*cols))


BASE = f"""{o.landing_cte()},
clean AS (SELECT * FROM landing WHERE {o.CLEAN_PRED}),
{o.dedup_cte('silver_a', f'batch_id <= {A_UPTO}')},
{o.dedup_cte('silver_b', f'batch_id <= {B_UPTO}')},
{o.dedup_cte('silver', 'TRUE')},
{o.dedup_cte('run2', f'batch_id > {A_UPTO} AND batch_id <= {B_UPTO}')},
{o.dedup_cte('run3', f'batch_id > {B_UPTO}')}"""
GOLDS = f"""{o.gold_cte('gold_a', 'silver_a', A_DATE, TIERS)},
{o.gold_cte('gold_b', 'silver_b', B_DATE, TIERS)},
{o.gold_cte('gold_c', 'silver', C_DATE, TIERS)}"""
HIST = f"""snap AS (
  SELECT member_id, current_tier, {o.date_lit(A_DATE)} AS d FROM gold_a
  UNION ALL SELECT member_id, current_tier, {o.date_lit(B_DATE)} FROM gold_b
  UNION ALL SELECT member_id, current_tier, {o.date_lit(C_DATE)} FROM gold_c),
lagged AS (SELECT *, LAG(current_tier) OVER (PARTITION BY member_id ORDER BY d) AS prev FROM snap),
starts AS (SELECT member_id, current_tier, d AS effective_date FROM lagged
           WHERE prev IS NULL OR prev <> current_tier),
hist AS (
  SELECT member_id, current_tier, effective_date,
         COALESCE(LEAD(effective_date) OVER w - 1, DATE '9999-12-31') AS expiry_date,
         LEAD(effective_date) OVER w IS NULL AS is_current
  FROM starts WINDOW w AS (PARTITION BY member_id ORDER BY effective_date))"""
SEL_SILVER = o.SILVER_COLUMNS_SQL + ", transaction_month"
SEL_LANDING = o.SILVER_COLUMNS_SQL


# ---- scans and sinks ----------------------------------------------------------

@register("scan_full", f"WITH {o.landing_cte()} SELECT {SEL_LANDING} FROM landing")
def q_scan_full(spark, sf_dir):
    return _sel(scenario(spark, sf_dir).read_table(pl.LANDING), LANDING_COLS)


@register("bronze_append", f"""WITH {o.landing_cte()}
SELECT {SEL_LANDING},
       CASE WHEN batch_id <= {A_UPTO} THEN 1 WHEN batch_id <= {B_UPTO} THEN 2 ELSE 3 END AS load_id
FROM landing""")
def q_bronze_append(spark, sf_dir):
    return _sel(scenario(spark, sf_dir).read_table(pl.BRONZE), LANDING_COLS + ("load_id",))


@register("rerun_date_scan", f"""WITH {o.landing_cte()}
SELECT {SEL_LANDING} FROM landing WHERE transaction_date = {o.date_lit(RANGE_END)}""")
def q_rerun_date_scan(spark, sf_dir):
    return _sel(pl.bronze_day(scenario(spark, sf_dir), RANGE_END), LANDING_COLS)


@register("silver_initial", f"WITH {BASE} SELECT {SEL_SILVER} FROM silver_a")
def q_silver_initial(spark, sf_dir):
    return _sel(scenario(spark, sf_dir).read_table(pl.SILVER, version=1))


@register("silver_pipeline", f"WITH {BASE} SELECT {SEL_SILVER} FROM silver")
def q_silver_pipeline(spark, sf_dir):
    return _sel(scenario(spark, sf_dir).read_table(pl.SILVER))


@register("quarantine_table", f"""WITH {o.landing_cte()}
SELECT transaction_id, member_id, transaction_date, CAST(amount AS DOUBLE) AS amount, batch_id,
       'failed_dq_check' AS quarantine_reason
FROM landing WHERE NOT ({o.CLEAN_PRED})""")
def q_quarantine_table(spark, sf_dir):
    q = scenario(spark, sf_dir).read_table(pl.QUARANTINE)
    return comparable(q.select("transaction_id", "member_id", "transaction_date", "amount",
                               "batch_id", "quarantine_reason"))


@register("next_batch_date", f"""WITH {o.landing_cte()}
SELECT MAX(transaction_date) + 1 AS next_batch_date FROM landing""")
def q_next_batch_date(spark, sf_dir):
    return next_batch_date(scenario(spark, sf_dir).read_table(pl.BRONZE), "transaction_date")


@register("store_dim", """SELECT 'STR' || CAST(s.s_suppkey AS VARCHAR) AS store_id,
       s.s_name AS store_name, n.n_name AS state, r.r_name AS region
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_store_dim(spark, sf_dir):
    return store_dim(spark, sf_dir)


@register("enrich_store", f"""WITH {BASE},
dim AS (SELECT 'STR' || CAST(s.s_suppkey AS VARCHAR) AS store_id, s.s_name AS store_name,
               n.n_name AS state, r.r_name AS region
        FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
        LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT s.transaction_id, s.member_id, CAST(s.amount AS DOUBLE) AS amount, s.store_id,
       d.store_name, d.state, d.region
FROM silver s LEFT JOIN dim d ON s.store_id = d.store_id""")
def q_enrich_store(spark, sf_dir):
    silver = scenario(spark, sf_dir).read_table(pl.SILVER)
    e = enrich(silver.select("transaction_id", "member_id", "amount", "store_id"),
               store_dim(spark, sf_dir), "store_id")
    return comparable(e.select("transaction_id", "member_id", "amount", "store_id",
                               "store_name", "state", "region"))


# ---- filters and simple aggregates over Silver -------------------------------

@register("date_range_filter", f"""WITH {BASE}
SELECT {SEL_SILVER} FROM silver
WHERE transaction_date BETWEEN {o.date_lit(RANGE_START)} AND {o.date_lit(RANGE_END)}""")
def q_date_range_filter(spark, sf_dir):
    silver = scenario(spark, sf_dir).read_table(pl.SILVER)
    return _sel(filter_dates(silver, RANGE_START, RANGE_END))


@register("rows_per_month", f"""WITH {BASE}
SELECT transaction_month, COUNT(*) AS row_count FROM silver GROUP BY transaction_month""")
def q_rows_per_month(spark, sf_dir):
    silver = scenario(spark, sf_dir).read_table(pl.SILVER)
    return silver.groupBy("transaction_month").agg(F.count(F.lit(1)).alias("row_count"))


@register("scan_share", f"""WITH {BASE}
SELECT COUNT(*) AS total_rows,
       CAST(COUNT_IF(transaction_date BETWEEN {o.date_lit(RANGE_START)} AND {o.date_lit(RANGE_END)})
         AS BIGINT) AS filtered_rows,
       {o.rounded(f"COUNT_IF(transaction_date BETWEEN {o.date_lit(RANGE_START)} AND "
                  f"{o.date_lit(RANGE_END)}) * 100", "COUNT(*)")} AS pct_scanned
FROM silver""")
def q_scan_share(spark, sf_dir):
    return scan_share(scenario(spark, sf_dir).read_table(pl.SILVER), RANGE_START, RANGE_END)


@register("dq_duplicate_keys", f"""WITH {o.landing_cte()}
SELECT transaction_id, COUNT(*) AS count FROM landing WHERE {o.CLEAN_PRED}
GROUP BY transaction_id HAVING COUNT(*) > 1""")
def q_dq_duplicate_keys(spark, sf_dir):
    return duplicate_keys(_clean(spark, sf_dir), "transaction_id")


def _report_sql(src: str) -> str:
    def row(name, col, sev, n, u, ok):
        colv = f"'{col}'" if col else "CAST(NULL AS VARCHAR)"
        return (f"SELECT '{name}' AS expectation, {colv} AS column_name, '{sev}' AS severity, "
                f"CAST({n} AS BIGINT) AS element_count, CAST({u} AS BIGINT) AS unexpected_count, "
                f"{o.rounded(f'{u} * 100', n, 10000)} AS unexpected_pct, {ok} AS success FROM {src}")
    full = lambda n, u: f"({u}) = 0"
    rows = [
        row("not_null_transaction_id", "transaction_id", "critical", "COUNT(*)",
            "COUNT_IF(transaction_id IS NULL)", full("COUNT(*)", "COUNT_IF(transaction_id IS NULL)")),
        row("not_null_member_id", "member_id", "critical", "COUNT(*)",
            "COUNT_IF(member_id IS NULL)", full(0, "COUNT_IF(member_id IS NULL)")),
        row("not_null_transaction_date", "transaction_date", "critical", "COUNT(*)",
            "COUNT_IF(transaction_date IS NULL)", full(0, "COUNT_IF(transaction_date IS NULL)")),
        row("amount_min", "amount", "critical", "COUNT(amount)", "COUNT_IF(amount < 0.01)",
            full(0, "COUNT_IF(amount < 0.01)")),
        row("channel_in_set", "channel", "critical", "COUNT(channel)",
            "COUNT_IF(NOT channel IN ('POS', 'mobile_app', 'partner_api'))",
            full(0, "COUNT_IF(NOT channel IN ('POS', 'mobile_app', 'partner_api'))")),
        row("tier_in_set", "tier", "critical", "COUNT(tier)",
            "COUNT_IF(NOT tier IN ('bronze', 'silver', 'gold', 'platinum'))",
            full(0, "COUNT_IF(NOT tier IN ('bronze', 'silver', 'gold', 'platinum'))")),
        row("amount_typical_range", "amount", "warning", "COUNT(amount)",
            "COUNT_IF(amount < 5.0 OR amount > 2000.0)",
            "(COUNT(amount) - COUNT_IF(amount < 5.0 OR amount > 2000.0)) * 10000 "
            ">= COUNT(amount) * 9900"),
        row("row_count_min", None, "warning", "COUNT(*)", "0", "COUNT(*) >= 100"),
    ]
    uniq = (f"SELECT 'unique_transaction_id' AS expectation, 'transaction_id' AS column_name, "
            f"'critical' AS severity, CAST(SUM(n) AS BIGINT) AS element_count, "
            f"CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS unexpected_count, "
            f"{o.rounded('COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) * 100', 'SUM(n)', 10000)} "
            f"AS unexpected_pct, COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) = 0 AS success "
            f"FROM (SELECT transaction_id, COUNT(*) AS n FROM {src} "
            f"WHERE transaction_id IS NOT NULL GROUP BY transaction_id)")
    return "\nUNION ALL ".join(rows + [uniq])


@register("dq_report", f"WITH {o.landing_cte()}\n{_report_sql('landing')}")
def q_dq_report(spark, sf_dir):
    return expectation_report(landing_transactions(spark, sf_dir), default_suite())


@register("dq_gate", f"WITH {BASE}\nSELECT *, 3 AS silver_version FROM ({_report_sql('silver')})")
def q_dq_gate(spark, sf_dir):
    """The published gate report of the last run: every rule over all of Silver."""
    return scenario(spark, sf_dir).read_table(pl.GATE)


@register("dq_sample", f"""WITH {BASE}
SELECT {SEL_SILVER} FROM silver
WHERE substr(md5('42:' || transaction_id), 1, 8)
      < lpad(printf('%x', least(42949672, CAST(floor(500000 * 4294967296 / (SELECT COUNT(*) FROM silver)) AS BIGINT))), 8, '0')""")
def q_dq_sample(spark, sf_dir):
    """Seeded sample of Silver for inspection, by key."""
    return _sel(sample_by_key(scenario(spark, sf_dir).read_table(pl.SILVER), "transaction_id"))


# ---- reconcile ------------------------------------------------------------------

def _target_schema(spark, sf_dir):
    return landing_transactions(spark, sf_dir).schema


@register("reconcile_new", f"""WITH {o.landing_cte()}
SELECT {SEL_LANDING}, CAST(redemption_points AS DOUBLE) / points_earned AS loyalty_multiplier
FROM landing""")
def q_reconcile_new(spark, sf_dir):
    land = landing_transactions(spark, sf_dir)
    batch = land.withColumn("loyalty_multiplier",
                            F.col("redemption_points") / F.col("points_earned"))
    good, _ = reconcile_schema(batch, land.schema)
    return _sel(good, LANDING_COLS + ("loyalty_multiplier",))


@register("reconcile_missing", f"""WITH {o.landing_cte()}
SELECT {SEL_LANDING.replace('channel,', 'CAST(NULL AS VARCHAR) AS channel,')} FROM landing""")
def q_reconcile_missing(spark, sf_dir):
    land = landing_transactions(spark, sf_dir)
    good, _ = reconcile_schema(land.drop("channel"), land.schema)
    return _sel(good, LANDING_COLS)


def _drifted(spark, sf_dir):
    """points_earned arrives as text; some values are not numbers."""
    land = landing_transactions(spark, sf_dir)
    txt = F.when(F.col("redemption_points") % 7 == 0, F.lit("n/a")).otherwise(
        F.col("points_earned").cast("string"))
    return land, land.withColumn("points_earned", txt)


@register("reconcile_cast_ok", f"""WITH {o.landing_cte()}
SELECT {SEL_LANDING} FROM landing WHERE redemption_points % 7 <> 0""")
def q_reconcile_cast_ok(spark, sf_dir):
    land, drifted = _drifted(spark, sf_dir)
    good, _ = reconcile_schema(drifted, land.schema)
    return _sel(good, LANDING_COLS)


@register("reconcile_cast_bad", f"""WITH {o.landing_cte()}
SELECT transaction_id, member_id, batch_id, 'cast_failed_points_earned' AS quarantine_reason
FROM landing WHERE redemption_points % 7 = 0""")
def q_reconcile_cast_bad(spark, sf_dir):
    land, drifted = _drifted(spark, sf_dir)
    _, bad = reconcile_schema(drifted, land.schema)
    return bad.select("transaction_id", "member_id", "batch_id", "quarantine_reason")


# ---- merge and change capture -----------------------------------------------

@register("merge_upsert", f"WITH {BASE} SELECT {SEL_SILVER} FROM silver")
def q_merge_upsert(spark, sf_dir):
    target = silver_between(spark, sf_dir, None, B_UPTO)
    source = silver_between(spark, sf_dir, B_UPTO, None)
    return _sel(upsert(target, source, ["transaction_id"]))


@register("merge_late_arrivals", f"WITH {BASE} SELECT {SEL_SILVER} FROM silver")
def q_merge_late_arrivals(spark, sf_dir):
    target = silver_between(spark, sf_dir)
    late = silver_between(spark, sf_dir, None, A_UPTO)      # older copies arrive again
    return _sel(upsert(target, late, ["transaction_id"],
                       version_cols=("batch_id",) + TRANSACTION_TIEBREAK))


@register("merge_evolving", f"""WITH {BASE}
SELECT {SEL_SILVER}, CASE WHEN batch_id > {B_UPTO}
       THEN CAST(redemption_points AS DOUBLE) / points_earned END AS loyalty_multiplier
FROM silver""")
def q_merge_evolving(spark, sf_dir):
    target = silver_between(spark, sf_dir, None, B_UPTO)
    source = silver_between(spark, sf_dir, B_UPTO, None).withColumn(
        "loyalty_multiplier", F.col("redemption_points") / F.col("points_earned"))
    return _sel(upsert(target, source, ["transaction_id"]), SILVER_OUT + ("loyalty_multiplier",))


@register("change_capture", f"""WITH {BASE}
SELECT {SEL_SILVER}, 'update_preimage' AS _change_type FROM silver_b
 WHERE transaction_id IN (SELECT transaction_id FROM run3)
UNION ALL
SELECT {SEL_SILVER}, 'update_postimage' FROM silver
 WHERE transaction_id IN (SELECT transaction_id FROM run3)
   AND transaction_id IN (SELECT transaction_id FROM silver_b)
UNION ALL
SELECT {SEL_SILVER}, 'insert' FROM silver
 WHERE transaction_id NOT IN (SELECT transaction_id FROM silver_b)""")
def q_change_capture(spark, sf_dir):
    old = silver_between(spark, sf_dir, None, B_UPTO)
    new = silver_between(spark, sf_dir)
    return _sel(capture_changes(old, new, ["transaction_id"]), SILVER_OUT + (CHANGE_TYPE,))


@register("change_feed_inserts", f"""WITH {o.landing_cte()}
SELECT {SEL_LANDING} FROM landing WHERE batch_id > {A_UPTO} AND batch_id <= {B_UPTO}""")
def q_change_feed_inserts(spark, sf_dir):
    feed = scenario(spark, sf_dir).read_changes(pl.BRONZE, 1, 2, ("insert",))
    return _sel(feed, LANDING_COLS)


@register("change_feed_upserts", f"""WITH {BASE}
SELECT {SEL_SILVER},
       CASE WHEN transaction_id IN (SELECT transaction_id FROM silver_b)
            THEN 'update_postimage' ELSE 'insert' END AS _change_type
FROM run3""")
def q_change_feed_upserts(spark, sf_dir):
    feed = scenario(spark, sf_dir).read_changes(pl.SILVER, 2, 3, ("insert", "update_postimage"),
                                                with_meta=True)
    return _sel(feed, SILVER_OUT + (CHANGE_TYPE,))


# ---- gold, affected members ---------------------------------------------------

# Recency is as of a member's last recomputation: the last run that changed it.
RECENT = f"""touched AS (
  SELECT member_id, {o.date_lit(C_DATE)} AS d FROM run3
  UNION ALL SELECT member_id, {o.date_lit(C_DATE)} FROM silver_b
   WHERE transaction_id IN (SELECT transaction_id FROM run3)
  UNION ALL SELECT member_id, {o.date_lit(B_DATE)} FROM run2
  UNION ALL SELECT member_id, {o.date_lit(B_DATE)} FROM silver_a
   WHERE transaction_id IN (SELECT transaction_id FROM run2)),
recomputed AS (SELECT member_id, MAX(d) AS d FROM touched GROUP BY member_id),
published AS (
  SELECT g.* REPLACE (CAST(datediff('day', g.last_active_date, COALESCE(r.d, {o.date_lit(A_DATE)}))
                           AS INTEGER) AS days_since_last_txn)
  FROM gold_c g LEFT JOIN recomputed r ON g.member_id = r.member_id)"""
PUBLISHED_GOLD = f"WITH {BASE},\n{GOLDS},\n{RECENT}\nSELECT {o.GOLD_COLUMNS_SQL} FROM published"


@register("gold_incremental", PUBLISHED_GOLD)
def q_gold_incremental(spark, sf_dir):
    return comparable(scenario(spark, sf_dir).read_table(pl.GOLD))


@register("gold_initial", f"WITH {BASE},\n{GOLDS}\nSELECT {o.GOLD_COLUMNS_SQL} FROM gold_a")
def q_gold_initial(spark, sf_dir):
    """The first (full) Gold version."""
    return comparable(scenario(spark, sf_dir).read_table(pl.GOLD, version=1))


@register("gold_clustered", PUBLISHED_GOLD)
def q_gold_clustered(spark, sf_dir):
    """Gold as written: a folder per tier, range-clustered on member_id inside."""
    return comparable(scenario(spark, sf_dir).read_table(pl.GOLD, partitions=list(TIER_ORDER)))


AFFECTED_SQL = f"""affected AS (
  SELECT DISTINCT member_id FROM (
    SELECT member_id FROM run3
    UNION ALL SELECT member_id FROM silver_b WHERE transaction_id IN (SELECT transaction_id FROM run3)))"""


@register("affected_members", f"WITH {BASE},\n{AFFECTED_SQL}\nSELECT member_id FROM affected")
def q_affected_members(spark, sf_dir):
    store = scenario(spark, sf_dir)
    return affected_keys(store.read_changes(pl.SILVER, 2, 3, pl.ALL_CHANGES))


@register("affected_members_history", f"""WITH {BASE},\n{AFFECTED_SQL}
SELECT {SEL_SILVER} FROM silver WHERE member_id IN (SELECT member_id FROM affected)""")
def q_affected_members_history(spark, sf_dir):
    store = scenario(spark, sf_dir)
    keys = affected_keys(store.read_changes(pl.SILVER, 2, 3, pl.ALL_CHANGES))
    return _sel(store.read_table(pl.SILVER).join(keys, "member_id", "left_semi"))


# ---- tier history -------------------------------------------------------------

@register("scd2_initial", f"""WITH {BASE},\n{GOLDS}
SELECT member_id, current_tier, {o.date_lit(A_DATE)} AS effective_date,
       DATE '9999-12-31' AS expiry_date, TRUE AS is_current FROM gold_a""")
def q_scd2_initial(spark, sf_dir):
    return scenario(spark, sf_dir).read_table(pl.HISTORY, version=1)


@register("scd2_apply", f"WITH {BASE},\n{GOLDS},\n{HIST}\nSELECT * FROM hist")
def q_scd2_apply(spark, sf_dir):
    return scenario(spark, sf_dir).read_table(pl.HISTORY)


@register("scd2_changes", f"""WITH {BASE},\n{GOLDS}
SELECT c.member_id, c.current_tier AS new_tier, b.current_tier AS old_tier,
       CASE WHEN b.member_id IS NULL THEN NULL
            WHEN a.member_id IS NULL OR a.current_tier <> b.current_tier THEN {o.date_lit(B_DATE)}
            ELSE {o.date_lit(A_DATE)} END AS open_since
FROM gold_c c LEFT JOIN gold_b b ON c.member_id = b.member_id
LEFT JOIN gold_a a ON c.member_id = a.member_id
WHERE b.member_id IS NULL OR b.current_tier <> c.current_tier""")
def q_scd2_changes(spark, sf_dir):
    store = scenario(spark, sf_dir)
    return tier_changes(store.read_table(pl.GOLD, version=3),
                        store.read_table(pl.HISTORY, version=2))


@register("tier_as_of", f"""WITH {BASE},\n{GOLDS},\n{HIST}
SELECT member_id, current_tier FROM hist
WHERE effective_date <= {o.date_lit(LOOKUP_DATE)} AND expiry_date >= {o.date_lit(LOOKUP_DATE)}""")
def q_tier_as_of(spark, sf_dir):
    return tier_as_of(scenario(spark, sf_dir).read_table(pl.HISTORY), LOOKUP_DATE)


@register("tier_velocity", f"""WITH {BASE},\n{GOLDS},\n{HIST}
SELECT h1.member_id, h1.current_tier AS from_tier, h2.current_tier AS to_tier,
       h1.effective_date AS downgraded_or_upgraded_on, h2.effective_date AS changed_on,
       CAST(datediff('day', h1.effective_date, h2.effective_date) AS INTEGER) AS days_in_previous_tier
FROM hist h1 JOIN hist h2 ON h1.member_id = h2.member_id
 AND h2.effective_date = h1.expiry_date + 1
WHERE h1.current_tier <> h2.current_tier""")
def q_tier_velocity(spark, sf_dir):
    return an.tier_velocity(scenario(spark, sf_dir).read_table(pl.HISTORY))


# ---- control table and run history -------------------------------------------

MAX_BATCH = "(SELECT MAX(year(l_shipdate) * 100 + month(l_shipdate)) FROM lineitem)"


@register("job_version_get", f"""
SELECT 'bronze_ingestion' AS job_name, CAST(3 AS BIGINT) AS last_processed_version
UNION ALL SELECT 'silver_transactions', CAST(3 AS BIGINT)
UNION ALL SELECT 'dq_gate', CAST(3 AS BIGINT)
UNION ALL SELECT 'member_month_rollup', CAST(3 AS BIGINT)
UNION ALL SELECT 'gold_member_summary', CAST(3 AS BIGINT)
UNION ALL SELECT 'member_tier_history', CAST(3 AS BIGINT)""")
def q_job_version_get(spark, sf_dir):
    store = scenario(spark, sf_dir)
    return store.read_table("job_versions").select("job_name", "last_processed_version")


@register("table_version", f"""
SELECT 'landing' AS table_name, CAST(3 AS BIGINT) AS version
UNION ALL SELECT 'bronze', CAST(3 AS BIGINT)
UNION ALL SELECT 'silver', CAST(3 AS BIGINT)
UNION ALL SELECT 'gold_member_summary', CAST(3 AS BIGINT)
UNION ALL SELECT 'member_tier_history', CAST(3 AS BIGINT)""")
def q_table_version(spark, sf_dir):
    store = scenario(spark, sf_dir)
    names = [pl.LANDING, pl.BRONZE, pl.SILVER, pl.GOLD, pl.HISTORY]
    return (store.log().where(F.col("table_name").isin(names))
                 .groupBy("table_name").agg(F.max("version").alias("version")))


@register("job_version_upsert", f"""
SELECT 'bronze_ingestion' AS job_name, CAST({MAX_BATCH} AS BIGINT) AS last_processed_version""")
def q_job_version_upsert(spark, sf_dir):
    store = TableStore(spark, new_work_dir(spark, "jobversions"))
    batches = (landing_transactions(spark, sf_dir)
               .agg(F.max("batch_id").alias("b"), F.min("batch_id").alias("a")).collect()[0])
    store.save_version("bronze_ingestion", int(batches["a"]))
    store.save_version("bronze_ingestion", int(batches["b"]))     # upsert, same key
    return store.read_table("job_versions")


def _merge_metrics(prev: str, run: str, new: str) -> str:
    touched = (f"(SELECT transaction_month FROM {run} UNION SELECT p.transaction_month FROM {prev} p "
               f"WHERE p.transaction_id IN (SELECT transaction_id FROM {run}))")
    return (f"(SELECT COUNT(*) FROM {new} WHERE transaction_month IN {touched}), "
            f"(SELECT COUNT(*) FROM {run} WHERE transaction_id NOT IN "
            f"(SELECT transaction_id FROM {prev})), "
            f"(SELECT COUNT(*) FROM {run} WHERE transaction_id IN (SELECT transaction_id FROM {prev})), "
            f"CAST(0 AS BIGINT)")


@register("recent_runs", f"""WITH {BASE},
m AS (
  SELECT 1 AS version, 'CREATE' AS operation, (SELECT COUNT(*) FROM silver_a) AS rows_written,
         (SELECT COUNT(*) FROM silver_a) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
         CAST(0 AS BIGINT) AS rows_deleted
  UNION ALL SELECT 2, 'MERGE', {_merge_metrics('silver_a', 'run2', 'silver_b')}
  UNION ALL SELECT 3, 'MERGE', {_merge_metrics('silver_b', 'run3', 'silver')})
SELECT 'silver' AS table_name, CAST(version AS BIGINT) AS version, operation,
       CAST(rows_written AS BIGINT) AS rows_written, CAST(rows_inserted AS BIGINT) AS rows_inserted,
       CAST(rows_updated AS BIGINT) AS rows_updated, CAST(rows_deleted AS BIGINT) AS rows_deleted
FROM m""")
def q_recent_runs(spark, sf_dir):
    return scenario(spark, sf_dir).run_log(pl.SILVER, limit=10).drop("committed_at")


# ---- late and repeated deliveries ----------------------------------------------

DELIVERED = f"""{o.landing_cte()},
delivered AS (
  SELECT *, CASE WHEN batch_id = {LATE_MONTH} THEN 3 WHEN batch_id <= {A_UPTO} THEN 1
                 WHEN batch_id <= {B_UPTO} THEN 2 ELSE 3 END AS load_id FROM landing
  UNION ALL SELECT *, 3 FROM landing WHERE batch_id = {REPEATED_MONTH})"""

_LATE: dict = {}


def late_store(spark, sf_dir) -> TableStore:
    """Three deliveries and runs of Bronze and Silver: an old month comes with the
    last one only, and a month delivered before comes a second time."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _LATE:
        store = TableStore(spark, new_work_dir(spark, "late"))
        landing = landing_transactions(spark, sf_dir)
        late, b = F.col("batch_id") == LATE_MONTH, F.col("batch_id")
        third = landing.where((b > B_UPTO) | late).unionByName(landing.where(b == REPEATED_MONTH))
        for part, (_, _, run_ts) in zip((landing.where((b <= A_UPTO) & ~late),
                                         landing.where((b > A_UPTO) & (b <= B_UPTO)), third), RUNS):
            pl.load_landing(store, part)
            pl.run_bronze(store, run_ts, by_month=True)
            pl.run_silver(store, run_ts)
        _LATE[key] = store
    return _LATE[key]


@register("late_deliveries_bronze", f"WITH {DELIVERED}\nSELECT {SEL_LANDING}, load_id FROM delivered")
def q_late_deliveries_bronze(spark, sf_dir):
    return _sel(late_store(spark, sf_dir).read_table(pl.BRONZE), LANDING_COLS + ("load_id",))


@register("late_deliveries", f"""WITH {DELIVERED}
SELECT {SEL_LANDING}, strftime(transaction_date, '%Y-%m') AS transaction_month
FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY load_id DESC, {o.INGEST_ORDER}) AS rn
      FROM delivered WHERE {o.CLEAN_PRED}) WHERE rn = 1""")
def q_late_deliveries(spark, sf_dir):
    """Silver when deliveries arrive out of order: the latest ingested clean copy wins."""
    return _sel(late_store(spark, sf_dir).read_table(pl.SILVER))


# ---- streaming -------------------------------------------------------------------

@register("stream_silver", f"WITH {BASE} SELECT {SEL_SILVER} FROM silver")
def q_stream_silver(spark, sf_dir):
    """Landing drained through the availableNow stream into its own Silver."""
    store = scenario(spark, sf_dir)
    store.refresh()
    if not store.exists("silver_stream"):
        stream_silver(spark, store, "silver_stream")
    return _sel(store.read_table("silver_stream"))
