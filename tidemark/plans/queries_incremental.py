"""Registered queries whose work follows the change: bucketed merges, Gold by signed deltas, quality
counts per folder, sketches, and the clustering of Gold's files. Each reads the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.exprs import month_of
from tidemark.operators.clustering import clustering_depth
from tidemark.operators.quality import default_suite
from tidemark.operators.sketches import ERROR, monthly_sketches, periods
from tidemark.plans import gold_deltas, quality_states
from tidemark.plans import oracles as o
from tidemark.plans import pipeline as pl
from tidemark.plans.queries import TIERS, comparable, register
from tidemark.plans.queries_tables import (A_UPTO, B_UPTO, BASE, C_DATE, GOLDS, HIST, PUBLISHED_GOLD, SEL_SILVER,
                                           _report_sql, _sel, silver_between)
from tidemark.plans.scenario import RUNS, SCENARIO_CONFIG, delivery, scenario
from tidemark.session import new_work_dir
from tidemark.sources.adapters import landing_transactions
from tidemark.sources.tables import TableStore

MONTH_BUCKETS = 2
#: Rows of a Gold file in ``gold_cluster_depth``, so that a tier has several.
FILE_ROWS = 64


def own_store(spark, label: str) -> TableStore:
    return TableStore(spark, new_work_dir(spark, label))


@register("merge_upsert_bucketed", f"WITH {BASE} SELECT {SEL_SILVER} FROM silver")
def q_merge_upsert_bucketed(spark, sf_dir):
    """Silver in months and key buckets takes the last delivery: (month, bucket) folders are rewritten."""
    store = own_store(spark, "bucketed")
    store.create(silver_between(spark, sf_dir, None, B_UPTO), pl.SILVER, partition_by="transaction_month",
                 bucket_by=["transaction_id"], buckets=MONTH_BUCKETS)
    batch = store.stage(silver_between(spark, sf_dir, B_UPTO, None), "batch")
    store.merge(batch, pl.SILVER, ["transaction_id"], partition_by="transaction_month")
    return _sel(store.read_table(pl.SILVER))


@register("gold_by_deltas", PUBLISHED_GOLD)
def q_gold_by_deltas(spark, sf_dir):
    """Gold after the three runs, the second and third by signed deltas of Silver's feed."""
    silver, store = scenario(spark, sf_dir), own_store(spark, "deltas")
    for (as_of, _, run_ts), version in zip(RUNS, silver.versions(pl.SILVER), strict=True):
        gold_deltas.run_gold_by_deltas(store, as_of, run_ts, SCENARIO_CONFIG, silver=silver, upto=version)
    return comparable(store.read_table(gold_deltas.GOLD))


def landing_in_folders(spark, sf_dir) -> TableStore:
    """Landing's rows, duplicates and all, as three deliveries to one table of months, counted after each."""
    store, landing = own_store(spark, "folder-states"), landing_transactions(spark, sf_dir).withColumn(
        "transaction_month", month_of(F.col("transaction_date")))
    for after, upto in ((None, A_UPTO), (A_UPTO, B_UPTO), (B_UPTO, None)):
        store.publish_partitions(delivery(landing, after, upto), pl.LANDING, "transaction_month")
        quality_states.refresh_states(store, pl.LANDING, default_suite())
    return store


@register("dq_report_states", f"WITH {o.landing_cte()}\n{_report_sql('landing')}")
def q_dq_report_states(spark, sf_dir):
    return quality_states.report(landing_in_folders(spark, sf_dir), pl.LANDING, default_suite())


@register("dq_duplicate_keys_states", f"""WITH {o.landing_cte()}
SELECT transaction_id AS key, COUNT(*) AS count FROM landing GROUP BY transaction_id HAVING COUNT(*) > 1""")
def q_dq_duplicate_keys_states(spark, sf_dir):
    return quality_states.duplicate_keys(landing_in_folders(spark, sf_dir), pl.LANDING)


_PERIOD = "CASE k WHEN 0 THEN transaction_month WHEN 1 THEN left(transaction_month, 4) || '-Q' || CAST(ceil(CAST(right(transaction_month, 2) AS INT) / 3.0) AS INT) ELSE left(transaction_month, 4) END"


def members_of_periods(txns):
    """The exact number of members of each month, quarter and year (period, members). A member's months of a
    year are the bits of one number, so one row per member and year is shuffled, whatever the periods."""
    year, number = F.substring("transaction_month", 1, 4), F.substring("transaction_month", 6, 2).cast("int")
    months = (txns.select("member_id", year.alias("year"), number.alias("number"))
                  .groupBy("member_id", "year").agg(F.bit_or(F.expr("shiftleft(1, number - 1)")).alias("months")))
    def when(bits, name):
        return F.when(F.col("months").bitwiseAND(bits) != 0, F.concat("year", F.lit(name)))
    periods = [F.col("year"), *[when(7 << 3 * q, f"-Q{q + 1}") for q in range(4)], *[when(1 << m, f"-{m + 1:02d}") for m in range(12)]]
    return (months.select("member_id", F.explode(F.array(*periods)).alias("period")).where(F.col("period").isNotNull())
                  .groupBy("period").agg(F.count("member_id").alias("members")))


@register("active_members_sketch", f"""WITH {BASE}
SELECT {_PERIOD} AS period, COUNT(DISTINCT member_id) AS members, TRUE AS within_error
FROM silver, (SELECT unnest([0, 1, 2]) AS k) GROUP BY 1""")
def q_active_members_sketch(spark, sf_dir):
    """Members of months, quarters and years from stored sketches of months, next to the exact numbers:
    whether the estimate is within its stated error."""
    store, silver = own_store(spark, "sketches"), scenario(spark, sf_dir).read_table(pl.SILVER)
    store.create(monthly_sketches(silver), "member_sketches")
    exact = members_of_periods(silver)
    near = F.abs(F.col("estimate") - F.col("members")) <= F.greatest(F.lit(1.0), ERROR * F.col("members"))
    return exact.join(periods(store.read_table("member_sketches")), "period", "left").select("period", "members", near.alias("within_error"))


@register("gold_cluster_depth", f"""WITH {BASE},\n{o.gold_cte('gold_c', 'silver', C_DATE, TIERS)}
SELECT current_tier, COUNT(*) AS n_rows, CAST(ceil(COUNT(*) / {FILE_ROWS}.0) AS BIGINT) <= 1 AS one_file, 1 AS depth FROM gold_c GROUP BY current_tier""")
def q_gold_cluster_depth(spark, sf_dir):
    """Gold in small files, a folder per tier, range-clustered on member_id inside: how many files can
    hold one member. Without clustering the ranges of a tier's files overlap and the depth is their number."""
    store, gold = own_store(spark, "clustered"), scenario(spark, sf_dir).read_table(pl.GOLD)
    store.create(gold, pl.GOLD, partition_by=pl.GOLD_PARTITION, cluster_by=["member_id"], rows_per_file=FILE_ROWS)
    found = clustering_depth(store.read_table(pl.GOLD), pl.GOLD_PARTITION, "member_id")
    return found.select(pl.GOLD_PARTITION, "n_rows", (F.col("n_files") <= 1).alias("one_file"), F.col("depth").cast("int").alias("depth"))


TIERS_SQL = """
SELECT s.transaction_month, g.current_tier, COUNT(*) AS transactions, COUNT(DISTINCT s.member_id) AS members
FROM silver_transactions s JOIN gold_member_summary g ON s.member_id = g.member_id
GROUP BY s.transaction_month, g.current_tier"""


@register("sql_over_views", f"""WITH {BASE},\n{o.gold_cte('gold_c', 'silver', C_DATE, TIERS)},
silver_transactions AS (SELECT * FROM silver), gold_member_summary AS (SELECT * FROM gold_c)
{TIERS_SQL}""")
def q_sql_over_views(spark, sf_dir):
    """An analyst's SQL text over temp views of the published Silver and Gold."""
    scenario(spark, sf_dir).register_views(pl.SQL_VIEWS)
    return spark.sql(TIERS_SQL)


@register("pipeline_chain", f"""WITH {BASE},\n{GOLDS},\n{HIST}
SELECT 'landing' AS stage, COUNT(*) AS n_rows, COUNT(DISTINCT transaction_id) AS n_keys FROM landing
UNION ALL SELECT 'bronze', COUNT(*), COUNT(DISTINCT transaction_id) FROM landing
UNION ALL SELECT 'silver', COUNT(*), COUNT(DISTINCT transaction_id) FROM silver
UNION ALL SELECT 'silver_quarantine', COUNT(*), COUNT(DISTINCT transaction_id) FROM landing WHERE NOT ({o.CLEAN_PRED})
UNION ALL SELECT 'dq_report', 9, 9
UNION ALL SELECT 'gold_member_summary', COUNT(*), COUNT(DISTINCT member_id) FROM gold_c
UNION ALL SELECT 'member_tier_history', COUNT(*), COUNT(DISTINCT member_id) FROM hist""")
def q_pipeline_chain(spark, sf_dir):
    """What each of the chained stages has published after three runs: rows and different keys."""
    store, out = scenario(spark, sf_dir), None
    for table, key in ((pl.LANDING, "transaction_id"), (pl.BRONZE, "transaction_id"), (pl.SILVER, "transaction_id"),
                       (pl.QUARANTINE, "transaction_id"), (pl.GATE, "expectation"), (pl.GOLD, "member_id"), (pl.HISTORY, "member_id")):
        one = store.read_table(table).agg(F.lit(table).alias("stage"), F.count("*").alias("n_rows"), F.countDistinct(key).alias("n_keys"))
        out = one if out is None else out.unionByName(one)
    return out
