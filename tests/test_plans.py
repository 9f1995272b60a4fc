"""Physical-plan assertions: pruning, pushdown, join strategy, partial work."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tidemark.functions.dates import filter_dates
from tidemark.operators.dedup import ingest_order, latest_per_key
from tidemark.operators.merge import upsert_with_changes
from tidemark.operators.summary import member_summary


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()          # final AQE plan
    return df._jdf.queryExecution().executedPlan().toString()


def _silver_table(spark, store):
    rows_ = [(f"T{i}", f"M{i % 7}", dt.date(2024, 1 + i % 6, 1 + i % 27), Decimal("10.00") + i,
              10, "POS", "S1", "gold", 1, 202401 + i % 6) for i in range(300)]
    df = spark.createDataFrame(rows_, "transaction_id string, member_id string, "
                               "transaction_date date, amount decimal(10,2), points_earned int, "
                               "channel string, store_id string, tier string, "
                               "redemption_points int, batch_id int")
    df = df.withColumn("transaction_month", F.date_format("transaction_date", "yyyy-MM"))
    store.create(df, "silver", partition_by="transaction_month")
    return store.read_table("silver")


def test_date_filter_prunes_month_partitions_and_pushes_date(spark, store):
    silver = _silver_table(spark, store)
    q = filter_dates(silver, "2024-02-01", "2024-03-31")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_month" in plan
    assert "transaction_month#" in plan and "2024-02" in plan
    assert "PushedFilters: [IsNotNull(transaction_date), GreaterThanOrEqual(transaction_date" in plan
    # a filter on the date alone cannot prune folders
    plain = silver.where(F.col("transaction_date") >= F.lit("2024-02-01").cast("date"))
    assert "PartitionFilters: []" in plain._jdf.queryExecution().executedPlan().toString()
    assert rows(q, "transaction_id") == rows(
        silver.where("transaction_date between '2024-02-01' and '2024-03-31'"), "transaction_id")


def test_summary_reads_only_needed_columns_and_aggregates_partially(spark, store):
    silver = _silver_table(spark, store)
    plan = _plan(member_summary(silver, dt.date(2024, 12, 31)))
    read = plan[plan.index("ReadSchema:"):].split("\n")[0]
    assert "store_id" not in read and "tier" not in read and "batch_id" not in read
    assert plan.count("HashAggregate") + plan.count("ObjectHashAggregate") >= 2   # partial + final


def test_merge_never_shuffles_the_target(spark, store):
    silver = _silver_table(spark, store)
    source = silver.limit(20).withColumn("amount", F.col("amount") + 1)
    source = store.stage(source, "src")
    result, changes = upsert_with_changes(silver, source, ["transaction_id"])
    plan = _plan(result)
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    scan_side = plan[plan.index("LeftAnti"):]
    # the target scan feeds the anti join directly (no Exchange in between)
    first_scan = scan_side.index("FileScan parquet")
    assert "Exchange hashpartitioning" not in scan_side[:first_scan]
    assert changes.where("_change_type = 'update_postimage'").count() == 20


def test_skewed_member_and_key(spark):
    """One member holds a third of the rows; one transaction id repeats many times."""
    data = []
    for i in range(3000):
        member = "HOT" if i % 3 == 0 else f"M{i % 50}"
        tid = "TXN_HOT" if i % 10 == 0 else f"T{i}"
        data.append((tid, member, dt.date(2024, 1, 1) + dt.timedelta(days=i % 300),
                     Decimal("5.00") + (i % 100), 10, ["POS", "mobile_app"][i % 2], "S1",
                     "gold", i % 5, 202401 + (i % 300) // 31))
    df = spark.createDataFrame(data, "transaction_id string, member_id string, "
                               "transaction_date date, amount decimal(10,2), points_earned int, "
                               "channel string, store_id string, tier string, "
                               "redemption_points int, batch_id int")
    latest = latest_per_key(df, "transaction_id", ingest_order(df))
    assert latest.where("transaction_id = 'TXN_HOT'").count() == 1
    assert latest.count() == 3000 - 300 + 1
    plan = _plan(latest)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    s = {r["member_id"]: r for r in member_summary(latest, dt.date(2024, 12, 31)).collect()}
    hot = latest.where("member_id = 'HOT'")
    assert s["HOT"]["total_transactions"] == hot.count()
    assert s["HOT"]["lifetime_spend"] == hot.agg(F.sum("amount")).first()[0]
