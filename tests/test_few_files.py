"""Tables in months have files by what they hold, not by how many tasks write them, and the same rows."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators.summary import member_rollup
from tidemark.plans import pipeline as pl
from tidemark.sources import tables

TASKS, MONTHS = 16, 5
SCHEMA = ("transaction_id string, member_id string, transaction_date date, amount decimal(10,2), points_earned int, channel string, "
          "store_id string, tier string, redemption_points int, batch_id int")


@pytest.fixture()
def many_tasks(spark):
    spark.conf.set("spark.sql.shuffle.partitions", TASKS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def delivery(spark, first: int, n: int = 400):
    data = [(f"T{i}", f"M{i % 7}", dt.date(2024, 1 + i % MONTHS, 1 + i % 28), Decimal("9.50"), 10, ("POS", None)[i % 2], "S1", "gold", 1,
             202401 + i % MONTHS) for i in range(first, first + n)]
    return spark.createDataFrame(data, SCHEMA).repartition(TASKS)


def n_files(spark, folders) -> int:
    return spark.read.option("recursiveFileLookup", "true").parquet(*folders).select(F.input_file_name()).distinct().count()


def test_files_of_months_follow_the_months(spark, store, many_tasks, monkeypatch):
    monkeypatch.setattr(tables, "SMALL_SOURCE", 0)
    counts = {}
    for version, first in ((1, 0), (2, 200)):
        pl.load_landing(store, delivery(spark, first))
        pl.run_bronze(store, dt.datetime(2024, 6, version), by_month=True)
        pl.run_silver(store, dt.datetime(2024, 6, version))
        pl.refresh_rollup(store)
        entry = {t: [r for r in store._entries(t) if r["version"] == version][0] for t in (pl.BRONZE, pl.SILVER, pl.ROLLUP)}
        counts[version] = {t: n_files(spark, e["parts"]) for t, e in entry.items()}
        counts[version]["feed"] = n_files(spark, entry[pl.SILVER]["feed_parts"])
    for found in counts.values():
        assert found[pl.BRONZE] == MONTHS and found[pl.SILVER] == MONTHS and found["feed"] == MONTHS
        assert found[pl.ROLLUP] <= 2 * TASKS + MONTHS
    assert store.read_table(pl.SILVER).count() == 600
    assert rows(store.read_table(pl.ROLLUP).select("member_id", "transaction_month", "n").na.fill("")) == \
        rows(member_rollup(store.read_table(pl.SILVER)).select("member_id", "transaction_month", "n").na.fill(""))


@pytest.mark.parametrize("amount_type", ["decimal(10,2)", "double"])
def test_rollup_in_buckets_is_the_rollup(spark, amount_type):
    data = [("a", "2024-01", "POS", 1.25), ("a", "2024-01", "POS", 2.25), ("a", "2024-01", None, 1.0), ("b", "2024-02", None, None),
            (None, "2024-02", "POS", 3.0), (None, "2024-02", "POS", 3.0), ("a", None, "POS", 1.0)]
    txns = spark.createDataFrame([(*d, dt.date(2024, 1, 1), 5, 1) for d in data],
                                 "member_id string, transaction_month string, channel string, amount double, transaction_date date, "
                                 "points_earned int, redemption_points int").withColumn("amount", F.col("amount").cast(amount_type))
    plain, dealt = member_rollup(txns), member_rollup(txns, buckets=3)
    text = dealt._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert dealt.schema == plain.schema
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
