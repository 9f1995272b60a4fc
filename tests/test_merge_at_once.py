"""Merges of large sources by one job: same table, feed, folders and metrics as through a staged decision set."""
import datetime as dt

import pytest

from conftest import plan_text, rows
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.merge import CHANGE_TYPE, rows_and_changes
from tidemark.plans import pipeline as pl
from tidemark.sources import tables
from tidemark.sources.tables import as_value, folder_values
from pyspark.sql import functions as F

SCHEMA = "k string, ver int, m string, v int"
OLD = [("a", 1, "2024-01", 1), ("b", 5, "2024-01", 1), ("c", 1, "2024-02", 1), ("d", 1, "2024-03", 1), ("e", 1, None, 1),
       ("f", 1, "x/y=z", 1), ("g", 1, "2024-05", 1), (None, 1, "2024-06", 1)]
# a moves, b is older than the table's copy and names a month without rows, c is equal, n is new, e leaves the null month
NEW = [("a", 2, "2024-02", 2), ("b", 4, "2024-04", 2), ("c", 1, "2024-02", 1), ("n", 1, "2024-07", 1), ("e", 2, "x/y=z", 2), (None, 2, "2024-01", 2)]
FEED = ("insert", "update_preimage", "update_postimage", "delete")


def merged(spark, store, name, source, at_once):
    store.create(spark.createDataFrame(OLD, SCHEMA), name, partition_by="m")
    store.merge(source, name, ["k"], version_cols=("ver",), partition_by="m", at_once=at_once)
    entry = [r for r in store._entries(name) if r["version"] == 2][0]
    key = lambda r: tuple((x is not None, x if x is not None else "") for x in r)
    kept = sorted((folder_values(p) for p in entry["parts"] if "/tm_version=1-" in p), key=key)
    return (sorted(map(tuple, store.read_table(name).collect()), key=key),
            sorted(map(tuple, store.read_changes(name, 1, 2, FEED, with_meta=True).select(*"k ver m v".split(), CHANGE_TYPE).collect()), key=key),
            kept, entry["touched"], [entry[c] for c in ("rows_written", "rows_inserted", "rows_updated", "rows_deleted")])


@pytest.mark.parametrize("source", [NEW, NEW[:1], NEW[2:3], []], ids=["all", "one", "equal", "none"])
def test_one_job_publishes_what_a_staged_merge_does(spark, store, source):
    frame = spark.createDataFrame(source, SCHEMA)
    got = merged(spark, store, "once", frame, True)
    assert got == merged(spark, store, "staged", frame, False)
    assert store._staged and not [p for p in store._staged if "once" in p]


def test_folders_of_months_not_concerned_are_those_of_before(spark, store):
    merged(spark, store, "t", spark.createDataFrame(NEW, SCHEMA), True)
    before, after = store.version_info("t", 1).parts, store.version_info("t").parts
    assert {folder_values(p)[0] for p in set(before) & set(after)} == {"2024-03", "2024-05", "2024-06"}
    assert as_value(None) not in {folder_values(p)[0] for p in after}


def test_several_source_rows_of_a_key_are_an_error(spark, store):
    with pytest.raises(Exception, match="several rows"):
        merged(spark, store, "t", spark.createDataFrame(NEW[:1] * 2, SCHEMA), True)
    assert store.current_version("t") == 1


def test_a_deduplicated_source_is_shuffled_once(spark):
    frame = spark.createDataFrame(NEW, SCHEMA)
    source = latest_per_key(frame, "k", [F.col("ver").desc()])
    plan = rows_and_changes(spark.createDataFrame(OLD, SCHEMA), source, ["k"], ("ver",), "m")
    assert plan_text(plan).count("Exchange hashpartitioning") == 2      # the target's and the source's


def test_large_batches_go_through_silver_unstaged(spark, store, monkeypatch):
    """Bronze by month and Silver of large batches: nothing staged, no layout by month, same rows."""
    def landing(n, points):
        return spark.range(n).select(
            F.concat(F.lit("T"), "id").alias("transaction_id"), F.concat(F.lit("M"), F.col("id") % 3).alias("member_id"),
            F.date_add(F.lit(dt.date(2024, 1, 30)), (F.col("id") % 4).cast("int")).alias("transaction_date"),
            F.lit(10).cast("decimal(10,2)").alias("amount"), F.lit(points).alias("points_earned"), F.lit("POS").alias("channel"),
            F.lit("S").alias("store_id"), F.lit("gold").alias("tier"), F.lit(0).alias("redemption_points"), F.lit(points).alias("batch_id"))
    monkeypatch.setattr(tables, "SMALL_SOURCE", 0)
    staged, stage = [], store.stage
    monkeypatch.setattr(store, "stage", lambda df, label: staged.append(label) or stage(df, label))
    for n, points in ((40, 1), (30, 2)):
        pl.load_landing(store, landing(n, points))
        pl.run_bronze(store, dt.datetime(2024, 2, points), by_month=True)
        pl.run_silver(store, dt.datetime(2024, 2, points))
    assert staged == []
    got = store.read_table(pl.SILVER)
    assert got.count() == 40 and got.where("points_earned = 2").count() == 30
    assert rows(got.select("transaction_month").distinct()) == [("2024-01",), ("2024-02",)]
    assert store.read_changes(pl.SILVER, 1, 2, ("update_preimage",)).count() == 30
    # a small batch is still staged and looked up by its keys
    assert not store.merges_at_once(pl.SILVER, 4) and store.merges_at_once(pl.SILVER, 5)
