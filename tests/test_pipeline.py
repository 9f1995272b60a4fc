"""Pipeline properties on the driver's smallest tables (sf0.001)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tidemark.functions.exprs import FIXTURE_TIERS
from tidemark.operators.summary import member_summary
from tidemark.plans import pipeline as pl
from tidemark.plans import scenario as sc
from tidemark.sources.adapters import landing_transactions


@pytest.fixture(scope="module")
def built(spark):
    store, results = sc.build(spark, SF_SMALL, label="test-scenario")
    return store, results


def _gold_cols(df):
    return df.drop("days_since_last_txn", "last_updated_ts")


def test_runs_and_modes(built):
    _, results = built
    modes = [[r.get("mode") for r in run if r["stage"] == "gold"][0] for run in results]
    assert modes == ["full", "incremental", "incremental"]
    assert all(r["status"] == "ok" for run in results for r in run)


def test_incremental_gold_equals_full_recompute(spark, built):
    store, _ = built
    silver = store.read_table(pl.SILVER)
    full = member_summary(silver, sc.RUNS[-1][0], FIXTURE_TIERS)
    assert rows(_gold_cols(store.read_table(pl.GOLD))) == rows(_gold_cols(full))


def test_silver_is_unique_and_matches_batch_dedup(spark, built):
    store, _ = built
    silver = store.read_table(pl.SILVER)
    assert silver.groupBy("transaction_id").count().where("count > 1").count() == 0
    from tidemark.plans.queries_tables import silver_between
    expect = silver_between(spark, SF_SMALL).drop("transaction_month")
    assert rows(silver.drop("ingested_at", "transaction_month")) == rows(expect)


def test_history_invariants(built):
    store, _ = built
    h = store.read_table(pl.HISTORY).collect()
    by = {}
    for r in h:
        by.setdefault(r["member_id"], []).append(r)
    for periods in by.values():
        periods.sort(key=lambda r: r["effective_date"])
        assert sum(p["is_current"] for p in periods) == 1
        for a, b in zip(periods, periods[1:]):
            assert a["expiry_date"] + dt.timedelta(days=1) == b["effective_date"]
            assert a["current_tier"] != b["current_tier"]


def test_partition_scoped_merge_reuses_untouched_folders(spark, store):
    df = spark.createDataFrame(
        [("a", 1, "2024-01"), ("b", 2, "2024-02"), ("c", 3, "2024-03")],
        "k string, v int, m string")
    v1 = store.create(df, "t", partition_by="m")
    src = spark.createDataFrame([("b", 20, "2024-02"), ("d", 4, "2024-04")],
                                "k string, v int, m string")
    v2 = store.merge(src, "t", ["k"], partition_by="m")
    p1, p2 = store.version_info("t", v1).parts, store.version_info("t", v2).parts
    reused = sorted(p for p in p2 if "/tm_version=1-" in p)
    assert [p.rsplit("/", 1)[-1] for p in reused] == ["m=2024-01", "m=2024-03"]
    assert set(reused) <= set(p1)
    assert rows(store.read_table("t")) == [("a", 1, "2024-01"), ("b", 20, "2024-02"),
                                           ("c", 3, "2024-03"), ("d", 4, "2024-04")]
    assert rows(store.read_table("t", version=v1)) == rows(df)          # old version intact
    assert rows(store.read_table("t", partitions=["2024-02"])) == [("b", 20, "2024-02")]
    # a key that moves month: its old partition is rewritten without it
    mv = spark.createDataFrame([("a", 9, "2024-03")], "k string, v int, m string")
    store.merge(mv, "t", ["k"], partition_by="m")
    assert rows(store.read_table("t"), "k", "m") == [("a", "2024-03"), ("b", "2024-02"),
                                                    ("c", "2024-03"), ("d", "2024-04")]


def test_nothing_new_exits_early_and_rerun_is_idempotent(spark, built):
    store, _ = built
    as_of, upto, run_ts = sc.RUNS[-1]
    before = rows(store.read_table(pl.SILVER).drop("ingested_at"))
    assert pl.run_bronze(store, run_ts)["status"] == "skipped"
    assert pl.run_silver(store, run_ts)["status"] == "skipped"
    assert pl.run_gold(store, as_of, run_ts, sc.SCENARIO_CONFIG)["status"] == "skipped"
    assert pl.run_history(store, as_of)["status"] == "skipped"
    # rerun of an old business date: older copies never replace newer ones
    some_day = store.read_table(pl.SILVER).agg(F.min("transaction_date")).first()[0]
    pl.run_silver(store, run_ts, rerun_date=some_day)
    assert rows(store.read_table(pl.SILVER).drop("ingested_at")) == before


def test_crash_before_save_version_is_retried(spark, store, monkeypatch):
    land = landing_transactions(spark, SF_SMALL).where("transaction_date < '1995-02-15'")
    pl.load_landing(store, land)
    run_ts = dt.datetime(2002, 1, 1)
    real = store.save_version

    def failing(job, v):
        raise RuntimeError("crash after write, before save_version")

    monkeypatch.setattr(store, "save_version", failing)
    with pytest.raises(RuntimeError):
        pl.run_bronze(store, run_ts)
    monkeypatch.setattr(store, "save_version", real)
    assert pl.run_bronze(store, run_ts)["status"] == "skipped"      # the load is there already
    assert store.read_table(pl.BRONZE).drop("ingested_at", "load_id").exceptAll(land).isEmpty() and store.read_table(pl.BRONZE).count() == land.count()
    assert store.get_last_version(pl.JOB_BRONZE) == store.current_version(pl.LANDING)
    pl.load_landing(store, land.limit(7))
    assert pl.run_bronze(store, run_ts)["rows"] == 7                # only the new commit
    pl.run_silver(store, run_ts)
    silver = store.read_table(pl.SILVER)
    assert silver.groupBy("transaction_id").count().where("count > 1").count() == 0


def test_stream_matches_batch_silver_and_replays_safely(spark, built):
    from tidemark.streaming.silver_stream import stream_silver
    store, _ = built
    info = stream_silver(spark, store, "silver_stream_t", max_commits_per_trigger=2)
    assert info["batches"] >= 1
    s = store.read_table("silver_stream_t").drop("ingested_at")
    b = store.read_table(pl.SILVER).drop("ingested_at")
    assert rows(s) == rows(b)
    again = stream_silver(spark, store, "silver_stream_t")      # nothing new: no change
    assert rows(store.read_table("silver_stream_t").drop("ingested_at")) == rows(s)


def test_gate_scans_everything_and_catches_duplicates(spark, built):
    from tidemark.operators.quality import GateFailed
    store, _ = built
    n = store.read_table(pl.SILVER).count()
    report = {r["expectation"]: r["element_count"] for r in store.read_table(pl.GATE).collect()}
    assert report["unique_transaction_id"] == report["not_null_member_id"] == n
    # plant a duplicate through a raw publication (bypassing the keyed merge)
    silver = store.read_table(pl.SILVER)
    dup = silver.limit(1)
    store.publish(silver.unionByName(dup), pl.SILVER, changes=dup.withColumn(
        "_change_type", F.lit("insert")), partition_by="transaction_month")
    with pytest.raises(GateFailed):
        pl.run_gate(store, sc.SCENARIO_CONFIG)


def test_sql_views_over_published_tables(spark, built):
    store, _ = built
    assert "gold_member_summary" in store.register_views(pl.SQL_VIEWS)
    sql = """
        SELECT current_tier, COUNT(*) AS member_count,
               ROUND(AVG(total_transactions), 1) AS avg_transactions_per_member
        FROM gold_member_summary GROUP BY current_tier"""
    got = {r["current_tier"]: r["member_count"] for r in spark.sql(sql).collect()}
    gold = store.read_table(pl.GOLD)
    want = {r["current_tier"]: r["count"] for r in gold.groupBy("current_tier").count().collect()}
    assert got == want
    velocity = spark.sql("""
        SELECT h1.member_id FROM gold_member_tier_history h1
        JOIN gold_member_tier_history h2 ON h1.member_id = h2.member_id
         AND h2.effective_date = DATE_ADD(h1.expiry_date, 1)
        WHERE h1.current_tier != h2.current_tier""")
    from tidemark.plans.analytics import tier_velocity
    assert velocity.count() == tier_velocity(store.read_table(pl.HISTORY)).count()


def test_history_keeps_closed_folders(built):
    store, _ = built
    v2, v3 = store.version_info(pl.HISTORY, 2), store.version_info(pl.HISTORY, 3)
    closed2 = [p for p in v2.parts if p.endswith("is_current=false")]
    closed3 = [p for p in v3.parts if p.endswith("is_current=false")]
    assert closed2 and set(closed2) < set(closed3)          # appended, not rewritten
    assert [p for p in v3.parts if p.endswith("is_current=true")] == \
        [p for p in v3.parts if "/tm_version=3-" in p and p.endswith("is_current=true")]


def test_append_feed_ranges_and_next_batch_date(spark, store):
    from tidemark.functions.dates import next_batch_date
    df = spark.createDataFrame([(i, f"r{i}", 202401 + i % 3) for i in range(9)],
                               "id int, v string, batch_id int")
    assert [store.append(df.where(F.col("batch_id") == b), "land") for b in (202403, 202401, 202402)] == [(1, 3), (2, 3), (3, 3)]
    feed = store.read_changes("land", 1, 3, ("insert",), with_meta=True)
    assert sorted({(r["_commit_version"], r["batch_id"]) for r in feed.collect()}) == [(2, 202401), (3, 202402)]
    assert feed.count() == 6
    # publishing a named commit again replaces it instead of appending twice
    store.append(df.where("batch_id = 202402"), "land", version=3)
    assert store.read_batches("land").count() == 9
    # a column added later is NULL in earlier commits
    store.append(df.limit(1).withColumn("extra", F.lit(1.5)), "land")
    assert [r["extra"] for r in store.read_batches("land").orderBy("extra").collect()] == [None] * 9 + [1.5]
    empty = spark.createDataFrame([], "transaction_date date")
    assert next_batch_date(empty, default=dt.date(2024, 5, 1)).first()[0] == dt.date(2024, 5, 1)
    days = spark.createDataFrame([(dt.date(2024, 1, 30),), (dt.date(2024, 1, 31),)],
                                 "transaction_date date")
    assert next_batch_date(days).first()[0] == dt.date(2024, 2, 1)


# ---- crashes ------------------------------------------------------------------

KV = "k string, v int, m string"


def _tables(spark):
    base = spark.createDataFrame([("a", 1, "2024-01"), ("b", 2, "2024-02")], KV)
    crashed = spark.createDataFrame([("a", 9, "2024-01"), ("c", 9, "2024-01")], KV)
    other = spark.createDataFrame([("b", 3, "2024-02"), ("d", 4, "2024-02")], KV)
    return base, crashed, other


@pytest.mark.parametrize("step", ["_write_version", "_write_changes", "_write_log"])
def test_crashed_merge_leaves_no_trace(spark, store, monkeypatch, step):
    base, crashed, other = _tables(spark)
    store.create(base, "t", partition_by="m")
    real = getattr(store, step)

    def crash(*a, **kw):
        if step != "_write_log":
            real(*a, **kw)              # files are written, then the process dies
        raise RuntimeError("crash")

    monkeypatch.setattr(store, step, crash)
    with pytest.raises(RuntimeError):
        store.merge(crashed, "t", ["k"], partition_by="m")
    monkeypatch.setattr(store, step, real)
    assert rows(store.read_table("t")) == rows(base)
    store.merge(other, "t", ["k"], partition_by="m")
    assert rows(store.read_table("t")) == [("a", 1, "2024-01"), ("b", 3, "2024-02"), ("d", 4, "2024-02")]
    feed = store.read_changes("t", 1, 2, ("insert", "update_postimage"))
    assert rows(feed) == [("b", 3, "2024-02"), ("d", 4, "2024-02")]


@pytest.mark.parametrize("write", ["replace_partitions", "publish_partitions", "append"])
def test_crashed_writes_are_not_published_by_the_next(spark, store, monkeypatch, write):
    base, crashed, other = _tables(spark)
    store.append(base, "t") if write == "append" else store.create(base, "t", partition_by="m")
    calls = {"replace_partitions": lambda df, m: store.replace_partitions(df, "t", "m", [m]),
             "publish_partitions": lambda df, m: store.publish_partitions(df, "t", "m", replace=[m]),
             "append": lambda df, m: store.append(df, "t")}
    real = store._write_log
    monkeypatch.setattr(store, "_write_log", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError):
        calls[write](crashed, "2024-01")
    monkeypatch.setattr(store, "_write_log", real)
    calls[write](other, "2024-02")
    want = rows(base) + rows(other) if write == "append" else [("a", 1, "2024-01")] + rows(other)
    assert rows(store.read_table("t")) == sorted(want)


def test_unreadable_log_is_an_error(spark, store):
    from tidemark.sources.tables import TableStore
    base, crashed, _ = _tables(spark)
    assert not store.exists("t")                    # no log folder yet: nothing is published
    store.create(base, "t", partition_by="m")
    folder = store.log_path("t").removeprefix("file:") + "/version=1"
    with open(f"{folder}/part-broken.parquet", "wb") as f:
        f.write(b"not parquet")
    again = TableStore(spark, store.root)
    with pytest.raises(Exception):
        again.exists("t")
    with pytest.raises(Exception):
        again.merge(crashed, "t", ["k"], partition_by="m")
    assert rows(store.read_table("t")) == rows(base)


def test_merge_rejects_several_source_rows_per_key(spark, store):
    base, _, _ = _tables(spark)
    store.create(base, "t", partition_by="m")
    twice = spark.createDataFrame([("a", 5, "2024-01"), ("a", 6, "2024-01")], KV)
    with pytest.raises(Exception, match="several rows"):
        store.merge(twice, "t", ["k"], partition_by="m")
    assert rows(store.read_table("t")) == rows(base)


def test_staged_copies_are_removed(spark, built):
    from tidemark.session import list_folder, path_exists
    store, _ = built
    staging = f"{store.root}/_staging"
    assert not path_exists(spark, staging) or len(list_folder(spark, staging)) <= 3


def test_rerun_quarantines_and_reads_one_day(spark, store):
    from tidemark.functions.dates import filter_dates
    land = landing_transactions(spark, SF_SMALL).where("transaction_date between '1998-01-01' and '1998-01-20'")
    run_ts = dt.datetime(2002, 1, 1)
    first = F.dayofmonth("transaction_date") < 11
    for part in (land.where(first), land.where(~first)):
        pl.load_landing(store, part)
        pl.run_bronze(store, run_ts)
        pl.run_silver(store, run_ts)
    rejected = "member_id is null or amount is null or amount <= 0"
    day = land.where(rejected).agg(F.min("transaction_date")).first()[0]
    before = store.read_batches(pl.QUARANTINE).count()
    bad = land.where(F.col("transaction_date") == day).where(rejected).count()
    assert before == land.where(rejected).count() and bad > 0
    for _ in range(2):                              # a retried rerun replaces its quarantine commit
        pl.run_silver(store, run_ts, rerun_date=day)
        assert store.read_batches(pl.QUARANTINE).count() == before + bad
    scan = filter_dates(store.read_batches(pl.BRONZE), day, day)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_date" in plan
    month = filter_dates(store.read_table(pl.SILVER), day, day)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_month" in month


# ---- vanished keys, mixed layouts -------------------------------------------------

def _txn(spark, *made):
    """Landing rows of (transaction_id, member_id, date, amount, batch_id)."""
    return spark.createDataFrame(
        [(t, m, dt.date.fromisoformat(d), float(a), 10, "web", "STR1", "basic", 0, b) for t, m, d, a, b in made],
        "transaction_id string, member_id string, transaction_date date, amount double, points_earned int, "
        "channel string, store_id string, tier string, redemption_points int, batch_id int"
    ).withColumn("amount", F.col("amount").cast("decimal(10,2)"))


def _run_to_gold(store, run_ts, delivery):
    pl.load_landing(store, delivery)
    pl.run_bronze(store, run_ts)
    pl.run_silver(store, run_ts)
    return pl.run_gold(store, dt.date(2024, 3, 1), run_ts)


def test_member_that_vanishes_from_an_untouched_tier_is_deleted(spark, store):
    first = _txn(spark, ("t1", "a", "2024-01-05", 6000, 1), ("t2", "b", "2024-01-06", 10, 1))
    assert _run_to_gold(store, dt.datetime(2024, 2, 1), first)["mode"] == "full"
    assert rows(store.read_table(pl.GOLD), "member_id", "current_tier") == [("a", "gold"), ("b", "bronze")]
    # a's last transaction moves to c, at an amount that keeps c out of a's tier
    moved = _txn(spark, ("t1", "c", "2024-01-05", 2000, 2))
    before = store.current_version(pl.GOLD)
    assert _run_to_gold(store, dt.datetime(2024, 2, 2), moved)["mode"] == "incremental"
    assert rows(store.read_table(pl.GOLD), "member_id", "current_tier") == [("b", "bronze"), ("c", "silver")]
    feed = store.read_changes(pl.GOLD, before, None, pl.ALL_CHANGES, with_meta=True)
    assert rows(feed, "member_id", "_change_type") == [("a", "delete"), ("c", "insert")]


def test_merge_with_only_delete_keys(spark, store):
    base, _, other = _tables(spark)
    store.create(base, "t", partition_by="m")
    gone = spark.createDataFrame([("a",), ("x",)], "k string")
    version = store.merge(other.limit(0), "t", ["k"], partition_by="m", delete_keys=gone)
    assert rows(store.read_table("t")) == [("b", 2, "2024-02")]
    assert rows(store.read_changes("t", 1, version, ("delete",))) == [("a", 1, "2024-01")]
    assert store.touched_partitions("t", 1, version) == ["2024-01"]
    assert rows(store.read_table("t", version=1)) == rows(base)


def test_rerun_reads_day_loads_beside_month_loads(spark, store):
    run_ts, day = dt.datetime(2024, 2, 1), dt.date(2024, 1, 5)
    pl.load_landing(store, _txn(spark, ("t1", "a", "2024-01-05", 10, 1), ("t2", "a", "2023-11-05", 10, 1)))
    pl.run_bronze(store, run_ts, by_month=True)
    pl.load_landing(store, _txn(spark, ("t3", "b", "2024-01-05", 20, 2), ("t4", "b", "2024-01-06", 20, 2)))
    pl.run_bronze(store, run_ts)
    assert pl.run_silver(store, run_ts, rerun_date=day)["status"] == "ok"
    assert rows(store.read_table(pl.SILVER), "transaction_id") == [("t1",), ("t3",)]
    # each layout is pruned by its own partition column
    plan = pl.bronze_day(store, day)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_month" in plan
    assert "PartitionFilters: [isnotnull(transaction_date" in plan


def test_upstream_month_column_does_not_cut_a_rerun(spark, store):
    run_ts, day = dt.datetime(2024, 2, 1), dt.date(2024, 1, 5)
    made = _txn(spark, ("t1", "a", "2024-01-05", 10, 1), ("t2", "a", "2024-01-05", 10, 1))
    pl.load_landing(store, made.withColumn("transaction_month", F.when(F.col("transaction_id") == "t1", "Jan 24")))
    pl.run_bronze(store, run_ts)
    pl.run_silver(store, run_ts, rerun_date=day)
    assert rows(store.read_table(pl.SILVER), "transaction_id") == [("t1",), ("t2",)]
