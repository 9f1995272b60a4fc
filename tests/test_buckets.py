"""Partitions told apart by value, and buckets of keys below them."""

import datetime as dt

import pytest

from tidemark.operators.merge import CHANGE_TYPE
from tidemark.sources import tables
from tidemark.sources.tables import bucket_of, folder_values

SCHEMA = "k string, p string, v int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


VALUES = [None, "a:b", "a/b", "50%", "x=y", "plain", "2024-01", "é {z}", "%3A", "a b", "q'\"", "*", "[x]"]


@pytest.mark.parametrize("buckets", [None, 2])
def test_merge_into_any_partition_value(spark, store, buckets):
    layout = {"bucket_by": ["k"], "buckets": buckets} if buckets else {}
    every = list(enumerate(VALUES))
    store.create(frame(spark, [(f"k{i}", p, 1) for i, p in every] + [(f"o{i}", p, 2) for i, p in every] + [("far", "elsewhere", 3)]), "t", partition_by="p", **layout)
    store.merge(frame(spark, [(f"k{i}", p, 11) for i, p in every] + [(f"n{i}", p, 4) for i, p in every]), "t", "k", partition_by="p")
    store.merge(frame(spark, [(f"o{i}", f"moved {p}", 20) for i, p in every]), "t", "k", partition_by="p",
                delete_keys=frame(spark, [(f"n{i}", p, 4) for i, p in every]).select("k"))
    moved = [(f"o{i}", f"moved {p}", 20) for i, p in every] + [("far", "elsewhere", 3)]
    assert content(store.read_table("t")) == content(frame(spark, [(f"k{i}", p, 11) for i, p in every] + moved))
    for i, p in every[:3]:
        assert content(store.read_table("t", partitions=[p])) == [(f"k{i}", p, 11)]
        assert content(store.read_table("t", version=1, partitions=[p])) == content(frame(spark, [(f"k{i}", p, 1), (f"o{i}", p, 2)]))
    store.replace_partitions(frame(spark, [(f"k{i}", p, 7) for i, p in every]), "t", "p", VALUES)
    store.publish_partitions(frame(spark, [(f"l{i}", p, 8) for i, p in every]), "t", "p", replace=VALUES[::2])
    left = [(f"k{i}", p, 7) for i, p in every if i % 2] + [(f"l{i}", p, 8) for i, p in every]
    assert content(store.read_table("t")) == content(frame(spark, left + moved))


@pytest.mark.parametrize("buckets", [None, 2])
def test_large_source_merges_in_one_join_with_the_same_rows_and_feed(spark, store, monkeypatch, buckets):
    """Above SMALL_SOURCE rows both sides meet in one full outer join; table, feed and folders are those of the joins by keys."""
    joins, merged = [], tables.upsert_with_changes
    monkeypatch.setattr(tables, "upsert_with_changes", lambda *a, **k: joins.append(k["by_keys"]) or merged(*a, **k))
    layout = {"bucket_by": ["k"], "buckets": buckets} if buckets else {}
    old = [(f"k{i}", f"p{i % 3}", i) for i in range(30)] + [("same", None, 5), ("newer", "p1", 9), ("gone", "p2", 1), ("far", "p9", 1)]
    new = [(f"k{i}", f"p{i % 2}", i + 100) for i in range(0, 30, 4)] + [("same", None, 5), ("newer", "p0", 3), ("n", "p7", 1), (None, "p0", 2)]
    got = []
    for name, limit in (("by_keys", 100), ("outer", len(new) - 1)):
        monkeypatch.setattr(tables, "SMALL_SOURCE", limit)
        store.create(frame(spark, old), name, partition_by="p", **layout)
        store.merge(frame(spark, new), name, "k", version_cols=("v",), partition_by="p", delete_keys=frame(spark, [("gone",), ("n",)], "k string"))
        feed = store.read_changes(name, 1, 2, ("insert", "update_preimage", "update_postimage", "delete"), with_meta=True)
        info = store.version_info(name)
        got.append((content(store.read_table(name)), content(feed), sorted(map(str, map(folder_values, info.parts))), sum("=2-" in p for p in info.parts)))
    assert joins == [True, False] and got[0] == got[1]
    assert ("newer", "p1", 9) in got[1][0] and ("k4", "p0", 104) in got[1][0] and not {"gone", "n"} & {r[0] for r in got[1][0]}


def test_merge_into_empty_text_partition_reads_as_null(spark, store):
    store.create(frame(spark, [("k", "", 1)]), "t", partition_by="p")
    store.merge(frame(spark, [("k", "", 2)]), "t", "k", partition_by="p")
    assert content(store.read_table("t")) == [("k", None, 2)]


@pytest.mark.parametrize("kind,a,b", [("date", dt.date(2024, 1, 2), dt.date(2025, 1, 2)), ("boolean", True, False),
                                      ("timestamp_ntz", dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2)), ("decimal(9,2)", None, None)])
def test_merge_by_typed_partition(spark, store, kind, a, b):
    schema = f"k string, p {kind}, v int"
    store.create(frame(spark, [("x", a, 1), ("y", b, 2)], schema), "t", partition_by="p")
    store.merge(frame(spark, [("x", b, 3), ("y", b, 4), ("z", a, 5)], schema), "t", "k", partition_by="p")
    assert content(store.read_table("t")) == content(frame(spark, [("x", b, 3), ("y", b, 4), ("z", a, 5)], schema))


def test_bucketed_merge_reads_and_rewrites_its_buckets_only(spark, store):
    n, b = 4000, 16
    rows = spark.range(n).selectExpr("concat('k', id) k", "concat('m', id % 5) p", "cast(id as int) v")
    store.create(rows, "t", partition_by="p", bucket_by=["k"], buckets=b)
    before = store.version_info("t")
    assert len(before.parts) == 5 * b
    # a batch of three keys, one of which changes its partition
    batch = frame(spark, [("k7", "m2", -1), ("k8", "m0", -1), ("brand new", "m4", -1)])
    wanted = {r[0] for r in batch.select(bucket_of(["k"], b)).collect()}
    touched = store.touched_folders(before, "t", batch, ["k"], None, "p")
    assert {int(x) for _, x in touched} <= wanted and len(touched) <= 4
    read = []
    original = store._read_parts
    store._read_parts = lambda name, parts, *a: read.extend(parts) or original(name, parts, *a)
    store.merge(batch, "t", "k", partition_by="p")
    store._read_parts = original
    assert {int(folder_values(x)[1]) for x in read} <= wanted
    after = store.version_info("t")
    assert (after.bucket_by, after.buckets) == (["k"], b)
    assert set(before.parts) - set(after.parts) == {p for p in before.parts if folder_values(p) in touched}
    got = {r.k: (r.p, r.v) for r in store.read_table("t").collect()}
    assert len(got) == n + 1 == store.read_table("t").count()
    assert got["k7"] == ("m2", -1) and got["k8"] == ("m0", -1) and got["brand new"] == ("m4", -1) and got["k9"] == ("m4", 9)
    kinds = sorted((r.k, r[CHANGE_TYPE]) for r in store.read_changes("t", 1, 2, ("insert", "update_preimage", "update_postimage", "delete"), with_meta=True).collect())
    assert kinds == [("brand new", "insert"), ("k7", "update_postimage"), ("k7", "update_preimage"), ("k8", "update_postimage"), ("k8", "update_preimage")]


def test_buckets_without_partitions(spark, store):
    rows = spark.range(200).selectExpr("concat('k', id) k", "'p' p", "cast(id as int) v")
    store.create(rows, "t", bucket_by=["k"], buckets=8)
    store.merge(frame(spark, [("k3", "q", 0), ("more", "q", 0)]), "t", "k", delete_keys=frame(spark, [("k4", "", 0)]).select("k"))
    got = {r.k: r.v for r in store.read_table("t").collect()}
    assert len(got) == 200 and got["k3"] == 0 and "k4" not in got
    assert len(store.version_info("t").parts) == 8
