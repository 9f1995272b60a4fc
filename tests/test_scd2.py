import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators.scd2 import apply_tier_changes, init_history, tier_as_of

D = dt.date


def _summary(spark, data):
    return spark.createDataFrame(data, "member_id string, current_tier string")


def _check_invariants(history):
    by = {}
    for r in history.collect():
        by.setdefault(r["member_id"], []).append(r)
    for periods in by.values():
        periods.sort(key=lambda r: r["effective_date"])
        assert sum(1 for p in periods if p["is_current"]) == 1
        for a, b in zip(periods, periods[1:]):
            assert a["expiry_date"] == b["effective_date"] - dt.timedelta(days=1)   # no gap/overlap
            assert a["expiry_date"] >= a["effective_date"]
        assert periods[-1]["is_current"] and periods[-1]["expiry_date"] == D(9999, 12, 31)


def test_scd2_lifecycle(spark):
    h = init_history(_summary(spark, [("A", "bronze"), ("B", "gold")]), D(2024, 1, 1))
    h, ch = apply_tier_changes(h, _summary(spark, [("A", "silver"), ("B", "gold"), ("C", "bronze")]),
                               D(2024, 2, 1))
    _check_invariants(h)
    assert sorted(r["_change_type"] for r in ch.collect()) == \
        ["insert", "insert", "update_postimage", "update_preimage"]
    # same-day second change rewrites the open period in place
    h, _ = apply_tier_changes(h, _summary(spark, [("A", "gold"), ("B", "gold"), ("C", "bronze")]),
                              D(2024, 2, 1))
    _check_invariants(h)
    assert rows(h.where("member_id = 'A'"), "current_tier", "effective_date") == \
        [("bronze", D(2024, 1, 1)), ("gold", D(2024, 2, 1))]
    # last day of a closed period still finds it (inclusive expiry)
    assert rows(tier_as_of(h, D(2024, 1, 31))) == [("A", "bronze"), ("B", "gold")]
    assert rows(tier_as_of(h, D(2024, 2, 1))) == [("A", "gold"), ("B", "gold"), ("C", "bronze")]
    # unchanged rerun changes nothing
    h2, ch2 = apply_tier_changes(h, _summary(spark, [("A", "gold"), ("B", "gold"), ("C", "bronze")]),
                                 D(2024, 3, 1))
    assert ch2.count() == 0 and rows(h2) == rows(h)
