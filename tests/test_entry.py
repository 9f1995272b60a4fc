"""Driver contract and a DuckDB oracle sweep on the smallest tables."""

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events".split()
QUICK = ["member_summary", "ltv_by_tier", "channel_engagement", "monthly_active", "dedup_latest",
         "dq_report", "reconcile_cast_bad", "merge_late_arrivals", "change_capture",
         "store_dim", "breakage_by_tier"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 4
    assert df.columns[0] == "current_tier"


def test_registry_shapes():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 48


def _canon(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(None if (v is None or v != v) else str(v)[:10] if hasattr(v, "isoformat")
                         else repr(float(v)) if isinstance(v, float) else str(v) for v in rec))
    return sorted(out, key=lambda r: tuple("" if x is None else x for x in r))


@pytest.mark.parametrize("name", QUICK)
def test_oracle_matches(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = con.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _canon(got) == _canon(want)
