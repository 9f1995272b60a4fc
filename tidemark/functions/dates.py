"""Date-range helpers that reach the Silver partition column."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import round_ratio_half_up, to_date_lit


def _month(d) -> str:
    d = d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))
    return f"{d.year:04d}-{d.month:02d}"


def filter_dates(df: DataFrame, start, end, date_col: str = "transaction_date",
                 month_col: str | None = "transaction_month") -> DataFrame:
    """Rows with ``start <= date <= end``.

    A filter on the date alone cannot prune ``yyyy-MM`` partition folders,
    so the equivalent month range is added: it becomes a PartitionFilter on
    the scan, and the date predicate still reaches Parquet as a pushed filter.
    """
    out = df.where(F.col(date_col).between(to_date_lit(start), to_date_lit(end)))
    if month_col and month_col in df.columns:
        out = out.where(F.col(month_col).between(F.lit(_month(start)), F.lit(_month(end))))
    return out


def next_batch_date(df: DataFrame, date_col: str = "transaction_date", default=None) -> DataFrame:
    """One row: the day after the latest ``date_col`` (``default`` when empty)."""
    default_col = to_date_lit(default) if default is not None else F.current_date()
    return df.agg(F.coalesce(F.date_add(F.max(date_col), 1), default_col).alias("next_batch_date"))


def scan_share(df: DataFrame, start, end, date_col: str = "transaction_date") -> DataFrame:
    """Rows in the table, rows in the date range and their share (%), in one pass."""
    hit = F.col(date_col).between(to_date_lit(start), to_date_lit(end))
    agg = df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(hit).alias("filtered_rows"))
    return agg.select("total_rows", "filtered_rows",
                      round_ratio_half_up("filtered_rows * 100", "total_rows")
                      .alias("pct_scanned"))
