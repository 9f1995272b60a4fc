"""Column expressions shared by operators and analytics.

Everything here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must stay as given) ------------------------------------
# Spend thresholds for the member tier, highest first (reference defaults).
DEFAULT_TIERS = (("platinum", 10000), ("gold", 5000), ("silver", 1000))
# Thresholds that spread the driver's fixture spend over all four tiers.
FIXTURE_TIERS = (("platinum", 2000000), ("gold", 1500000), ("silver", 1000000))
BASE_TIER = "bronze"
# Display order of tiers in the analytics.
TIER_ORDER = ("platinum", "gold", "silver", "bronze")
# Churn segments by days since the last transaction: (segment, more than N days).
CHURN_BANDS = (("high_risk", 180), ("medium_risk", 90), ("low_risk", 30))
CHURN_ACTIVE = "active"
# Open end of an SCD2 interval.
OPEN_EXPIRY = dt.date(9999, 12, 31)
# ---------------------------------------------------------------------------


def tier_of(spend: Column, tiers=DEFAULT_TIERS) -> Column:
    """CASE WHEN spend >= t1 THEN ... ELSE 'bronze' END."""
    expr = None
    for name, threshold in tiers:
        cond = spend >= F.lit(threshold)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(BASE_TIER))


def tier_rank(tier: Column) -> Column:
    expr = None
    for i, name in enumerate(TIER_ORDER, start=1):
        cond = tier == F.lit(name)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def churn_segment(days: Column) -> Column:
    expr = None
    for name, limit in CHURN_BANDS:
        cond = days > F.lit(limit)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(CHURN_ACTIVE))


def month_of(date_col: Column) -> Column:
    """``yyyy-MM`` text of a date (the Silver partition value)."""
    return F.date_format(date_col, "yyyy-MM")


_COLUMN = re.compile(r"\b[a-z_][a-z0-9_]*\b(?!\s*\()", re.IGNORECASE)


def _widened(sql: str) -> str:
    """The expression with its columns, or a datediff as a whole, as decimals."""
    if "datediff" in sql:
        return re.sub(r"datediff\([^)]*\)", lambda m: f"CAST({m[0]} AS DECIMAL(28,0))", sql)
    return _COLUMN.sub(lambda m: f"CAST({m[0]} AS DECIMAL(28,0))", sql)


def ratio_units_sql(num_sql: str, den_sql: str, scale_pow10: int = 100) -> str:
    """SQL for round(num / den * scale) as an exact BIGINT, half away from zero.

    ``num_sql`` and ``den_sql`` are integral SQL expressions. Their columns are
    widened to DECIMAL(28,0) before anything is multiplied, so sums of cents
    over a whole corpus don't overflow. NULL when the denominator is 0 or NULL.
    """
    n = f"(CAST(({_widened(num_sql)}) AS DECIMAL(33,0)) * {int(scale_pow10)}BD)"
    d = f"CAST(({_widened(den_sql)}) AS DECIMAL(33,0))"
    return (f"(CASE WHEN {d} = 0 THEN CAST(NULL AS BIGINT) ELSE "
            f"CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END"
            f" * ((2BD * abs({n}) + abs({d})) div (2BD * abs({d}))) END)")


def round_ratio_half_up(num_sql: str, den_sql: str, scale_pow10: int = 100) -> Column:
    """``round(num / den, k)`` computed exactly on integers, returned as double.

    Exact integer arithmetic keeps the value independent of floating point
    evaluation order, so the rounding never flips on a binary artefact
    (``round(1.005, 2)`` is 1.01 here).
    """
    units = ratio_units_sql(num_sql, den_sql, scale_pow10)
    return F.expr(f"CAST({units} AS DOUBLE) / {float(scale_pow10)}")


def round_ratio_decimal(num_sql: str, den_sql: str, precision: int,
                        scale_pow10: int = 100) -> Column:
    """Same as :func:`round_ratio_half_up` but typed ``decimal(precision, 2)``."""
    units = ratio_units_sql(num_sql, den_sql, scale_pow10)
    return F.expr(f"CAST(CAST({units} AS DECIMAL({precision}, 0)) * 0.01 "
                  f"AS DECIMAL({precision}, 2))")


def to_date_lit(value) -> Column:
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value).cast("date")
