"""Row rules with quarantine, expectation report and the publication gate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import ratio_units_sql

# ---- fixed values (must stay as given) ------------------------------------
# Silver entry rules: a row passes when every condition is TRUE.
SILVER_ROW_RULES = (
    ("amount_positive", "amount > 0"),
    ("member_present", "member_id IS NOT NULL"),
    ("date_present", "transaction_date IS NOT NULL"),
)
DQ_REASON = "failed_dq_check"
VALID_CHANNELS = ("POS", "mobile_app", "partner_api")
VALID_TIERS = ("bronze", "silver", "gold", "platinum")
# ---------------------------------------------------------------------------


def flag_rules(df: DataFrame, rules=SILVER_ROW_RULES, out: str = "failed_rules") -> DataFrame:
    """Add an array with the names of the rules a row fails.

    A rule whose condition is NULL (e.g. ``amount > 0`` on a NULL amount)
    counts as failed: three-valued logic must not let a row fall out of both
    halves.
    """
    names = [F.when(~F.coalesce(F.expr(cond), F.lit(False)), F.lit(name))
             for name, cond in rules]
    return df.withColumn(out, F.filter(F.array(*names), lambda x: x.isNotNull()))


def split_rules(df: DataFrame, rules=SILVER_ROW_RULES, reason: str = DQ_REASON,
                quarantine_ts=None) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine): clean has the input columns, quarantine adds
    ``quarantine_reason``, ``failed_rules`` and ``quarantine_ts``.

    Both halves derive from the same flagged plan; callers that act on both
    should persist or stage the flagged input once.
    """
    flagged = flag_rules(df, rules)
    ok = F.size("failed_rules") == 0
    clean = flagged.filter(ok).drop("failed_rules")
    ts = F.current_timestamp() if quarantine_ts is None else F.lit(quarantine_ts).cast("timestamp")
    quarantine = (flagged.filter(~ok)
                  .withColumn("quarantine_reason", F.lit(reason))
                  .withColumn("quarantine_ts", ts))
    return clean, quarantine


# ---- expectations ----------------------------------------------------------

@dataclass(frozen=True)
class Expectation:
    name: str
    kind: str                      # not_null | between | in_set | row_count | unique
    column: str | None = None
    severity: str = "critical"     # critical | warning
    min_value: float | None = None
    max_value: float | None = None
    values: tuple = field(default_factory=tuple)
    mostly: float = 1.0


# ---- fixed values (must stay as given): limits of the suite ------------------
MIN_AMOUNT, TYPICAL_AMOUNT, TYPICAL_SHARE, MIN_ROWS = 0.01, (5.0, 2000.0), 0.99, 100
# Inspection sample: at most this share of the rows, at most so many, this seed.
SAMPLE_SHARE, SAMPLE_ROWS, SAMPLE_SEED = 0.01, 500_000, 42
# ------------------------------------------------------------------------------


def default_suite(amount_range=TYPICAL_AMOUNT, min_rows: int = MIN_ROWS) -> list[Expectation]:
    """The Silver -> Gold suite. Every check has an explicit severity."""
    lo, hi = amount_range
    return [
        Expectation("not_null_transaction_id", "not_null", "transaction_id"),
        Expectation("not_null_member_id", "not_null", "member_id"),
        Expectation("not_null_transaction_date", "not_null", "transaction_date"),
        Expectation("amount_min", "between", "amount", min_value=MIN_AMOUNT),
        Expectation("channel_in_set", "in_set", "channel", values=VALID_CHANNELS),
        Expectation("tier_in_set", "in_set", "tier", values=VALID_TIERS),
        Expectation("amount_typical_range", "between", "amount", "warning",
                    min_value=lo, max_value=hi, mostly=TYPICAL_SHARE),
        Expectation("row_count_min", "row_count", None, "warning", min_value=min_rows),
        Expectation("unique_transaction_id", "unique", "transaction_id"),
    ]


def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _measure_exprs(e: Expectation) -> tuple[str, str]:
    """(element_count, unexpected_count) SQL aggregates for one expectation."""
    c = f"`{e.column}`" if e.column else None
    if e.kind == "not_null":
        return "count(1)", f"count_if({c} IS NULL)"
    if e.kind == "between":
        conds = []
        if e.min_value is not None:
            conds.append(f"{c} < {e.min_value!r}")
        if e.max_value is not None:
            conds.append(f"{c} > {e.max_value!r}")
        return f"count({c})", f"count_if({' OR '.join(conds)})"
    if e.kind == "in_set":
        vals = ", ".join(_sql_lit(v) for v in e.values)
        return f"count({c})", f"count_if(NOT ({c} IN ({vals})))"
    if e.kind == "row_count":
        return "count(1)", "CAST(0 AS BIGINT)"
    raise ValueError(e.kind)


def expectation_report(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """One row per expectation: expectation, column_name, severity,
    element_count, unexpected_count, unexpected_pct, success.

    All row-level expectations are evaluated in one aggregate pass over the
    full table (no sampling); key uniqueness adds one grouped pass. The
    result has one row per expectation and never holds table data.
    """
    row_level = [e for e in suite if e.kind != "unique"]
    one = df.agg(*measures(row_level)) if row_level else None
    return judged(suite, one, lambda e: df.groupBy(e.column).count())


def measures(row_level: list[Expectation]) -> list:
    """Aggregates n0, u0, n1, u1, ...: elements and unexpected ones of each row-level expectation. They
    are counts, so those of parts of a table add up to those of the whole."""
    aggs = []
    for i, e in enumerate(row_level):
        n, u = _measure_exprs(e)
        aggs += [F.expr(n).alias(f"n{i}"), F.expr(u).alias(f"u{i}")]
    return aggs


def judged(suite: list[Expectation], one: DataFrame | None, key_counts) -> DataFrame:
    """The report of ``expectation_report`` from its counts: ``one`` row of ``measures``, and
    ``key_counts(e)``, the rows per key (columns: key, count) of a uniqueness expectation."""
    row_level = [e for e in suite if e.kind != "unique"]
    parts = []
    if row_level:
        structs = []
        for i, e in enumerate(row_level):
            mostly_bp = int(round(e.mostly * 10000))
            if e.kind == "row_count":
                ok = F.col(f"n{i}") >= F.lit(int(e.min_value))
                if e.max_value is not None:
                    ok = ok & (F.col(f"n{i}") <= F.lit(int(e.max_value)))
            else:
                ok = ((F.col(f"n{i}") - F.col(f"u{i}")) * 10000
                      >= F.col(f"n{i}") * F.lit(mostly_bp))
            structs.append(F.struct(
                F.lit(e.name).alias("expectation"),
                F.lit(e.column).cast("string").alias("column_name"),
                F.lit(e.severity).alias("severity"),
                F.col(f"n{i}").cast("long").alias("element_count"),
                F.col(f"u{i}").cast("long").alias("unexpected_count"),
                ok.alias("success")))
        parts.append(one.select(F.explode(F.array(*structs)).alias("r")).select("r.*"))
    for e in (e for e in suite if e.kind == "unique"):
        # one grouped pass gives both the non-null count and the rows whose
        # key repeats; partial aggregation keeps a hot key map-side.
        g = key_counts(e)
        nn = F.col(e.column).isNotNull()
        parts.append(g.agg(
            F.coalesce(F.sum(F.when(nn, F.col("count"))), F.lit(0)).cast("long")
            .alias("element_count"),
            F.coalesce(F.sum(F.when(nn & (F.col("count") > 1), F.col("count"))), F.lit(0))
            .cast("long").alias("unexpected_count"))
            .select(F.lit(e.name).alias("expectation"),
                    F.lit(e.column).alias("column_name"),
                    F.lit(e.severity).alias("severity"),
                    "element_count", "unexpected_count",
                    (F.col("unexpected_count") == 0).alias("success")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    pct = ratio_units_sql("unexpected_count * 100", "element_count", 10000)
    return out.withColumn("unexpected_pct", F.expr(f"CAST({pct} AS DOUBLE) / 10000.0")).select(
        "expectation", "column_name", "severity", "element_count", "unexpected_count",
        "unexpected_pct", "success")


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their count (GROUP BY ... HAVING)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


class GateFailed(RuntimeError):
    pass


def gate(report: DataFrame) -> list[dict]:
    """Raise on any failed critical expectation; return the failed rows.

    The report has one row per expectation, so collecting it is bounded.
    """
    failed = [r.asDict() for r in report.filter(~F.col("success")).collect()]
    critical = [r for r in failed if r["severity"] == "critical"]
    if critical:
        names = ", ".join(r["expectation"] for r in critical)
        raise GateFailed(f"{len(critical)} critical expectation(s) failed: {names}")
    return failed


def sample_fraction(total_rows: int, cap_rows: int = SAMPLE_ROWS, max_fraction: float = SAMPLE_SHARE) -> float:
    """min(1 %, cap / n) -- the sampled share used for inspection."""
    if total_rows <= 0:
        return 0.0
    return min(max_fraction, cap_rows / total_rows)


def dq_sample(df: DataFrame, total_rows: int, seed: int = SAMPLE_SEED) -> DataFrame:
    """Seeded Bernoulli sample for eyeballing; the gate itself scans everything."""
    return df.sample(fraction=sample_fraction(total_rows), seed=seed)


def sample_by_key(df: DataFrame, key: str, seed: int = SAMPLE_SEED, cap_rows: int = SAMPLE_ROWS, max_fraction: float = SAMPLE_SHARE) -> DataFrame:
    """Rows whose hashed key is below min(max_fraction, cap_rows / rows): the sample depends on the keys
    alone, not on how rows are partitioned or ordered, and a key is in with all of its rows. Rows without a
    key are never in. An empty table gives an empty sample."""
    share = F.least(F.lit(int(max_fraction * 2 ** 32)), F.lit(cap_rows * 2 ** 32) / F.count("*"))
    # one row, so the join with it is a broadcast of a number
    least = df.agg(F.lpad(F.lower(F.hex(F.floor(share).cast("long"))), 8, "0").alias("_upto"))
    hashed = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), 1, 8)
    return df.join(F.broadcast(least), hashed < least["_upto"]).select(*[df[c] for c in df.columns])
