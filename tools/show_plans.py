"""Print the physical plans (after AQE) of the key operators.

Usage: python tools/show_plans.py [sf_dir]   (default /root/testdata/sf0.01)
Each section prints the operator tree and the lines that matter at scale:
scans (PushedFilters / PartitionFilters / ReadSchema), exchanges, join
strategies, partial aggregation and window group limits.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.functions.dates import filter_dates  # noqa: E402
from tidemark.operators.enrich import enrich  # noqa: E402
from tidemark.operators.merge import upsert_with_changes  # noqa: E402
from tidemark.operators.summary import member_rollup, summary_from_rollup  # noqa: E402
from tidemark.plans import analytics as an  # noqa: E402
from tidemark.plans import pipeline as pl  # noqa: E402
from tidemark.plans.queries import gold_frame, silver_frame  # noqa: E402
from tidemark.plans.scenario import scenario  # noqa: E402
from tidemark.session import get_spark  # noqa: E402
from tidemark.sources.adapters import store_dim  # noqa: E402

KEEP = re.compile(r"(Scan|Exchange|Join|Aggregate|WindowGroupLimit|Window|Sort|Union|"
                  r"PushedFilters|PartitionFilters|ReadSchema|Arguments: \[)")


def show(title: str, df) -> None:
    """Operator tree of the executed (AQE) plan, then the scan details of the
    formatted plan (pushed filters, partition filters, read schema)."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    print(f"\n=== {title}")
    for line in plan.splitlines():
        if KEEP.search(line) and "FileScan" not in line:
            print(line[:170])
        elif "FileScan" in line:
            print(line[:line.index("FileScan")] + "FileScan parquet")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    for line in buf.getvalue().splitlines():
        if line.startswith(("PartitionFilters", "PushedFilters", "ReadSchema")) \
                and not line.endswith(": []"):
            print("    " + line[:170])


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    store = scenario(spark, sf)
    silver = store.read_table(pl.SILVER)
    show("silver: raw -> rules -> latest per transaction", silver_frame(spark, sf))
    show("gold: member summary from raw", gold_frame(spark, sf))
    show("date range on Silver (month partition pruning)",
         filter_dates(silver, "1998-01-01", "1998-06-30"))
    show("store enrichment (checked broadcast)",
         enrich(silver.select("transaction_id", "store_id"), store_dim(spark, sf), "store_id"))
    src = store.stage(silver.limit(500).withColumn("amount", F.col("amount") + 1), "plan-src")
    result, _ = upsert_with_changes(silver, src, ["transaction_id"], pl.SILVER_VERSION)
    show("merge result (target never shuffled)", result)
    keys = store.stage(src.select("member_id").distinct(), "plan-keys")
    rollup = store.read_table(pl.ROLLUP)
    show("affected members from the rollup",
         summary_from_rollup(rollup.join(keys, "member_id", "left_semi"), "2001-12-31"))
    show("rollup refresh of one month",
         member_rollup(store.read_table(pl.SILVER, partitions=["1998-03"])))
    show("channel engagement (window over the grouped result)",
         an.channel_engagement(store.read_table(pl.GOLD)))
    show("tier velocity (history self-join)", an.tier_velocity(store.read_table(pl.HISTORY)))
    show("monthly active (distinct members per month)", an.monthly_active(silver))


if __name__ == "__main__":
    main()
