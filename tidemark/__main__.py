"""Command line: run pipeline stages the way a scheduler task would.

  python -m tidemark load-landing --root R --sf-dir D
  python -m tidemark run --root R --as-of 2001-12-31 [--upto 3] [--stage gold]
  python -m tidemark run --root R --as-of 2001-12-31 --rerun-date 1998-06-30
  python -m tidemark log --root R [--table silver]

``--root`` is the shared table folder. Every stage saves its processed
version only after its write, so rerunning a failed command is safe.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from tidemark.functions.exprs import DEFAULT_TIERS, FIXTURE_TIERS
from tidemark.plans import pipeline as pl
from tidemark.session import get_spark
from tidemark.sources.adapters import landing_transactions
from tidemark.sources.tables import TableStore


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tidemark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load-landing")
    ld.add_argument("--root", required=True)
    ld.add_argument("--sf-dir", required=True)
    rn = sub.add_parser("run")
    rn.add_argument("--root", required=True)
    rn.add_argument("--as-of", required=True, type=dt.date.fromisoformat)
    rn.add_argument("--run-ts", type=dt.datetime.fromisoformat)
    rn.add_argument("--upto", type=int, help="last landing commit to ingest")
    rn.add_argument("--bronze-by-month", action="store_true")
    rn.add_argument("--rerun-date", type=dt.date.fromisoformat)
    rn.add_argument("--stage", choices=["bronze", "silver", "gate", "gold", "history"])
    rn.add_argument("--fixture-tiers", action="store_true")
    lg = sub.add_parser("log")
    lg.add_argument("--root", required=True)
    lg.add_argument("--table")
    lg.add_argument("--limit", type=int, default=20)
    for p in (ld, rn, lg):
        p.add_argument("--master")
    args = ap.parse_args(argv)

    spark = get_spark("tidemark-cli", master=args.master)
    store = TableStore(spark, args.root)
    if args.cmd == "load-landing":
        print(json.dumps({"commit": pl.load_landing(store, landing_transactions(spark, args.sf_dir))}))
        return
    if args.cmd == "log":
        store.run_log(args.table, args.limit).show(args.limit, truncate=False)
        return
    cfg = pl.Config(tiers=FIXTURE_TIERS if args.fixture_tiers else DEFAULT_TIERS)
    run_ts = args.run_ts or dt.datetime.combine(args.as_of + dt.timedelta(days=1), dt.time(5))
    stages = {
        "bronze": lambda: pl.run_bronze(store, run_ts, args.upto, args.bronze_by_month),
        "silver": lambda: pl.run_silver(store, run_ts, args.rerun_date),
        "gate": lambda: pl.run_gate(store, cfg),
        "gold": lambda: pl.run_gold(store, args.as_of, run_ts, cfg, args.rerun_date),
        "history": lambda: pl.run_history(store, args.as_of),
    }
    if args.stage:
        out = [stages[args.stage]()]
    else:
        out = pl.run_pipeline(store, args.as_of, run_ts, cfg, args.upto, args.rerun_date,
                              args.bronze_by_month)
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main()
