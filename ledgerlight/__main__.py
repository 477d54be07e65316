"""Command line: run the medallion pipeline on a folder of raw CSV files.

  python -m ledgerlight pipeline --raw RAW_DIR --out OUT_DIR [--as-of 2024-11-20]
      [--calendar 2023-01-01:2024-12-31] [--history-cut 2024-11-01] [--master local[8]]

On a cluster, submit it with spark-submit; the session's own settings
(master, shuffle partitions, checkpoint folder) are kept.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from ledgerlight.plans import pipeline
from ledgerlight.plans.config import Config
from ledgerlight.session import get_spark, input_bytes, size_shuffles


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerlight")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("pipeline", help="raw CSV -> profile -> silver -> gold -> measures")
    p.add_argument("--raw", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--as-of", type=_date)
    p.add_argument("--calendar", help="START:END of the calendar dimension")
    p.add_argument("--history-cut", type=_date)
    p.add_argument("--master")
    p.add_argument("--cores", type=int, default=0, help="total cores, to size shuffles from the input")
    a = ap.parse_args(argv)

    cfg = Config()
    if a.calendar:
        start, end = (_date(x) for x in a.calendar.split(":"))
        cfg = cfg.with_(calendar_start=start, calendar_end=end, load_date=end, budget_min_year=start.year)
    if a.as_of:
        cfg = cfg.with_(as_of=a.as_of)
    if a.history_cut:
        cfg = cfg.with_(history_cut=a.history_cut)
    spark = get_spark(a.master)
    if a.cores:
        size_shuffles(spark, input_bytes(spark, [a.raw]), a.cores)
    res = pipeline.run(spark, a.raw, a.out, cfg)
    counts = {r["tabela"]: r["total_registros"] for r in res.counts.collect()}
    print(json.dumps({"silver_rows": counts, "outputs": res.paths}, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
