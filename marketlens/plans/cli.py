"""Command line: run the batch plans over landed files, or print the summary.

    python -m marketlens.plans.cli update --warehouse W --postings P --catalog C \\
        [--postings-second P2] [--operations O] [--accruals R] [--campaigns K] [--daily D] [--attribution A] \\
        [--from 2025-10-01] [--to 2025-12-12] [--lookback-days 30] [--now "2025-12-12 10:00:00"] \\
        [--skip finance,daily] [--tolerant]

    python -m marketlens.plans.cli summary --warehouse W [--from D] [--to D] [--campaign C] \\
        [--first-only | --repeat-only] [--flavor F] [--grams G]

``update`` reads the landed JSON pages (and the catalog CSV), runs K04 over
the range ``[from, to]`` (``to`` inclusive; default: the last
``--lookback-days`` days up to ``--to``), and prints the step log with its
counts (matched, unmatched, skipped). ``--postings-second`` is the second
logistics scheme. ``summary`` prints the five dashboard metrics as one JSON
object; ``retention``, ``cohorts`` and ``weekly`` print one object per row.
``--to`` is inclusive everywhere.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys


def _session():
    from marketlens.session import get_session
    return get_session()


def cmd_update(a) -> int:
    from marketlens.operators.quality import lookback_range
    from marketlens.plans import batch
    from marketlens.sources import json_docs, tables
    spark = _session()
    to = dt.date.fromisoformat(a.to) if a.to else dt.date.today()
    frm = dt.date.fromisoformat(a.date_from) if a.date_from else lookback_range(to, a.lookback_days)[0]
    end = (to + dt.timedelta(days=1)).isoformat()  # half-open end for the batch plans
    now = a.now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ", timespec="seconds")
    schemes = {"first": a.postings} | ({"second": a.postings_second} if a.postings_second else {})
    inputs = {"postings": json_docs.read_postings_by_scheme(spark, schemes)}
    if a.accruals:
        from marketlens import vocab
        from marketlens.sources import accruals
        inputs["accruals"] = accruals.read_accruals(spark, a.accruals, vocab.ACCRUAL_LABELS)
    if a.operations:
        inputs["operations"] = json_docs.read_finance_ops(spark, a.operations)
    if a.campaigns:
        inputs["campaigns"] = json_docs.read_campaigns(spark, a.campaigns)
    if a.daily:
        inputs["daily"] = json_docs.read_campaign_daily(spark, a.daily)
    if a.attribution:
        inputs["attribution"] = json_docs.read_attribution(spark, a.attribution)
    skip = {s for s in (a.skip or "").split(",") if s}
    wh = Store(spark, a.warehouse)
    _, log = batch.batch_all(wh, inputs, frm.isoformat(), end, now, tables.read_catalog(spark, a.catalog),
                             enable={k: k not in skip for k in ("finance", "accruals", "campaigns", "daily", "attribution")},
                             strict=not a.tolerant)
    for r in log.collect():  # one row per step
        print(json.dumps(r.asDict()))
    return 0


def _filtered(a, wh):
    from marketlens.operators import metrics as mx
    first = True if a.first_only else False if a.repeat_only else None
    end = f"{a.to} 23:59:59.999999" if a.to and len(a.to) == 10 else a.to   # the whole last day
    flt = mx.OrderFilter(a.date_from, end, a.campaign, first, a.flavor, a.grams)
    return mx.filter_orders(wh.read("orders"), flt, wh.read("order_items"), wh.read("products"))


def cmd_report(a) -> int:
    from marketlens.operators import metrics as mx
    from marketlens.sources.store import Store
    wh = Store(_session(), a.warehouse)
    made = {"summary": lambda: mx.summary(_filtered(a, wh)), "retention": lambda: mx.retention_distribution(_filtered(a, wh)),
            "cohorts": lambda: mx.cohort_by_month(wh.read("customers")), "weekly": lambda: mx.weekly_trend(_filtered(a, wh))}[a.cmd]()
    from pyspark.sql import functions as F
    for row in made.select(F.to_json(F.struct("*")).alias("j")).toLocalIterator():   # reports of a few rows
        print(row["j"])
    return 0


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="marketlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    u = sub.add_parser("update")
    u.add_argument("--warehouse", required=True)
    u.add_argument("--postings", required=True)
    u.add_argument("--catalog", required=True)
    u.add_argument("--postings-second")
    for opt in ("operations", "accruals", "campaigns", "daily", "attribution"):
        u.add_argument(f"--{opt}")
    u.add_argument("--from", dest="date_from")
    u.add_argument("--to")
    u.add_argument("--lookback-days", type=int, default=30)
    u.add_argument("--now")
    u.add_argument("--skip")
    u.add_argument("--tolerant", action="store_true", help="log optional step failures instead of raising")
    for name in ("summary", "retention", "cohorts", "weekly"):
        s = sub.add_parser(name)
        s.add_argument("--warehouse", required=True)
        s.add_argument("--from", dest="date_from")
        s.add_argument("--to")
        s.add_argument("--campaign")
        g = s.add_mutually_exclusive_group()
        g.add_argument("--first-only", action="store_true")
        g.add_argument("--repeat-only", action="store_true")
        s.add_argument("--flavor")
        s.add_argument("--grams", type=int)
    a = ap.parse_args(argv)
    return cmd_update(a) if a.cmd == "update" else cmd_report(a)


if __name__ == "__main__":
    sys.exit(main())
