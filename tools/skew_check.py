"""Show how the core operators behave when one key holds a third of all rows.

Builds a ledger from the events table in which one transaction (and one
loan, and one merchant) owns every third row, reads it as ``--splits`` input
partitions (a large ledger arrives as many files), runs the ledger reports,
checks them against a plain reading, and prints, from Spark's event log, the
largest number of shuffle records any single task read after each shuffle.

Usage: python tools/skew_check.py [sf_dir] [--splits N]
"""

from __future__ import annotations

import argparse
import datetime as dt
import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HOT = ("case when event_id % 3 = 0 then 0 else user_id * 10 + event_id % 10 + 1 end")
# A hot loan: another third of the rows, spread over many distinct transactions.
HOT_LOAN = ("case when event_id % 3 = 1 then 0 else user_id * 10 + event_id % 10 + 1 end")
HOT_LOAN_TXN = ("case when event_id % 3 = 0 then 0 else event_id end")


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.1")
    ap.add_argument("--splits", type=int, default=16)
    args = ap.parse_args()

    from pyspark.sql import functions as F

    from tally.plans import ledger as L
    from tally.session import build_session
    from tally.sources.fixtures import VIEWS

    logs = tempfile.mkdtemp(prefix="tally-skew-")
    spark = build_session("local[8]", shuffle_partitions=16, extra_conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logs,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        # Keep all shuffle partitions so the per-task spread is visible.
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        # AQE splits a join partition once it is 5x the median and over
        # 256 MB (defaults); lowered to 2x / 16 KB so the test size shows it.
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"})
    spark.sparkContext.setLogLevel("ERROR")

    exprs = dict(VIEWS["ledger"].columns)
    exprs["transaction_id"] = exprs["loan_id"] = exprs["merchant_party_id"] = HOT
    events = spark.read.parquet(f"{args.sf_dir}/events.parquet").repartition(args.splits)
    ledger = events.select(*[F.expr(e).alias(c) for c, e in exprs.items()])
    n_rows, n_hot = ledger.count(), ledger.filter("transaction_id = 0").count()
    t = {"ledger": ledger}

    checks = {}
    spark.sparkContext.setJobDescription("latest_per_key")
    got = L.ledger_current_versions(t).count()
    checks["latest_per_key"] = got == ledger.filter("party = 'lender'").select(
        "transaction_id").distinct().count()
    spark.sparkContext.setJobDescription("void_anti_join")
    checks["void_anti_join"] = L.cleared_versions(t).count() > 0
    spark.sparkContext.setJobDescription("early_month_totals")
    totals = L.early_month_cleared_totals(t, dt.date(2024, 1, 20))
    checks["early_month_totals"] = totals.count() > 0
    spark.sparkContext.setJobDescription("merchant_spend")
    party = spark.range(0, 10_000).select(F.col("id").alias("_id"),
                                           F.lit("SHOP").alias("name"))
    checks["merchant_spend"] = L.merchant_spend({**t, "transaction_party": party},
                                                dt.date(2024, 1, 20), brands=()).count() == 1
    spark.sparkContext.setJobDescription("external_ledger")
    from tally.sources.fixtures import fixture_tables
    fx = fixture_tables(spark, args.sf_dir)
    hot_program = fx["loans"].filter("_id = 0").select("program").first()[0]
    by_loan = dict(exprs, transaction_id=HOT_LOAN_TXN, loan_id=HOT_LOAN)
    loan_ledger = events.select(*[F.expr(e).alias(c) for c, e in by_loan.items()])
    n_hot_loan = loan_ledger.filter("loan_id = 0").count()
    report = L.external_ledger({"ledger": loan_ledger, "loans": fx["loans"],
                                "applications": fx["applications"]},
                               program=hot_program, generated_at=dt.datetime(2024, 1, 20))
    report.write.format("noop").mode("overwrite").save()
    checks["external_ledger"] = True
    spark.sparkContext.setJobDescription("done")
    spark.stop()

    path = [p for p in glob.glob(logs + "/**", recursive=True) if os.path.isfile(p)][0]
    job_desc, stage_job, reads = {}, {}, {}
    for line in open(path):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            desc = e.get("Properties", {}).get("spark.job.description")
            for s in e["Stage IDs"]:
                stage_job[s] = desc
        elif e["Event"] == "SparkListenerTaskEnd":
            m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
            recs = m.get("Total Records Read", 0)
            if recs:
                s = e["Stage ID"]
                reads.setdefault(s, []).append(recs)
    print(f"ledger rows {n_rows}, hot transaction rows {n_hot} "
          f"({n_hot / n_rows:.0%}), input splits {args.splits}; external_ledger: hot loan "
          f"rows {n_hot_loan} ({n_hot_loan / n_rows:.0%}) over distinct transactions")
    for s in sorted(reads):
        desc = stage_job.get(s)
        if desc in (None, "done"):
            continue
        r = sorted(reads[s])
        print(f"  {desc:20s} stage {s:3d}: tasks {len(r):3d}, shuffle records read "
              f"max/task {r[-1]:6d}, median/task {r[len(r) // 2]:6d}, total {sum(r):7d}")
    print("results:", checks)


if __name__ == "__main__":
    main()
