"""Query catalogue: every report and building block, run over the derived test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
match the oracle SQL of the same name (``tally.plans.oracle``). Money is
output as double, intervals as microseconds, and (``PORTABLE``) dates as ISO
text and NULL-able integers as double, so both engines compare alike whether
results are read as Python objects, pandas frames or Arrow.
Parameters are fixed so that results are reproducible (no wall clock).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.operators.objects import jsonb_text, object_get
from tally.operators.stored import stored_tables, write_by_key
from tally.plans import ledger as L
from tally.plans import loans as N
from tally.plans import remittance as R
from tally.sources.fixtures import (
    ACCOUNTS,
    AGENT_PROGRAM,
    EXCLUDE_AGENTS,
    EXCLUDE_USERS,
    FIXTURE_BRANDS,
    HOME_PROGRAM,
    TEST_AGENTS,
    TEST_PORTFOLIO,
    fixture_tables,
)

# Fixed report parameters for the derived data.
EVENT_AS_OF = dt.date(2024, 1, 20)            # ledger / event reports
BRANDS_AS_OF = dt.date(2024, 3, 1)            # spend per real brand: all card transactions
SNAPSHOT_AS_OF = dt.date(2000, 1, 1)          # snapshot reports
LEDGER_END = dt.datetime(2024, 1, 16)          # end date of the first/last ledger (exclusive)
CUTOFF = dt.date(2000, 1, 1)                  # remittance period cutoff (exclusive)
GENERATED_AT = dt.datetime(2024, 1, 20, 12, 5)
GENERATED_ON = dt.date(2024, 1, 20)
BASE_URL = "https://ops.example.com/borrowers/?id="
SERVICING_FEE_ACCOUNT = "earned_servicing_fee"
# The user ids asked for by the report's id filter: a list of 400.
REPORT_USERS = tuple(range(1, 1200, 3))
# Every optional report filter except ``user_id``, which has a query of its own.
FILTERED_REPORT_ARGS = dict(
    state="S3", amount_min=1_000_000, amount_max=30_000_000,
    start=dt.datetime(1995, 6, 1), end=dt.datetime(2001, 6, 30),
    status="EXPIRED", reapplication="REAPP", test_account="false", program=AGENT_PROGRAM,
)

Query = Callable[[SparkSession, str], DataFrame]
_LEDGER_KEEP = ("transaction_id", "event_id", "loan_id", "method", "status", "created_at")


def _t(spark: SparkSession, sf_dir: str):
    return fixture_tables(spark, sf_dir)


def ledger_current_versions(spark, sf_dir):
    return L.ledger_current_versions(_t(spark, sf_dir))


def ledger_first_versions(spark, sf_dir):
    return L.ledger_first_versions(_t(spark, sf_dir))


def ledger_unvoided_latest(spark, sf_dir):
    return L.cleared_versions(_t(spark, sf_dir), "created_local").select(*_LEDGER_KEEP)


def ledger_unvoided_earliest(spark, sf_dir):
    return L.cleared_versions(_t(spark, sf_dir), "effective_only").select(*_LEDGER_KEEP)


def ledger_unvoided_latest_stream(spark, sf_dir):
    """Same result as ``ledger_unvoided_latest``, kept by a streaming aggregate
    over the events files (run to completion with an available-now trigger)."""
    from tally.streaming.ledger import ledger_stream_from_events, run_settled_stream
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    stream = ledger_stream_from_events(spark, sf_dir, schema)
    return run_settled_stream(spark, stream, "created_local").select(*_LEDGER_KEEP)


def ledger_unvoided_latest_stored(spark, sf_dir):
    """Same result as ``ledger_unvoided_latest``, from a ledger stored by transaction."""
    name = f"ledger_{uuid.uuid4().hex}"
    write_by_key(_t(spark, sf_dir)["ledger"], name, "transaction_id", buckets=16)
    return L.cleared_versions(stored_tables(spark, "ledger", name), "created_local").select(*_LEDGER_KEEP)


def ledger_latest_then_filter(spark, sf_dir):
    return L.latest_then_filter(_t(spark, sf_dir)).select(*_LEDGER_KEEP)


def _external(rule: str) -> Query:
    def run(spark, sf_dir):
        return L.external_ledger(_t(spark, sf_dir), program=AGENT_PROGRAM,
                                 generated_at=GENERATED_AT, date_rule=rule,
                                 exclude_agents=EXCLUDE_AGENTS)
    run.__name__ = f"external_ledger_{rule}"
    return run


def external_ledger_first_last(spark, sf_dir):
    return L.external_ledger_first_last(_t(spark, sf_dir), program=AGENT_PROGRAM,
                                        generated_at=GENERATED_AT)


def external_ledger_first_last_until(spark, sf_dir):
    return L.external_ledger_first_last(_t(spark, sf_dir), program=AGENT_PROGRAM,
                                        generated_at=GENERATED_AT, end_date=LEDGER_END)


def early_month_totals(spark, sf_dir):
    return L.early_month_cleared_totals(_t(spark, sf_dir), EVENT_AS_OF)


def merchant_spend(spark, sf_dir):
    return L.merchant_spend(_t(spark, sf_dir), EVENT_AS_OF, brands=FIXTURE_BRANDS)


def merchant_spend_brands(spark, sf_dir):
    """Spend under the report's own brand patterns."""
    t = _t(spark, sf_dir)
    return L.merchant_spend({"ledger": t["ledger"], "transaction_party": t["branded_party"]}, BRANDS_AS_OF)


def acceleration_events(spark, sf_dir):
    return N.acceleration_events(_t(spark, sf_dir), EVENT_AS_OF)


def upsizes(spark, sf_dir):
    return N.upsizes(_t(spark, sf_dir)).drop("time_to_upsize")


def loan_snapshots_current(spark, sf_dir):
    return N.loan_snapshots_current(_t(spark, sf_dir), SNAPSHOT_AS_OF)


def loan_snapshots_collections(spark, sf_dir):
    return N.loan_snapshots_collections(_t(spark, sf_dir), SNAPSHOT_AS_OF)


def reapplications(spark, sf_dir):
    return N.reapplications(_t(spark, sf_dir))


def reapplications_expired(spark, sf_dir):
    return N.reapplications_expired(_t(spark, sf_dir))


def first_expired_authorization(spark, sf_dir):
    return N.first_expired_authorization(_t(spark, sf_dir))


def reapplication_report(spark, sf_dir):
    return N.reapplication_report(_t(spark, sf_dir), test_agents=TEST_AGENTS,
                                  exclude_users=EXCLUDE_USERS)


def reapplication_report_filtered(spark, sf_dir):
    return N.reapplication_report(_t(spark, sf_dir), test_agents=TEST_AGENTS,
                                  exclude_users=EXCLUDE_USERS, **FILTERED_REPORT_ARGS)


def reapplication_report_strict(spark, sf_dir):
    return N.reapplication_report(_t(spark, sf_dir), test_agents=TEST_AGENTS,
                                  exclude_users=EXCLUDE_USERS, strict_address=True)


def reapplication_report_users(spark, sf_dir):
    return N.reapplication_report(_t(spark, sf_dir), test_agents=TEST_AGENTS, user_id=REPORT_USERS)


def most_recent_snapshot(spark, sf_dir):
    t = _t(spark, sf_dir)
    loans = R.target_loans(t, program=HOME_PROGRAM, exclude_portfolio=TEST_PORTFOLIO)
    return R.most_recent_snapshot(t, loans, CUTOFF).select(
        "loan_id", "status", "created_at", "line", "part", "disbursed_cents_cleared",
        F.col("credit_usage_dollars").cast("double").alias("credit_usage_dollars"))


def investor_tape_totals(spark, sf_dir):
    return R.previous_investor_tape_totals(_t(spark, sf_dir), CUTOFF).select(
        "loan_id", F.col("principal").cast("double").alias("principal"),
        F.col("refunds").cast("double").alias("refunds"))


def new_purchasable(spark, sf_dir):
    return R.new_purchasable(_t(spark, sf_dir), cutoff=CUTOFF, program=HOME_PROGRAM,
                             exclude_portfolio=TEST_PORTFOLIO)


def nsf_repayments(spark, sf_dir):
    return R.nsf_repayments(_t(spark, sf_dir))


def entry_impacts(spark, sf_dir):
    return R.entry_impacts(_t(spark, sf_dir), CUTOFF).withColumn(
        "normalized_dollars", F.col("normalized_dollars").cast("double"))


def loan_balances(spark, sf_dir):
    bal = R.loan_balances(_t(spark, sf_dir), CUTOFF, ACCOUNTS)
    return bal.select("loan_id", *[F.col(a).cast("double").alias(a) for a in ACCOUNTS])


def loan_balance_objects(spark, sf_dir):
    """The balances of every loan as one object, and what is read from it."""
    rows = R.loan_balance_objects(_t(spark, sf_dir), CUTOFF)
    refunds = F.coalesce(object_get("balances", R.INVESTOR_REFUNDS).cast("decimal(38,2)"), F.lit(0))
    return rows.select("loan_id", jsonb_text(rows, "balances").alias("balances"),
                       F.size("balances").cast("long").alias("n_accounts"), refunds.cast("double").alias("refunds"))


def account_totals(spark, sf_dir):
    """Loans and dollars per account, read from the loans' objects by the names of the accounts table."""
    t = _t(spark, sf_dir)
    names = t["ledger_accounts"].select(F.col("name").alias("account"))
    rows = R.loan_balance_objects(t, CUTOFF).select(F.explode("balances").alias("account", "dollars"))
    return rows.groupBy("account").agg(
        F.count("*").alias("n_loans"), F.sum("dollars").cast("double").alias("dollars")).join(names, "account")


def investor_refunds(spark, sf_dir):
    return R.investor_refunds(_t(spark, sf_dir), CUTOFF)


def remittance_report(spark, sf_dir):
    return R.remittance_report(_t(spark, sf_dir), cutoff=CUTOFF, generated_on=GENERATED_ON,
                               program=HOME_PROGRAM, exclude_portfolio=TEST_PORTFOLIO,
                               base_url=BASE_URL, servicing_fee_account=SERVICING_FEE_ACCOUNT)


# Columns re-typed on both sides so that every comparison path (Python
# objects, pandas, Arrow) sees the same values: dates as ISO text (pandas
# would turn DuckDB dates into timestamps) and integer columns that hold
# NULLs as double (pandas turns Spark's into float, DuckDB's into Int64).
PORTABLE: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "ledger_current_versions": (("effective_date",), ("debit",)),
    "acceleration_events": (("created_at",), ()),
    "upsizes": (("lpa_created_at",), ("time_to_upsize_micros",)),
    "nsf_repayments": (("effective_date",), ()),
    "remittance_report": (("repaid_date",), ("days_past_due",)),
}


def _portable(name: str, fn: Query) -> Query:
    text, double = PORTABLE[name]

    def run(spark, sf_dir):
        df = fn(spark, sf_dir)
        return df.select(*[F.col(c).cast("string").alias(c) if c in text
                           else F.col(c).cast("double").alias(c) if c in double
                           else F.col(c) for c in df.columns])
    run.__name__ = fn.__name__
    return run


_RAW_QUERIES: dict[str, Query] = {
    "ledger_current_versions": ledger_current_versions,
    "ledger_first_versions": ledger_first_versions,
    "ledger_unvoided_latest": ledger_unvoided_latest,
    "ledger_unvoided_earliest": ledger_unvoided_earliest,
    "ledger_unvoided_latest_stream": ledger_unvoided_latest_stream,
    "ledger_unvoided_latest_stored": ledger_unvoided_latest_stored,
    "ledger_latest_then_filter": ledger_latest_then_filter,
    "external_ledger_created_local": _external("created_local"),
    "external_ledger_effective": _external("effective"),
    "external_ledger_effective_only": _external("effective_only"),
    "external_ledger_first_last": external_ledger_first_last,
    "external_ledger_first_last_until": external_ledger_first_last_until,
    "early_month_totals": early_month_totals,
    "merchant_spend": merchant_spend,
    "merchant_spend_brands": merchant_spend_brands,
    "acceleration_events": acceleration_events,
    "upsizes": upsizes,
    "loan_snapshots_current": loan_snapshots_current,
    "loan_snapshots_collections": loan_snapshots_collections,
    "reapplications": reapplications,
    "reapplications_expired": reapplications_expired,
    "first_expired_authorization": first_expired_authorization,
    "reapplication_report": reapplication_report,
    "reapplication_report_filtered": reapplication_report_filtered,
    "reapplication_report_strict": reapplication_report_strict,
    "reapplication_report_users": reapplication_report_users,
    "most_recent_snapshot": most_recent_snapshot,
    "investor_tape_totals": investor_tape_totals,
    "new_purchasable": new_purchasable,
    "nsf_repayments": nsf_repayments,
    "entry_impacts": entry_impacts,
    "loan_balances": loan_balances,
    "loan_balance_objects": loan_balance_objects,
    "account_totals": account_totals,
    "investor_refunds": investor_refunds,
    "remittance_report": remittance_report,
}

QUERIES: dict[str, Query] = {name: (_portable(name, fn) if name in PORTABLE else fn)
                             for name, fn in _RAW_QUERIES.items()}
