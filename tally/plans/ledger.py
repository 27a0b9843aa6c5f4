"""Ledger reports: current versions, external ledger, early-month totals, merchant spend.

The ledger is append-only and versioned: a transaction has many rows and the
newest one is its current state. Every report here is a composition of
``latest_per_key`` (one shuffle by ``transaction_id``), an anti-join against
voids on the same key, and ordinary joins and aggregates. On a ledger stored by
transaction (``operators.stored``) these steps need no shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions.money import clamp0, dollars
from tally.functions.text import brand_key, pg_concat
from tally.functions.time import (
    ny_date_between,
    ny_midnight_utc,
    ntz_lit,
    pg_to_char,
    report_timestamp_text,
    to_ny_wall,
)
from tally.operators.latest import (
    first_value_per_key,
    latest_per_key,
    newest,
    oldest,
    tiebreak_columns,
)
from tally.operators.partitions import prune_months
from tally.operators.stored import by_part
from tally.operators.voids import void_cutoffs, without_earlier_than

Tables = Mapping[str, DataFrame]

LEDGER_TIEBREAK = ("event_id",)

# Merchant brand labels and their LIKE patterns on the
# upper-cased merchant name, in match order (first match wins).
BRANDS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("HOMEDEPOT", ("%HOMEDEPOT%", "%THE HOME DEPOT%")),
    ("PAYPAL", ("%PAYPAL%",)),
    ("LOWES", ("%LOWE%",)),
    ("AMAZON", ("%AMAZON%", "%AMZN%")),
    ("PODS", ("%PODS %",)),
    ("WAYFAIR", ("%WAYFAIR%",)),
    ("WESTELM", ("%WESTELM%",)),
    ("TARGET", ("%TARGET%",)),
    ("ACE HARDWARE", ("%ACE HARDWARE%",)),
)

DATE_RULES = ("created_local", "effective", "effective_only")

def _newest_first(df: DataFrame, tiebreak: Sequence[str],
                  ts: str = "created_at") -> list[Column]:
    """Postgres ``ts DESC`` then the tie-break (or, if the table lacks those
    columns, every other column) so the pick is deterministic."""
    cols = tiebreak_columns(df, tiebreak, exclude=["transaction_id", ts])
    return [newest(ts), *[newest(c) for c in cols]]


def lender_rows(t: Tables, party: str = "lender") -> DataFrame:
    return t["ledger"].filter(F.col("party") == F.lit(party))


def settled_filter() -> Column:
    """Direct and check rows count once cleared; card rows unless voided."""
    status, method = F.col("status"), F.col("method")
    return (((status == "cleared") & method.isin("direct", "check"))
            | ((status != "voided") & (method == "card")))


def transaction_label(method: Column, is_ach: Column) -> Column:
    """Accounting transaction type; NULL for any other method."""
    return (F.when((method == "direct") & (is_ach == F.lit(False)), "CASH_ADVANCE")
             .when(method == "direct", "ACH_LOAN")
             .when(method == "card", "CARD")
             .when(method == "check", "CHECK"))


@by_part("ledger")
def cleared_versions(t: Tables, date_rule: str = "created_local",
                     tiebreak: Sequence[str] = LEDGER_TIEBREAK) -> DataFrame:
    """Newest countable version per transaction that no later void cancels.

    ``created_local`` / ``effective``: settled rows (``settled_filter``),
    cancelled by the *latest* void. ``effective_only``: cleared rows only,
    cancelled by the *earliest* void. The status filter runs before the
    newest-version pick, as the reports write it.

    The newest pick runs before the anti-join: if the newest row is earlier
    than the void, so is every older row, so the result is the same, and the
    join then sees at most one row per transaction on each side (no skew),
    with both sides already partitioned by ``transaction_id``.
    """
    if date_rule not in DATE_RULES:
        raise ValueError(f"date_rule must be one of {DATE_RULES}")
    lender = lender_rows(t)
    voids = lender.filter(F.col("status") == "voided")
    if date_rule == "effective_only":
        rows = lender.filter(F.col("status") == "cleared")
        cutoffs = void_cutoffs(voids, "transaction_id", "created_at", latest=False)
    else:
        rows = lender.filter(settled_filter())
        cutoffs = void_cutoffs(voids, "transaction_id", "created_at", latest=True)
    current = latest_per_key(rows, ["transaction_id"], _newest_first(rows, tiebreak))
    return without_earlier_than(current, cutoffs, "transaction_id", "created_at")


@by_part("ledger")
def latest_then_filter(t: Tables, tiebreak: Sequence[str] = LEDGER_TIEBREAK) -> DataFrame:
    """Newest lender version per transaction, kept only if that version is settled.

    The opposite order to ``cleared_versions``: a transaction whose newest
    row is voided disappears even if an older row was cleared.
    """
    lender = lender_rows(t)
    current = latest_per_key(lender, ["transaction_id"], _newest_first(lender, tiebreak))
    return current.filter(settled_filter())


@by_part("ledger")
def ledger_current_versions(t: Tables, transaction_ids: Sequence | None = None,
                            loan_ids: Sequence | None = None, party: str = "lender",
                            tiebreak: Sequence[str] = LEDGER_TIEBREAK) -> DataFrame:
    """Full newest row per transaction of one party, optionally for some ids."""
    rows = lender_rows(t, party)
    if transaction_ids is not None:
        rows = rows.filter(F.col("transaction_id").isin(list(transaction_ids)))
    if loan_ids is not None:
        rows = rows.filter(F.col("loan_id").isin(list(loan_ids)))
    return latest_per_key(rows, ["transaction_id"], _newest_first(rows, tiebreak))


@by_part("ledger")
def ledger_first_versions(t: Tables, party: str = "lender") -> DataFrame:
    """Creation time of the first version of each transaction."""
    return first_value_per_key(lender_rows(t, party).select("transaction_id", "created_at"),
                               ["transaction_id"], "created_at", earliest=True)


def loan_applications(t: Tables, program: str,
                      exclude_agents: Sequence[str] = ()) -> DataFrame:
    """Live loans of one program joined to their applications (one row per loan)."""
    loans, apps = t["loans"], t["applications"]
    joined = apps.join(loans, apps["_id"] == loans["loan_application_id"], "inner")
    cond = (loans["_id"].isNotNull() & (loans["status"] != "EXPIRED")
            & (loans["program"] == F.lit(program)))
    if exclude_agents:
        cond = cond & ~apps["agent_master_id"].isin(list(exclude_agents))
    return joined.filter(cond).select(
        apps["_id"].alias("id"),
        apps["listing_address_line1"].alias("listing_address_line_1"),
        apps["listing_address_line2"].alias("listing_address_line_2"),
        apps["listing_city"], apps["listing_state"], apps["listing_zip"],
        apps["agent_master_id"].alias("agent_id"),
        loans["_id"].alias("loan_id"),
        loans["is_ach_only"].alias("is_ach"),
        loans["slug"].alias("key"),
        loans["principal"].alias("loan_principal"),
        pg_concat(apps["first_name"], " ", apps["last_name"]).alias("applicant"),
        apps["program"].alias("program"),
    )


def _posting_date(date_rule: str) -> Column:
    method, post = F.col("method"), F.col("external_post_date")
    manual_post = method.isin("direct", "check") & post.isNotNull()
    if date_rule == "created_local":
        value = (F.when(manual_post, to_ny_wall(post))
                  .when(method == "direct", to_ny_wall("value_date"))
                  .otherwise(to_ny_wall("created_at")))
    elif date_rule == "effective":
        value = (F.when(manual_post, post)
                  .when(method == "direct", F.col("value_date"))
                  .otherwise(F.col("effective_date").cast("timestamp_ntz")))
    else:
        value = F.col("effective_date")
    return pg_to_char(value, "MM/DD/YYYY")


def external_ledger(t: Tables, *, program: str, generated_at: dt.datetime,
                    date_rule: str = "created_local", exclude_agents: Sequence[str] = (),
                    legacy_format: bool = False,
                    tiebreak: Sequence[str] = LEDGER_TIEBREAK) -> DataFrame:
    """External ledger: one row per live transaction of a loan in ``program``.

    ``date_rule`` picks the posting date: ``created_local`` (manual post date
    for direct/check, else value date for direct, else creation, all as New
    York dates), ``effective`` (same, effective date as fallback, no time
    zone) or ``effective_only`` (effective date, cleared rows only, earliest
    void).
    """
    ledger = cleared_versions(t, date_rule, tiebreak).select(
        "transaction_id", "loan_id", "method",
        _posting_date(date_rule).alias("date"),
        F.col("transaction_type").alias("ledger_item_type"),
        dollars("debit").alias("debit"),
        dollars("credit").alias("credit"),
    )
    apps = loan_applications(t, program, exclude_agents)
    joined = ledger.join(apps, "loan_id", "inner")
    return joined.select(
        "transaction_id", "date", "ledger_item_type",
        transaction_label(F.col("method"), F.col("is_ach")).alias("transaction_type"),
        "debit", "credit", "key", "loan_principal", "is_ach", "agent_id", "applicant",
        "listing_address_line_1", "listing_address_line_2", "listing_city",
        "listing_state", "listing_zip",
        report_timestamp_text(generated_at, legacy_format).alias("report_generated_at"),
    )


@by_part("ledger")
def _first_and_last(t: Tables, tiebreak: Sequence[str]) -> DataFrame:
    """Newest settled versions with the creation time of their transaction's first one.

    Both sides are partitioned by transaction id (window and aggregate), so
    their join needs no shuffle of its own.
    """
    lender = lender_rows(t)
    first = (first_value_per_key(lender.select("transaction_id", "created_at"),
                                 ["transaction_id"], "created_at", earliest=True)
             .withColumnRenamed("created_at", "first_created_at"))
    updated = (latest_per_key(lender, ["transaction_id"], _newest_first(lender, tiebreak))
               .filter(settled_filter()))
    return updated.join(first, "transaction_id", "inner")


def external_ledger_first_last(t: Tables, *, program: str, generated_at: dt.datetime,
                               end_date: dt.datetime | None = None,
                               loan_id=None, legacy_format: bool = False,
                               tiebreak: Sequence[str] = LEDGER_TIEBREAK) -> DataFrame:
    """Older external ledger: newest version, dated by the first version.

    No void logic: the newest version must itself be settled. Date: manual
    post date for direct rows, else value date for direct, else the creation
    time of the transaction's first version. Sorted by that first creation
    time, which is not an output column. ``end_date`` (exclusive) and
    ``loan_id`` are the report's optional filters.
    """
    # Loans with their application, live loans only: the source joins the
    # application side and the live-loan side separately on the same loan id
    # (a primary key), which is one relation with both conditions.
    loans, apps = t["loans"], t["applications"]
    loan_apps = (apps.join(loans, apps["_id"] == loans["loan_application_id"], "inner")
                 .filter(loans["_id"].isNotNull() & (loans["status"] != "EXPIRED"))
                 .select(loans["_id"].alias("loan_id"),
                         apps["agent_master_id"].alias("agent_id"),
                         pg_concat(apps["first_name"], " ", apps["last_name"]).alias("applicant"),
                         apps["listing_address_line1"].alias("listing_address_line_1"),
                         apps["listing_address_line2"].alias("listing_address_line_2"),
                         apps["listing_city"], apps["listing_state"], apps["listing_zip"],
                         apps["program"].alias("app_program"),
                         loans["slug"].alias("key"), loans["principal"].alias("loan_principal"),
                         loans["is_ach_only"].alias("is_ach")))
    rows = (_first_and_last(t, tiebreak)
            .join(loan_apps, "loan_id", "inner")
            .filter(F.col("app_program") == F.lit(program)))
    if loan_id is not None:
        rows = rows.filter(F.col("loan_id") == F.lit(loan_id))
    method = F.col("method")
    txn_date = (F.when((method == "direct") & F.col("external_post_date").isNotNull(),
                       F.col("external_post_date"))
                 .when(method == "direct", F.col("value_date"))
                 .otherwise(F.col("first_created_at")))
    rows = rows.withColumn("transaction_date", txn_date)
    if end_date is not None:
        rows = rows.filter(F.col("transaction_date") < ntz_lit(end_date))
    # Unique secondary key: equal creation times still split across range partitions.
    return (rows.orderBy(oldest("first_created_at"), oldest("transaction_id"))
                .select(pg_to_char("transaction_date", "MM/DD/YYYY").alias("date"),
                        F.col("transaction_type").alias("ledger_item_type"),
                        transaction_label(method, F.col("is_ach")).alias("transaction_type"),
                        dollars("debit").alias("debit"), dollars("credit").alias("credit"),
                        "key", "loan_principal", "is_ach", "agent_id", "applicant",
                        "listing_address_line_1", "listing_address_line_2", "listing_city",
                        "listing_state", "listing_zip",
                        report_timestamp_text(generated_at, legacy_format)
                        .alias("report_generated_at")))


@by_part("ledger")
def _cleared_between(t: Tables, start: dt.date, end: dt.date, tiebreak: Sequence[str]) -> DataFrame:
    """Newest version per transaction of those cleared on the New York days ``start``..``end``.

    The days are exact UTC bounds, evaluated in the scan; on a
    month-partitioned ledger only the months they touch are read.
    """
    lender = prune_months(lender_rows(t), "created_at", ny_midnight_utc(start),
                          ny_midnight_utc(end + dt.timedelta(days=1)))
    window = (lender.filter(F.col("status") == "cleared")
              .filter(ny_date_between("created_at", start, end)))
    return latest_per_key(window, ["transaction_id"], _newest_first(window, tiebreak))


def early_month_cleared_totals(t: Tables, as_of: dt.date,
                               tiebreak: Sequence[str] = LEDGER_TIEBREAK) -> DataFrame:
    """Cleared ledger totals per (loan, user) for New York days 1..15 of ``as_of``'s month.

    Four sums over integer cents feed seven clamped outputs. The outstanding
    balance subtracts repayment credits but does not add repayment debits
    back, as the report defines it. The source picks one version per
    transaction without an order; here it is the newest (with a tie-break).
    """
    start = as_of.replace(day=1)
    cleared = _cleared_between(t, start, start + dt.timedelta(days=14), tiebreak)
    is_cleared = F.col("status") == "cleared"
    disb = is_cleared & (F.col("transaction_type") == "disbursement")
    repay = is_cleared & (F.col("transaction_type") == "repayment")

    def cents(cond: Column, c: str) -> Column:
        return F.sum(F.when(cond, F.col(c)).otherwise(F.lit(0)))

    sums = cleared.groupBy("loan_id", "user_id").agg(
        cents(disb, "debit").alias("dd"), cents(disb, "credit").alias("dc"),
        cents(repay, "credit").alias("rc"), cents(repay, "debit").alias("rd"))
    dd, dc, rc, rd = (F.col(c) for c in ("dd", "dc", "rc", "rd"))
    return sums.select(
        dollars(clamp0(dd)).alias("cleared_gross_disbursement_amount"),
        dollars(clamp0(dd - dc)).alias("cleared_net_disbursement_amount"),
        dollars(clamp0(dc)).alias("cleared_refund_amount"),
        dollars(clamp0(rc)).alias("cleared_repayment_amount"),
        dollars(clamp0(rc - rd)).alias("cleared_net_repayments_amount"),
        F.round(dollars(clamp0(dd - dc - rc), as_double=False), 2).cast("double")
        .alias("outstanding_principal_balance"),
        dollars(clamp0(rc - rd + dc)).alias("total_collections_cleared"),
        "loan_id", "user_id",
    )


@by_part("ledger")
def _card_disbursements(t: Tables, tiebreak: Sequence[str]) -> DataFrame:
    """Newest version by value date of every card disbursement."""
    card = (lender_rows(t)
            .filter((F.col("transaction_type") == "disbursement") & (F.col("method") == "card")))
    return latest_per_key(card, ["transaction_id"], _newest_first(card, tiebreak, "value_date"))


def merchant_spend(t: Tables, as_of: dt.date,
                   brands: Sequence[tuple[str, Sequence[str]]] = BRANDS,
                   tiebreak: Sequence[str] = LEDGER_TIEBREAK) -> DataFrame:
    """Card disbursement spend per merchant brand, before ``as_of``.

    Newest version per transaction by value date, then voided ones dropped
    (filter after the pick). Merchants with no brand match form their own
    group under their upper-cased name, and that same key is the output
    column. Only groups with positive total spend are kept.
    """
    txn = (_card_disbursements(t, tiebreak).filter(F.col("status") != "voided")
                  .filter(F.col("value_date") < ntz_lit(as_of))
                  .select("merchant_party_id",
                          (F.coalesce(F.col("debit"), F.lit(0))
                           - F.coalesce(F.col("credit"), F.lit(0))).alias("amount_cents")))
    # Pre-aggregate per merchant before meeting the merchant table: a merchant
    # with a third of all transactions becomes one row, not a skewed join key.
    per_merchant = txn.groupBy("merchant_party_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_cents").alias("cents"))
    party = t["transaction_party"].select(F.col("_id").alias("merchant_party_id"),
                                          F.col("name").alias("acceptor"))
    spend = (per_merchant.join(party, "merchant_party_id", "inner")
                .groupBy(brand_key(F.col("acceptor"), brands).alias("acceptor"))
                .agg(F.sum("n").alias("transactions"),
                     F.sum("cents").alias("total_cents"))
                .filter(F.col("total_cents") > 0))
    return (spend.select(
                "transactions",
                (F.col("total_cents").cast("double") / F.col("transactions").cast("double")
                 / F.lit(100.0)).alias("avg_amount"),
                dollars("total_cents").alias("total_amount"),
                "acceptor")
            .orderBy(newest("transactions")))
