"""Investor remittance tape.

Everything is keyed by loan: the as-of snapshot, previous purchases, bank
failures and ledger balances are each reduced to one row (or a few) per loan
before they meet the loans, so the final star join never multiplies large
relations. Money stays decimal inside and becomes double only on output.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tally.functions.money import dollars
from tally.functions.text import pg_concat
from tally.functions.time import ny_midnight_utc, ny_wall_before, pg_to_char
from tally.operators.keyfilter import key_filter, may_match
from tally.operators.latest import latest_facts
from tally.operators.objects import object_agg
from tally.operators.partitions import prune_months
from tally.operators.pivot import pivot_sums

Tables = Mapping[str, DataFrame]

STATUS_TIEBREAK = ("event_id",)
SNAPSHOT_TIEBREAK = ("line", "part")

# The ledger accounts the tape reads, and its output columns
# for them (the servicing-fee account is given by the caller).
INVESTOR_REFUNDS = "investor_accumulated_refunds"
BALANCE_ACCOUNTS = (
    "principal",
    "writeoffs_principal",
    "accumulated_principal_repayments",
    "writeoffs_interest",
    "accumulated_interest_repayments",
    "investor_accumulated_refunds",
    "investor_accumulated_interest",
    "investor_accumulated_principal_repayments",
    "investor_accumulated_interest_repayments",
)


def _money(c: Column) -> Column:
    return c.cast("double")


def _of_loans(df: DataFrame, loans: DataFrame) -> DataFrame:
    """Rows of ``df`` that may be of ``loans``, by a key filter: before a shuffle that the exact join can't precede."""
    ids = loans.select(F.col("_id").cast(df.schema["loan_id"].dataType).alias("loan_id"))
    return may_match(df, "loan_id", key_filter(ids, "loan_id"))


def target_loans(t: Tables, *, program: str, exclude_portfolio: str,
                 slug: str | None = None) -> DataFrame:
    """Loans of ``program`` outside the excluded portfolio (NULL portfolio drops)."""
    loans = t["loans"].filter((F.col("portfolio") != F.lit(exclude_portfolio))
                              & (F.col("program") == F.lit(program)))
    if slug is not None:
        loans = loans.filter(F.col("slug") == F.lit(slug))
    return loans


# What the tape takes from a loan's newest snapshot.
TAPE_FACTS = ("status", "disbursed_cents_cleared", "principal_cents", "days_past_due")


def most_recent_snapshot(t: Tables, loans: DataFrame | None, cutoff: dt.date,
                         tiebreak: Sequence[str] = SNAPSHOT_TIEBREAK) -> DataFrame:
    """Newest snapshot per target loan created (New York time) before ``cutoff``.

    A key filter of ``loans`` drops the snapshots of other loans in the scan.
    The pick then runs before the exact restriction: its partial limit runs
    before its shuffle, so a loan with a third of all snapshots costs one row
    per input split, and the semi-join meets one row per loan. ``loans=None``:
    no restriction (the caller joins the loans itself).
    """
    snaps = (prune_months(t["loan_snapshots"], "created_at", hi=ny_midnight_utc(cutoff))
             .filter(ny_wall_before("created_at", cutoff)))
    if loans is not None:
        snaps = _of_loans(snaps, loans)
    latest = latest_facts(snaps, "loan_id", "created_at", TAPE_FACTS, tiebreak)
    if loans is not None:
        latest = latest.join(loans.select(F.col("_id").alias("loan_id")), "loan_id", "left_semi")
    return latest.withColumn("credit_usage_dollars",
                             F.round(dollars("disbursed_cents_cleared", as_double=False), 2))


def previous_investor_tape_totals(t: Tables, cutoff: dt.date) -> DataFrame:
    """Principal and refunds already sold to the investor before ``cutoff``, per loan."""
    ip = t["investor_purchases"].filter(F.col("purchase_date") < F.lit(cutoff))
    return ip.groupBy("loan_id").agg(
        F.round(dollars(F.sum(F.coalesce(F.col("principal"), F.lit(0))), as_double=False), 2)
        .alias("principal"),
        F.round(dollars(F.sum(F.coalesce(F.col("tape_new_refunds"), F.lit(0))), as_double=False), 2)
        .alias("refunds"))


def new_purchasable(t: Tables, *, cutoff: dt.date, program: str, exclude_portfolio: str,
                    slug: str | None = None) -> DataFrame:
    """Gross purchasable (credit usage + prior refunds) and what is newly purchasable.

    Only loans with both a snapshot and a previous purchase.
    """
    loans = target_loans(t, program=program, exclude_portfolio=exclude_portfolio, slug=slug)
    snap = most_recent_snapshot(t, loans, cutoff)
    prev = previous_investor_tape_totals(t, cutoff)
    j = snap.select("loan_id", "credit_usage_dollars").join(prev, "loan_id", "inner")
    gross = F.col("credit_usage_dollars") + F.coalesce(F.col("refunds"), F.lit(0))
    return j.select("loan_id",
                    _money(gross).alias("gross_purchasable_dollars"),
                    _money(F.greatest(gross - F.coalesce(F.col("principal"), F.lit(0)),
                                      F.lit(0).cast("decimal(2,2)")))
                    .alias("new_purchasable_dollars"))


def nsf_repayments(t: Tables, tiebreak: Sequence[str] = STATUS_TIEBREAK) -> DataFrame:
    """Failed payments whose latest bank status reports insufficient funds."""
    raw = t["payment_statuses"]
    statuses = latest_facts(raw, "payment_slug", "created_at", ["payload"], tiebreak)
    bank = statuses.select(
        F.get_json_object("payload", "$.transactionStatus").alias("bank_status"),
        F.get_json_object("payload", "$.exceptions").alias("bank_exceptions"),
        "payment_slug")
    payments = t["payments"]
    return (payments.join(bank, payments["slug"] == bank["payment_slug"], "inner")
                    .filter((F.col("status") == "failed")
                            & F.col("bank_exceptions").cast("string").like("%INSUFFICIENT FUNDS%"))
                    .select(F.col("_id").alias("payment_id"), "loan_id", "effective_date",
                            "amount", "status", "bank_status", "bank_exceptions",
                            "payment_slug"))


def _entries(t: Tables, cutoff: dt.date, loans: DataFrame | None = None) -> tuple[DataFrame, Callable[[Column], Column]]:
    """Ledger entries effective before ``cutoff`` with their signed impact.

    The report rounds ``amount * normal_balance / 100`` to cents per entry
    before summing. For integer-cent amounts that rounding is exact, so the
    impact is summed as ``long`` cents and turned into dollars once per
    group (same result, no wide-decimal arithmetic per row); fractional
    amounts keep the per-entry decimal rounding. Returns the entries and
    the function that finishes a summed impact. With ``loans``, entries of
    other loans are dropped by a key filter before they are shuffled; a few
    may pass, for the caller's join with the loans to drop.
    """
    e, tx, acc = t["ledger_entries"], t["ledger_transactions"], t["ledger_accounts"]
    if loans is not None:
        e = _of_loans(e, loans)
    tx = tx.filter(F.col("effective_date") < F.lit(cutoff)).select(
        F.col("_id").alias("ledger_transaction_id"))
    acc = acc.select(F.col("name").alias("account"), "normal_balance")
    dated = e.join(tx, "ledger_transaction_id", "inner")
    if isinstance(e.schema["amount"].dataType, IntegralType):
        # The sign is the account's, so the entries are summed before the few
        # accounts are joined: no shuffle of single entries by account.
        dated = dated.groupBy("loan_id", "account").agg(F.sum("amount").alias("amount"))
        impact, finish = F.col("amount") * F.col("normal_balance"), (lambda c: dollars(c, as_double=False))
    else:
        impact = F.round(dollars(F.col("amount") * F.col("normal_balance"), as_double=False), 2)
        finish = lambda c: c
    joined = dated.join(acc, "account", "inner")
    return joined.select("loan_id", "account", impact.alias("impact")), finish


def entry_impacts(t: Tables, cutoff: dt.date) -> DataFrame:
    """Per (loan, account): sum of per-entry rounded signed dollars."""
    entries, finish = _entries(t, cutoff)
    return (entries.groupBy("loan_id", "account")
            .agg(finish(F.sum("impact")).alias("normalized_dollars")))


def loan_balance_objects(t: Tables, cutoff: dt.date) -> DataFrame:
    """One row per loan with ``balances``: a map from every account of its entries to its dollars.

    No list of accounts is given: the names are those of the entries.
    """
    return object_agg(entry_impacts(t, cutoff), ["loan_id"], "account", "normalized_dollars", "balances")


def loan_balances(t: Tables, cutoff: dt.date, accounts: Sequence[str],
                  names: Sequence[str] | None = None, loans: DataFrame | None = None) -> DataFrame:
    """One row per loan, one column per account of the closed list.

    Equal to pivoting ``entry_impacts`` (a sum of per-account sums), done as
    one aggregate straight from the entries. With ``loans`` most rows of other
    loans are left out, not all (see ``_entries``).
    """
    entries, finish = _entries(t, cutoff, loans)
    names = list(names or accounts)
    sums = pivot_sums(entries, ["loan_id"], "account", accounts, F.col("impact"), names)
    return sums.select("loan_id", *[finish(F.col(n)).alias(n) for n in names])


def investor_refunds(t: Tables, cutoff: dt.date) -> DataFrame:
    """Investor refunds to date per loan, and those not yet on a previous tape.

    ``outstanding`` is NULL for loans never purchased before.
    """
    bal = loan_balances(t, cutoff, [INVESTOR_REFUNDS], ["refunds_to_date"])
    prev = previous_investor_tape_totals(t, cutoff).select("loan_id",
                                                           F.col("refunds").alias("prev"))
    total = F.coalesce(F.col("refunds_to_date"), F.lit(0))
    return (bal.join(prev, "loan_id", "left")
               .select("loan_id", _money(total).alias("total_investor_refunds"),
                       _money(total - F.col("prev")).alias("outstanding_investor_refunds")))


REMITTANCE_COLUMNS = (
    "report_generation_date", "period_end", "borrower_link", "first_name", "last_name",
    "external_id", "loan_id", "loan_status", "is_repaid", "repaid_date", "credit_limit",
    "aggregate_original_principal_balance", "days_past_due", "total_investor_refunds",
    "previous_investor_refunds", "outstanding_investor_refunds", "nsf_repayments",
    "additional_draws_to_purchase", "investor_purchased_principal",
    "investor_purchased_interest", "investor_accumulated_principal_repayments",
    "investor_accumulated_interest_repayments",
    "investor_accumulated_principal_and_interest_repayments", "principal",
    "writeoffs_principal", "accumulated_principal_repayments", "writeoffs_interest",
    "accumulated_interest_repayments", "earned_servicing_fee",
)


def remittance_report(t: Tables, *, cutoff: dt.date, generated_on: dt.date, program: str,
                      exclude_portfolio: str, base_url: str, servicing_fee_account: str,
                      slug: str | None = None) -> DataFrame:
    """Investor remittance tape: one row per purchased loan (per NSF repayment).

    Ids and slugs of loans, and ids of users and applications, are unique, so
    rows can repeat by failed payments only; these are made distinct per loan
    and dollars before they are joined. ``cutoff`` is the exclusive period end. Loans never purchased before are
    excluded (inner join on the previous totals), so the purchase columns are
    NULL only when the loan has no snapshot. Several outputs are sums of two
    balances, as the tape defines them.
    """
    loans = target_loans(t, program=program, exclude_portfolio=exclude_portfolio, slug=slug)
    users = t["users"].select(F.col("_id").alias("u_id"),
                              F.col("first_name").alias("u_first"),
                              F.col("last_name").alias("u_last"))
    apps = t["applications"].select(F.col("_id").alias("a_id"), "external_id")
    prev = previous_investor_tape_totals(t, cutoff).select(
        "loan_id", F.col("principal").alias("prev_principal"),
        F.col("refunds").alias("prev_refunds"))
    snap = most_recent_snapshot(t, loans, cutoff).select(
        "loan_id", "principal_cents", "disbursed_cents_cleared", "days_past_due",
        "credit_usage_dollars", F.lit(True).alias("has_snapshot"))
    nsf = nsf_repayments(t).select(
        "loan_id", F.round(dollars("amount", as_double=False), 2).alias("nsf_dollars")).distinct()
    accounts = [*BALANCE_ACCOUNTS, servicing_fee_account]
    names = [*BALANCE_ACCOUNTS, "earned_servicing_fee"]
    bal = loan_balances(t, cutoff, accounts, [f"b_{n}" for n in names], loans) \
        .withColumn("has_balances", F.lit(True))

    # Loan-keyed relations first: the previous totals, snapshot and balances
    # are already partitioned by loan id, so these joins share one shuffle of
    # the loans; users and applications (other keys) come last.
    base = (loans.select(F.col("_id").alias("loan_id"), F.col("slug"), F.col("status"),
                         F.col("repaid_date"), F.col("user_id"), F.col("loan_application_id"))
                 .join(prev, "loan_id", "inner")
                 .join(snap, "loan_id", "left")
                 .join(bal, "loan_id", "left")
                 .join(nsf, "loan_id", "left")
                 .join(users, F.col("user_id") == F.col("u_id"), "inner")
                 .join(apps, F.col("loan_application_id") == F.col("a_id"), "inner"))

    def b(name: str) -> Column:
        return F.coalesce(F.col(f"b_{name}"), F.lit(0))

    gross = F.col("credit_usage_dollars") + F.coalesce(F.col("prev_refunds"), F.lit(0))
    newly = F.greatest(gross - F.coalesce(F.col("prev_principal"), F.lit(0)),
                       F.lit(0).cast("decimal(2,2)"))
    refunds = F.when(F.col("has_balances"), b(INVESTOR_REFUNDS))
    repaid = F.col("status") == "REPAID"
    period_end = cutoff - dt.timedelta(days=1)
    return base.select(
        pg_to_char(F.lit(generated_on), "yyyy-mm-dd").alias("report_generation_date"),
        pg_to_char(F.lit(period_end), "yyyy-mm-dd").alias("period_end"),
        pg_concat(base_url, F.col("u_id")).alias("borrower_link"),
        F.upper("u_first").alias("first_name"), F.upper("u_last").alias("last_name"),
        "external_id",
        F.col("slug").alias("loan_id"),
        F.col("status").alias("loan_status"),
        F.when(repaid, F.lit(True)).alias("is_repaid"),
        F.when(repaid, F.col("repaid_date")).alias("repaid_date"),
        _money(F.round(dollars("principal_cents", as_double=False), 2)).alias("credit_limit"),
        _money(F.round(dollars("disbursed_cents_cleared", as_double=False), 2))
        .alias("aggregate_original_principal_balance"),
        F.when(F.col("days_past_due") > 0, F.col("days_past_due")).alias("days_past_due"),
        _money(refunds).alias("total_investor_refunds"),
        _money(F.col("prev_refunds")).alias("previous_investor_refunds"),
        _money(refunds - F.col("prev_refunds")).alias("outstanding_investor_refunds"),
        _money(F.col("nsf_dollars")).alias("nsf_repayments"),
        _money(F.when(F.col("has_snapshot"), newly)).alias("additional_draws_to_purchase"),
        _money(F.col("prev_principal")).alias("investor_purchased_principal"),
        _money(b("investor_accumulated_interest")).alias("investor_purchased_interest"),
        _money(b("investor_accumulated_principal_repayments"))
        .alias("investor_accumulated_principal_repayments"),
        _money(b("investor_accumulated_interest_repayments"))
        .alias("investor_accumulated_interest_repayments"),
        _money(b("investor_accumulated_principal_repayments")
               + b("investor_accumulated_interest_repayments"))
        .alias("investor_accumulated_principal_and_interest_repayments"),
        _money(b("principal")).alias("principal"),
        _money(b("writeoffs_principal")).alias("writeoffs_principal"),
        _money(b("accumulated_principal_repayments") + b("writeoffs_principal"))
        .alias("accumulated_principal_repayments"),
        _money(b("writeoffs_interest")).alias("writeoffs_interest"),
        _money(b("accumulated_interest_repayments") + b("writeoffs_interest"))
        .alias("accumulated_interest_repayments"),
        _money(b("earned_servicing_fee")).alias("earned_servicing_fee"),
    )
