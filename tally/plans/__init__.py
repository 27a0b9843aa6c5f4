"""Report pipelines (ledger, loans, remittance) and the query catalogue.

The reports, importable from here: each takes a ``name -> DataFrame``
mapping of input tables plus keyword parameters and returns a DataFrame.
"""

from tally.plans.ledger import (
    cleared_versions,
    early_month_cleared_totals,
    external_ledger,
    external_ledger_first_last,
    latest_then_filter,
    ledger_current_versions,
    ledger_first_versions,
    merchant_spend,
)
from tally.plans.loans import (
    acceleration_events,
    first_expired_authorization,
    loan_snapshots_collections,
    loan_snapshots_current,
    reapplication_report,
    reapplications,
    reapplications_expired,
    upsizes,
)
from tally.plans.remittance import (
    entry_impacts,
    investor_refunds,
    loan_balances,
    most_recent_snapshot,
    new_purchasable,
    nsf_repayments,
    previous_investor_tape_totals,
    remittance_report,
    target_loans,
)

__all__ = [
    "acceleration_events", "cleared_versions", "early_month_cleared_totals", "entry_impacts",
    "external_ledger", "external_ledger_first_last", "first_expired_authorization",
    "investor_refunds", "latest_then_filter", "ledger_current_versions",
    "ledger_first_versions", "loan_balances", "loan_snapshots_collections",
    "loan_snapshots_current", "merchant_spend", "most_recent_snapshot", "new_purchasable",
    "nsf_repayments", "previous_investor_tape_totals", "reapplication_report",
    "reapplications", "reapplications_expired", "remittance_report", "target_loans",
    "upsizes",
]
