"""Input tables of the reports and their schemas.

The schemas are inferred from how the reports use each column. Instants are
UTC ``timestamp_ntz``; ledger money is cents. Reading with an explicit schema
avoids footer inference on every file of a large table, and Catalyst prunes
columns and pushes filters into the parquet scan from there.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_DDL = {
    "ledger": "event_id bigint, transaction_id string, loan_id string, user_id string, "
              "party string, status string, method string, transaction_type string, "
              "debit decimal(18,2), credit decimal(18,2), created_at timestamp_ntz, "
              "value_date timestamp_ntz, effective_date date, external_post_date timestamp_ntz, "
              "merchant_party_id string",
    "loans": "_id string, slug string, user_id string, loan_application_id string, status string, "
             "principal decimal(18,2), is_ach_only boolean, program string, portfolio string, "
             "withdrawal_reason string, origination_date date, authorized_at timestamp_ntz, "
             "repaid_date date",
    "applications": "_id string, user_id string, address_hash string, first_name string, "
                    "last_name string, listing_address_line1 string, listing_address_line2 string, "
                    "listing_city string, listing_state string, listing_zip string, "
                    "agent_master_id string, agent_id string, program string, state string, "
                    "external_id string",
    "users": "_id string, first_name string, last_name string, state string",
    "transaction_party": "_id string, name string, mcc string, mid string, street_address string, "
                         "city string, postal_code string, state string",
    "acceleration_events": "loan_id string, canceled boolean, type string, "
                           "created_at timestamp_ntz, notes string, date date",
    "loan_principal_adjustment": "loan_id string, adjustment_amount decimal(18,2), "
                                 "created_at timestamp_ntz",
    "loan_snapshots": "loan_id string, status string, active_acceleration_event_date timestamp_ntz, "
                      "active_acceleration_event_type string, "
                      "first_disbursement_datetime timestamp_ntz, "
                      "last_repayment_datetime timestamp_ntz, repayment_status string, "
                      "created_at timestamp_ntz, disbursed_cents_cleared bigint, "
                      "principal_cents bigint, days_past_due int",
    "investor_purchases": "loan_id string, principal bigint, tape_new_refunds bigint, "
                          "purchase_date date",
    "payments": "_id string, loan_id string, slug string, effective_date date, amount bigint, "
                "status string",
    "payment_statuses": "payment_slug string, payload string, created_at timestamp_ntz",
    "ledger_entries": "loan_id string, account string, amount bigint, "
                      "ledger_transaction_id string",
    "ledger_transactions": "_id string, effective_date date",
    "ledger_accounts": "name string, normal_balance int",
}

# DDL strings; ``DataFrameReader.schema`` accepts them directly.
SCHEMAS: dict[str, str] = dict(_DDL)


class TableFolder(dict):
    """``name -> DataFrame`` over ``root/<name>``, each read on first use.

    A report touches only the tables it needs, so a folder may hold just
    those; each table is read (and its files listed) once.
    """

    def __init__(self, spark: SparkSession, root: str,
                 schemas: Mapping[str, StructType | str], fmt: str,
                 names: Iterable[str] | None = None):
        super().__init__()
        self._spark, self._root, self._schemas, self._fmt = spark, root.rstrip("/"), schemas, fmt
        self._names = set(names) if names is not None else None

    def __missing__(self, name: str) -> DataFrame:
        if self._names is not None and name not in self._names:
            raise KeyError(name)
        reader = self._spark.read.format(self._fmt)
        if name in self._schemas:
            reader = reader.schema(self._schemas[name])
        df = self[name] = reader.load(f"{self._root}/{name}")
        return df


def read_tables(spark: SparkSession, root: str, names: Iterable[str] | None = None,
                schemas: Mapping[str, StructType | str] | None = None,
                fmt: str = "parquet") -> TableFolder:
    """Tables under ``root/<name>`` (any Spark file format), read lazily by name."""
    return TableFolder(spark, root, SCHEMAS if schemas is None else schemas, fmt, names)
