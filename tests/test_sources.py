"""Table reader with declared schemas, and view registration."""

import datetime as dt
import os
import re
import tempfile

from given_tables import SF_SMALL
from tally.plans.views import VIEW_NAMES, register_activity_views
from tally.sources import SCHEMAS, fixture_tables, read_tables


def test_read_tables_uses_declared_schemas(spark):
    root = tempfile.mkdtemp(prefix="tally-tables-")
    for name, ddl in SCHEMAS.items():
        spark.createDataFrame([], ddl).write.parquet(os.path.join(root, name))
    tables = read_tables(spark, root)
    for name in SCHEMAS:
        df = tables[name]
        assert df.schema == spark.createDataFrame([], SCHEMAS[name]).schema
        assert df.count() == 0
    assert set(tables) == set(SCHEMAS)


def test_activity_views_are_queryable(spark):
    t = fixture_tables(spark, SF_SMALL)
    register_activity_views(t, dt.date(2000, 1, 1))
    for name in VIEW_NAMES:
        assert spark.table(name).count() >= 0
    n = spark.sql("SELECT count(*) FROM temp_loan_snapshots "
                  "WHERE date_added_to_collections IS NOT NULL").collect()[0][0]
    assert n > 0


def test_checkpoint_dir_comes_from_the_session(spark):
    from tally.session import checkpoint_dir
    path = checkpoint_dir(spark)
    assert path and spark.sparkContext.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:      # the cluster's shared folder wins over any local default
        assert configured.rstrip("/").split(":")[-1] in path


def test_month_partitions_prune_and_keep_results(spark):
    import datetime as dt

    from tally.operators.partitions import write_by_month
    from tally.plans import ledger as L
    from tally.plans import loans as N
    root = tempfile.mkdtemp(prefix="tally-months-")
    t = fixture_tables(spark, SF_SMALL)
    write_by_month(t["ledger"], os.path.join(root, "ledger"))
    write_by_month(t["loan_snapshots"], os.path.join(root, "loan_snapshots"))
    parted = read_tables(spark, root, schemas={})
    assert "created_at_month" in parted["ledger"].columns
    as_of = dt.date(2024, 1, 20)
    got = L.early_month_cleared_totals(parted, as_of)
    want = L.early_month_cleared_totals(t, as_of)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_at_month" in plan
    snaps = N.loan_snapshots_current(parted, dt.date(1997, 1, 1))
    assert sorted(map(tuple, snaps.collect())) == \
        sorted(map(tuple, N.loan_snapshots_current(t, dt.date(1997, 1, 1)).collect()))
    assert "PartitionFilters: [isnotnull(created_at_month" in \
        snaps._jdf.queryExecution().executedPlan().toString()


def test_reports_run_on_declared_schemas(spark):
    """Fixture tables cast to the declared production types (string ids,
    decimal money, no fixture-only tie-break columns) give the same reports."""
    import datetime as dt

    from pyspark.sql import functions as F
    from pyspark.sql.types import StructType

    from tally.plans import ledger as L
    from tally.plans import loans as N
    from tally.plans import remittance as R
    from tally.plans.catalogue import BASE_URL, CUTOFF, GENERATED_AT, GENERATED_ON
    from tally.sources.fixtures import (AGENT_PROGRAM, FIXTURE_BRANDS, HOME_PROGRAM,
                                        TEST_PORTFOLIO)
    t = fixture_tables(spark, SF_SMALL)

    def conform(name):
        schema = spark.createDataFrame([], SCHEMAS[name]).schema
        df = t[name]
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None))
                           .cast(f.dataType).alias(f.name) for f in schema.fields])
    prod = {name: conform(name) for name in SCHEMAS if name in ("ledger", "loans",
            "applications", "users", "transaction_party", "loan_snapshots",
            "investor_purchases", "payments", "payment_statuses", "ledger_entries",
            "ledger_transactions", "ledger_accounts")}
    assert "line" not in prod["loan_snapshots"].columns
    assert isinstance(prod["ledger"].schema, StructType)

    def same(a, b, money=None):
        assert a.count() == b.count()
        if money:
            got = a.agg(F.sum(money)).first()[0]
            want = b.agg(F.sum(money)).first()[0]
            assert (got is None and want is None) or abs(got - want) < 1e-6

    ext = dict(program=AGENT_PROGRAM, generated_at=GENERATED_AT, exclude_agents=["TEST_AGENT"])
    same(L.external_ledger(prod, **ext), L.external_ledger(t, **ext), "debit")
    as_of = dt.date(2024, 1, 20)
    same(L.early_month_cleared_totals(prod, as_of), L.early_month_cleared_totals(t, as_of),
         "cleared_gross_disbursement_amount")
    same(L.merchant_spend(prod, as_of, brands=FIXTURE_BRANDS),
         L.merchant_spend(t, as_of, brands=FIXTURE_BRANDS), "total_amount")
    same(N.loan_snapshots_current(prod, dt.date(2000, 1, 1)),
         N.loan_snapshots_current(t, dt.date(2000, 1, 1)))
    same(N.reapplication_report(prod, exclude_users=["1", "2"]),
         N.reapplication_report(t, exclude_users=[1, 2]))
    same(R.nsf_repayments(prod), R.nsf_repayments(t), "amount")
    tape = dict(cutoff=CUTOFF, generated_on=GENERATED_ON, program=HOME_PROGRAM,
                exclude_portfolio=TEST_PORTFOLIO, base_url=BASE_URL,
                servicing_fee_account="earned_servicing_fee")
    same(R.remittance_report(prod, **tape), R.remittance_report(t, **tape), "principal")


def test_jdbc_slices_cover_each_row_once():
    import duckdb

    from tally.sources.jdbc import slice_predicates
    assert slice_predicates("_id", 1) == ["1 = 1"]
    preds = slice_predicates("k", 4, bucket="({key} % {n} + {n}) % {n}")
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT range AS k FROM range(-50, 50)")
    counts = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in preds]
    assert sum(counts) == 100 and all(c > 0 for c in counts)
    pg = slice_predicates("transaction_id", 3)
    assert pg[2] == ("((hashtext(coalesce(transaction_id::text, '')) % 3) + 3) % 3 = 2")


def test_newest_snapshot_reads_only_reported_columns(spark, tmp_path):
    """Without a unique key, ties end with the reported columns: the scan stays narrow."""
    from tally.plans import loans, remittance
    for name in ("loan_snapshots", "loans"):
        spark.createDataFrame([], SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}")
    t = read_tables(spark, str(tmp_path))
    day = dt.date(2024, 1, 1)
    tape = remittance.most_recent_snapshot(t, None, day).select("loan_id", "days_past_due")
    for report, unread in ((tape, "active_acceleration_event_type"),
                           (loans.loan_snapshots_current(t, day), "principal_cents")):
        scans = re.findall(r"ReadSchema: (\S+)", report._jdf.queryExecution().toString())
        assert scans and not any(unread in s for s in scans)
