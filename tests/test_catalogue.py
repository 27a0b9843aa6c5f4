"""Catalogue queries against their DuckDB oracles, properties and plan shape."""

import hashlib

import pytest
from pyspark.sql import functions as F

from given_tables import SF_SMALL
from tally.plans.catalogue import QUERIES
from tally.plans.oracle import ORACLE_SQL


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(repr(r[i]) if isinstance(r[i], float) else str(r[i])
                            for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE_SQL[name])
    ocols = [c[0] for c in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns) == digest(orows, ocols)
    # The same through pandas (dtype conversions differ between the engines).
    pdf, odf = df.toPandas(), duck.execute(ORACLE_SQL[name]).df()
    cols = sorted(pdf.columns)

    def frame_lines(f):
        f = f[cols].astype(object)
        return sorted(map(str, f.where(f.notna(), None).itertuples(index=False)))
    assert frame_lines(pdf) == frame_lines(odf)


def test_smoke_entry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == list(QUERIES["external_ledger_created_local"](spark, SF_SMALL).columns)


def test_early_month_amounts_non_negative(spark):
    df = QUERIES["early_month_totals"](spark, SF_SMALL)
    amounts = [c for c in df.columns if c not in ("loan_id", "user_id")]
    assert df.filter(" OR ".join(f"{c} < 0" for c in amounts)).count() == 0


def test_remittance_rows_distinct_and_purchasable_non_negative(spark):
    df = QUERIES["remittance_report"](spark, SF_SMALL)
    assert df.count() == df.distinct().count()
    assert df.filter(F.col("additional_draws_to_purchase") < 0).count() == 0
    np = QUERIES["new_purchasable"](spark, SF_SMALL)
    assert np.filter(F.col("new_purchasable_dollars") < 0).count() == 0


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_cartesian_or_python(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_SMALL))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython",
                "ArrowEvalPython"):
        assert bad not in plan


def test_void_step_is_an_anti_join_after_partial_limit(spark):
    plan = plan_text(QUERIES["ledger_unvoided_latest"](spark, SF_SMALL))
    assert "LeftOuter" not in plan
    assert "LeftAnti" in plan
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_month_window_reaches_the_scan(spark):
    df = QUERIES["early_month_totals"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan.replace("\n", " ") \
        or ("GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan)


def test_latest_per_key_is_one_shuffle(spark):
    import re
    plan = plan_text(QUERIES["ledger_current_versions"](spark, SF_SMALL))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_snapshot_and_void_cutoffs_reach_the_scan(spark):
    plan = plan_text(QUERIES["most_recent_snapshot"](spark, SF_SMALL))
    assert "LessThan(l_shipdate,2000-01-01T05:00)" in plan
    plan = plan_text(QUERIES["loan_snapshots_current"](spark, SF_SMALL))
    assert "LessThanOrEqual(l_shipdate,2000-01-01T05:00)" in plan


def test_materialised_shared_join_gives_same_report(spark):
    from tally.plans import loans as N
    from tally.sources.fixtures import EXCLUDE_USERS, TEST_AGENTS, fixture_tables
    t = fixture_tables(spark, SF_SMALL)
    lazy = N.reapplication_report(t, test_agents=TEST_AGENTS, exclude_users=EXCLUDE_USERS)
    kept = N.reapplication_report(t, test_agents=TEST_AGENTS, exclude_users=EXCLUDE_USERS,
                                  materialize_shared=True)
    assert sorted(map(tuple, lazy.collect())) == sorted(map(tuple, kept.collect()))


def test_building_the_tape_starts_no_job(spark):
    names = ("most_recent_snapshot", "new_purchasable", "remittance_report")
    spark.sparkContext.setJobGroup("building", "reports are lazy")
    for name in names:
        QUERIES[name](spark, SF_SMALL)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_entries_are_summed_before_the_accounts_are_joined(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(QUERIES["entry_impacts"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_account = plan.index("hashpartitioning(account")
    assert "hashpartitioning(loan_id" in plan[by_account:]      # the sum lies below


def test_first_last_ledger_comes_by_first_version(spark, duck):
    """O-3: by the creation time of the first version, which is no output column; ties by transaction."""
    df = QUERIES["external_ledger_first_last"](spark, SF_SMALL)
    sql = ORACLE_SQL["external_ledger_first_last"].rstrip() + ", r.transaction_id"
    names = duck.execute(sql.split("ORDER BY r.first_seen")[0] + "LIMIT 0").description
    want = duck.execute(sql).fetchall()
    at = [[n[0] for n in names].index(c) for c in df.columns]
    assert [tuple(r) for r in df.collect()] == [tuple(r[i] for i in at) for r in want] and len(want) > 20


def test_reports_come_in_their_order(spark):
    """O-1, O-2: users first to last, brands by falling transaction counts."""
    users = [r.user_id for r in QUERIES["reapplication_report"](spark, SF_SMALL).collect()]
    assert users == sorted(users)
    counts = [r.transactions for r in QUERIES["merchant_spend"](spark, SF_SMALL).collect()]
    assert counts == sorted(counts, reverse=True)
