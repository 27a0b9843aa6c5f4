"""Objects of open names, key filters, tables stored by key, and the plans that use them."""

import datetime as dt
import re
import uuid
from collections import ChainMap

import pytest
from given_tables import SF_MID, SF_SMALL
from pyspark.sql import functions as F

from tally.operators.keyfilter import key_filter, may_match
from tally.operators.latest import newest, oldest
from tally.operators.objects import jsonb_text, object_agg, object_get
from tally.operators.stored import stored_tables, write_by_key
from tally.plans import ledger as L
from tally.plans import loans as N
from tally.plans import remittance as R
from tally.plans.catalogue import (
    AGENT_PROGRAM,
    BASE_URL,
    BRANDS_AS_OF,
    CUTOFF,
    EVENT_AS_OF,
    GENERATED_AT,
    GENERATED_ON,
    HOME_PROGRAM,
    QUERIES,
    SERVICING_FEE_ACCOUNT,
    TEST_PORTFOLIO,
)
from tally.plans.oracle import ORACLE_SQL
from tally.sources.fixtures import fixture_tables


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k) for k in keys]
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in zip(keys, before):
        spark.conf.set(k, v)


# ---- objects

def test_last_of_a_repeated_name_wins(spark):
    rows = [(1, "b", 5, 1), (1, "b", None, 3), (1, "b", 7, 2), (1, "aa", 1, 1), (1, 'q"\\', 2, 1), (2, "b", 9, None), (2, "b", 8, 4)]
    df = spark.createDataFrame(rows, "k long, name string, v long, at long")
    got = object_agg(df, ["k"], "name", "v", "o", order=[F.col("at")])
    texts = {r.k: r.t for r in got.select("k", jsonb_text(got, "o").alias("t")).collect()}
    assert texts == {1: '{"b": null, "aa": 1, "q\\"\\\\": 2}', 2: '{"b": 8}'}
    read = {r.k: (r.b, r.x) for r in got.select("k", object_get("o", "b").alias("b"), object_get("o", "x").alias("x")).collect()}
    assert read == {1: (None, None), 2: ("8", None)}
    assert object_agg(df.limit(0), ["k"], "name", "v", order=[F.col("at")]).count() == 0


def test_objects_of_text_and_their_errors(spark):
    df = spark.createDataFrame([(1, "a", 'x "y"'), (1, "b", None)], "k long, name string, v string")
    got = object_agg(df, ["k"], "name", "v", "o")
    assert got.select(jsonb_text(got, "o")).first()[0] == '{"a": "x \\"y\\"", "b": null}'
    for bad in ([(1, None, "x")], [(1, "a", "x"), (1, "a", "y")]):
        with pytest.raises(Exception, match="field name must not be null|DUPLICATED_MAP_KEY"):
            object_agg(spark.createDataFrame(bad, "k long, name string, v string"), ["k"], "name", "v").collect()


def test_balances_of_accounts_nobody_listed(spark):
    """An account that the report was never told of is in the object, and no pivot column."""
    t = {"ledger_entries": spark.createDataFrame(
            [(1, "principal", 100, 1), (1, "brand_new", 250, 1), (1, "brand_new", 50, 2), (2, "late", 7, 3), (3, "x", 5, 1)],
            "loan_id long, account string, amount long, ledger_transaction_id long"),
         "ledger_transactions": spark.createDataFrame(
            [(1, dt.date(2020, 1, 1)), (2, dt.date(2020, 1, 2)), (3, dt.date(2022, 1, 1))], "_id long, effective_date date"),
         "ledger_accounts": spark.createDataFrame([("principal", 1), ("brand_new", -1), ("late", 1)], "name string, normal_balance int")}
    rows = R.loan_balance_objects(t, dt.date(2021, 1, 1))
    assert {r.loan_id: r.t for r in rows.select("loan_id", jsonb_text(rows, "balances").alias("t")).collect()} == {
        1: '{"brand_new": -3.00, "principal": 1.00}'}


# ---- key filters

def test_key_filter_loses_no_wanted_row(spark):
    wanted = spark.range(0, 60_000, 3).withColumn("k", F.when(F.col("id") % 7 != 0, F.col("id")))
    rows = spark.range(60_000).select(F.when(F.col("id") % 11 != 0, F.col("id")).alias("k"), F.lit("x").alias("other"))
    exact = rows.join(wanted, "k", "left_semi")
    for bits, most in ((1 << 22, 1.02), (1 << 15, 4.0)):
        passed = may_match(rows, "k", key_filter(wanted, "k", bits), bits)
        assert passed.columns == rows.columns
        assert passed.join(wanted, "k", "left_semi").count() == exact.count() <= passed.count() <= most * exact.count()
    assert may_match(rows, "k", key_filter(wanted.limit(0), "k")).count() == 0
    assert key_filter(wanted, "k", 1 << 20).count() <= (1 << 20) // 32768


def shuffled_rows(df) -> int:
    """Rows written to shuffles by one run."""
    df.collect()
    total, stack = 0, [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            stack.append(node.plan())
        elif kind == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return total


def test_other_loans_are_not_shuffled(spark, monkeypatch):
    t = fixture_tables(spark, SF_MID)
    loans = R.target_loans(t, program=HOME_PROGRAM, exclude_portfolio=TEST_PORTFOLIO)
    snapshots = lambda: R.most_recent_snapshot(t, loans, CUTOFF)
    balances = lambda: R.loan_balances(t, CUTOFF, ["principal"], loans=loans)
    few = shuffled_rows(snapshots()), shuffled_rows(balances())
    monkeypatch.setattr(R, "_of_loans", lambda df, loans: df)
    many = shuffled_rows(snapshots()), shuffled_rows(balances())
    assert few[0] < 0.6 * many[0] and few[1] < 0.6 * many[1]


# ---- tables stored by key

STEPS = {
    "created_local": lambda t: L.cleared_versions(t, "created_local"),
    "effective": lambda t: L.cleared_versions(t, "effective"),
    "effective_only": lambda t: L.cleared_versions(t, "effective_only"),
    "then_filter": L.latest_then_filter,
    "current": L.ledger_current_versions,
    "first": L.ledger_first_versions,
}


@pytest.fixture(scope="module")
def stored(spark):
    """The ledger stored by transaction, a third of its rows being of one transaction, and the plain tables."""
    t = fixture_tables(spark, SF_SMALL)
    rows = t["ledger"]
    hot = rows.filter("event_id % 3 = 0").withColumn("transaction_id", F.lit(77).cast(rows.schema["transaction_id"].dataType))
    rows = rows.filter("event_id % 3 <> 0").unionByName(hot).unionByName(
        rows.limit(5).withColumn("transaction_id", F.lit(None).cast("long")))
    name = f"ledger_{uuid.uuid4().hex}"
    write_by_key(rows, name, "transaction_id", 4)
    plain = spark.createDataFrame(rows.collect(), rows.schema)
    return ChainMap(stored_tables(spark, "ledger", name), t), ChainMap({"ledger": plain}, t)


def test_hot_transactions_are_stored_apart(stored):
    t, plain = stored
    assert [r[0] for r in t["ledger_hot"].select("transaction_id").distinct().collect()] == [77]
    assert t["ledger"].count() + t["ledger_hot"].count() == plain["ledger"].count()


@pytest.mark.parametrize("step", sorted(STEPS))
def test_stored_ledger_is_not_shuffled(spark, stored, no_broadcast, step):
    t, plain = stored
    alone = {"ledger": t["ledger"]}
    assert "Exchange" in plan_text(STEPS[step](plain))
    assert "Exchange" not in plan_text(STEPS[step](alone))
    rows = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    assert rows(STEPS[step](t)) == rows(STEPS[step](plain))


def test_reports_on_a_stored_ledger(stored):
    t, plain = stored
    args = dict(program=AGENT_PROGRAM, generated_at=GENERATED_AT)
    for report in (lambda x: L.external_ledger(x, **args), lambda x: L.external_ledger_first_last(x, **args),
                   lambda x: L.early_month_cleared_totals(x, EVENT_AS_OF), lambda x: L.merchant_spend(x, EVENT_AS_OF)):
        assert sorted(map(str, report(t).collect())) == sorted(map(str, report(plain).collect()))


# ---- plans of the reworked reports

@pytest.mark.parametrize("strict", [False, True])
def test_address_facts_are_aggregated_once(spark, no_broadcast, strict):
    plan = plan_text(N.reapplication_report(fixture_tables(spark, SF_SMALL), strict_address=strict))
    tree = plan.split("Initial Plan")[-1]
    by_address = re.findall(r"HashAggregate\(keys=\[app_user_id#\d+L?, app_addr#\d+\]", tree)
    assert len(by_address) == 2         # its map side and its reduce side
    assert len(re.findall("Exchange hashpartitioning", tree)) <= 13


def test_a_user_whose_other_address_lapsed(spark):
    """The count per user reaches applications at addresses without loans, and with none."""
    loan = "_id long, loan_application_id long, user_id long, slug string, status string, is_ach_only boolean, portfolio string, " \
           "principal long, authorized_at timestamp_ntz, origination_date date, program string, withdrawal_reason string"
    day = dt.datetime(2020, 1, 1)
    row = lambda i, status, dated, at=day: (i, i, 1, f"L{i}", status, None, "M", i, at, dt.date(2020, 1, 1) if dated else None, "p", None)
    t = {"loans": spark.createDataFrame([row(1, "EXPIRED", True), row(2, "EXPIRED", True), row(3, "ACTIVE", False),
                                         row(4, "ACTIVE", True, day + dt.timedelta(1)), row(5, "ACTIVE", False)], loan),
         "applications": spark.createDataFrame([(1, 1, "aaaaa1"), (2, 1, "aaaaa2"), (3, 1, "bbbbb"), (4, 1, None), (5, None, "aaaaa")],
                                               "_id long, user_id long, address_hash string")
         .selectExpr("*", "'s' AS state", "'l' AS listing_address_line1", "'A' AS agent_id"),
         "users": spark.createDataFrame([(1, "F", "L", "NY")], "_id long, first_name string, last_name string, state string")}
    got = {(r.loan_id, r.reapplication_rules, r.billable_account) for r in N.reapplication_report(t).collect()}
    assert got == {("L1", "REAPP_ORIGINAL_RULE2", "Billable_loan"), ("L2", "REAPP_ORIGINAL_RULE2", "Billable_loan"),
                   ("L3", "REAPP_NEW_RULE2", "FALSE"), ("L4", "REAPP_NEW_RULE2", "FALSE"), ("L5", "FALSE", "FALSE")}


def test_tape_needs_no_distinct_over_its_columns(spark, no_broadcast):
    t = fixture_tables(spark, SF_MID)
    for table, key in (("loans", "_id"), ("loans", "slug"), ("users", "_id"), ("applications", "_id")):
        assert t[table].count() == t[table].select(key).distinct().count()
    df = R.remittance_report(t, cutoff=CUTOFF, generated_on=GENERATED_ON, program=HOME_PROGRAM, exclude_portfolio=TEST_PORTFOLIO,
                             base_url=BASE_URL, servicing_fee_account=SERVICING_FEE_ACCOUNT)
    assert not re.search(r"hashpartitioning\([^()]*borrower_link", plan_text(df))
    rows = df.collect()
    assert len(rows) == len(set(rows)) > 1000


# ---- data that decides

def test_sums_over_transactions_decide_the_totals(duck):
    sql = ORACLE_SQL["early_month_totals"]
    good = sorted(map(str, duck.execute(sql).fetchall()))
    for mutant in (sql.replace("SUM(", "MAX("), sql.replace("SUM(", "MIN("), sql.replace("'repayment'", "'disbursement'"),
                   sql.replace("GROUP BY loan_id, user_id", "GROUP BY loan_id, user_id, transaction_id")):
        assert mutant != sql and sorted(map(str, duck.execute(mutant).fetchall())) != good


def test_every_brand_pattern_decides(spark):
    t = fixture_tables(spark, SF_MID)
    tables = {"ledger": t["ledger"], "transaction_party": t["branded_party"]}
    counts = lambda brands: {r.acceptor: r.transactions for r in L.merchant_spend(tables, BRANDS_AS_OF, brands).collect()}
    whole = counts(L.BRANDS)
    assert {label for label, _ in L.BRANDS} <= set(whole)
    assert {"HOME DEPOT", "BIGPODS", "WEST ELM", "ACE  HARDWARE"} <= set(whole)
    for i, (label, patterns) in enumerate(L.BRANDS):
        for p in patterns:
            less = tuple(x for x in patterns if x != p)
            assert counts((*L.BRANDS[:i], (label, less), *L.BRANDS[i + 1:]) if less else (*L.BRANDS[:i], *L.BRANDS[i + 1:])) != whole, p
    bare = tuple((label, tuple(p.replace("%PODS %", "%PODS%") for p in patterns)) for label, patterns in L.BRANDS)
    assert counts(bare)["PODS"] == whole["PODS"] + whole["BIGPODS"]


def test_report_for_a_list_of_users(spark):
    rows = QUERIES["reapplication_report_users"](spark, SF_MID).select("user_id").distinct().collect()
    assert len(rows) > 100 and all(r.user_id % 3 == 1 for r in rows)


def test_orders_newest_and_oldest_put_nulls_as_postgres_does(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x long")
    assert [r.x for r in df.orderBy(newest("x")).collect()] == [None, 3, 1]
    assert [r.x for r in df.orderBy(oldest("x")).collect()] == [1, 3, None]
