"""Loan activity reports: acceleration events, upsizes, snapshots, reapplications."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.functions.text import addr5, pg_concat
from tally.functions.time import (
    from_ny_wall,
    ny_date,
    ny_midnight_utc,
    ny_wall_before,
    ntz_lit,
    pg_to_char,
    to_ny_wall,
)
from tally.operators.latest import latest_facts, oldest
from tally.operators.materialize import materialize
from tally.operators.optional import optional_filters
from tally.operators.partitions import prune_months

Tables = Mapping[str, DataFrame]

SNAPSHOT_TIEBREAK = ("line", "part")
SNAPSHOT_FACTS = ("status", "active_acceleration_event_date", "active_acceleration_event_type",
                  "first_disbursement_datetime", "last_repayment_datetime", "repayment_status")


def acceleration_events(t: Tables, as_of: dt.date) -> DataFrame:
    """Distinct non-cancelled acceleration events up to ``as_of``.

    Imported events pass on their own ``date``; every event also passes on
    its New York creation date. A NULL ``canceled`` flag drops the row.
    """
    ae = t["acceleration_events"]
    day = F.lit(as_of)
    keep = (((F.lower(F.col("notes")) == "automated import") & (F.col("date") <= day))
            | ny_wall_before("created_at", as_of + dt.timedelta(days=1)))
    return (ae.filter(keep & (F.col("canceled") != F.lit(True)))
              .select("loan_id", "canceled", F.col("type").alias("loan_type"),
                      ny_date("created_at").alias("created_at"), "notes",
                      pg_to_char("date", "mm/dd/yyyy").alias("acceleration_event_date"))
              .distinct())


def upsizes(t: Tables) -> DataFrame:
    """Positive principal adjustments with the time since authorization.

    The source prints two columns named ``time_to_upsize``: the instant of New
    York midnight of the authorization date (here ``authorized_at_et``; the
    inner conversion drops the zone, so the outer one goes from wall time) and a difference that mixes a wall time with an instant. The latter is
    built as meant: adjustment instant minus authorization instant, as an
    interval (``time_to_upsize``) and in microseconds.
    """
    lpa = t["loan_principal_adjustment"].filter(F.col("adjustment_amount") > 0)
    loans = t["loans"].select(F.col("_id"), F.col("authorized_at"))
    joined = lpa.join(loans, lpa["loan_id"] == loans["_id"], "inner")
    created, authorized = lpa["created_at"], loans["authorized_at"]
    return joined.select(
        "adjustment_amount",
        ny_date(created).alias("lpa_created_at"),
        lpa["loan_id"],
        from_ny_wall(F.to_date(authorized)).alias("authorized_at_et"),
        (created - authorized).alias("time_to_upsize"),
        (F.unix_micros(created.cast("timestamp"))
         - F.unix_micros(authorized.cast("timestamp"))).alias("time_to_upsize_micros"),
    )


def _snapshots_as_of(t: Tables, as_of: dt.date, tiebreak: Sequence[str]) -> DataFrame:
    """Newest snapshot per loan created (New York time) at or before ``as_of`` midnight.

    The source keeps an arbitrary row per loan; this keeps the newest, ties
    broken by ``tiebreak`` (or by the reported columns if the table lacks it).
    """
    s = prune_months(t["loan_snapshots"], "created_at", hi=ny_midnight_utc(as_of))
    rows = s.filter(ny_wall_before("created_at", as_of, inclusive=True))
    return latest_facts(rows, "loan_id", "created_at", SNAPSHOT_FACTS, tiebreak)


def _snapshot_columns() -> list[Column]:
    return [
        F.col("loan_id"), F.col("status"),
        to_ny_wall("active_acceleration_event_date").alias("acceleration_event_date"),
        F.col("active_acceleration_event_type").alias("acceleration_event_type"),
        to_ny_wall("first_disbursement_datetime").alias("first_disbursement_datetime"),
        to_ny_wall("last_repayment_datetime").alias("last_repayment_datetime"),
        pg_to_char(to_ny_wall("last_repayment_datetime"), "MM/DD/YYYY")
        .alias("last_repayment_date_est"),
        F.col("repayment_status"),
        to_ny_wall("created_at").alias("created_at"),
    ]


def loan_snapshots_current(t: Tables, as_of: dt.date,
                           tiebreak: Sequence[str] = SNAPSHOT_TIEBREAK) -> DataFrame:
    """Current snapshot per loan as of ``as_of``, times in New York wall time."""
    return _snapshots_as_of(t, as_of, tiebreak).select(*_snapshot_columns())


def loan_snapshots_collections(t: Tables, as_of: dt.date,
                               tiebreak: Sequence[str] = SNAPSHOT_TIEBREAK) -> DataFrame:
    """Current snapshot of every known loan plus its date added to collections.

    That date is the acceleration date when it is earlier than origination +
    12 months, else origination + 12 months (NULL acceleration gives the
    latter, NULL origination gives NULL). Loans without a snapshot are not
    reported. Picking the newest snapshot before the join is the same as
    after it, because a loan id names one loan.
    """
    current = _snapshots_as_of(t, as_of, tiebreak)
    loans = t["loans"].select(F.col("_id").alias("loan_id"), "origination_date")
    joined = current.join(loans, "loan_id", "inner")
    accel = F.col("active_acceleration_event_date")
    limit = F.add_months(F.col("origination_date"), 12).cast("timestamp_ntz")
    added = F.when(accel < limit, accel).otherwise(limit)
    return joined.select(*_snapshot_columns(),
                         pg_to_char(added, "MM-DD-YYYY").alias("date_added_to_collections"))


# --- reapplications ------------------------------------------------------

def application_loans(t: Tables) -> DataFrame:
    """Loans joined to their applications, with every column the reapplication
    branches read (one relation, so the report can materialise it once)."""
    apps, loans = t["applications"], t["loans"]
    return (apps.join(loans, apps["_id"] == loans["loan_application_id"], "inner")
                .select(apps["_id"].alias("app_id"), apps["user_id"].alias("app_user_id"),
                        addr5(apps["address_hash"]).alias("address_hash"),
                        apps["listing_address_line1"], apps["agent_id"],
                        apps["state"].alias("app_state"),
                        loans["user_id"].alias("loan_user_id"), loans["slug"],
                        loans["status"].alias("loan_status"), loans["is_ach_only"],
                        loans["portfolio"], loans["principal"], loans["authorized_at"],
                        loans["origination_date"], loans["program"],
                        loans["withdrawal_reason"]))


def _reapplications(j: DataFrame) -> DataFrame:
    orig = j.filter(F.col("origination_date").isNotNull())
    counts = (orig.groupBy(F.col("loan_user_id").alias("user_id"), "address_hash")
                  .agg(F.count("loan_user_id").alias("user_count"))
                  .filter(F.col("user_count") > 1))
    # Reapplying applications: one per distinct (loan user, application).
    reapplying = (orig.filter(F.col("withdrawal_reason").like("USER_REAPPLYING%"))
                      .select(F.col("loan_user_id").alias("user_id"), "app_id", "address_hash")
                      .distinct())
    return (reapplying.join(counts, ["user_id", "address_hash"], "inner")
                      .select("user_id", "user_count", "address_hash"))


def reapplications(t: Tables) -> DataFrame:
    """Users with more than one originated loan at one address and a reapplying withdrawal.

    One row per reapplying application (user, address key, loan count).
    ``LIKE 'USER_REAPPLYING%'``: the underscores are one-character wildcards.
    """
    return _reapplications(application_loans(t))


def _reapplications_expired(j: DataFrame) -> DataFrame:
    orig = j.filter(F.col("origination_date").isNotNull() & F.col("app_user_id").isNotNull()
                    & F.col("address_hash").isNotNull())
    counts = orig.groupBy("app_user_id", "address_hash").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("loan_status") == "EXPIRED", F.lit(1))).alias("m"))
    return (counts.select((F.col("n") * F.col("m")).alias("user_count"),
                          F.col("app_user_id").alias("user_id"), "address_hash")
                  .filter(F.col("user_count") > 1))


def reapplications_expired(t: Tables) -> DataFrame:
    """Per (user, address key): originated loans x expired originated loans, when > 1.

    The source counts the rows of a join that pairs every originated loan
    with every expired one at the same user and address. That count is the
    product of the two per-key counts, taken here in one aggregate; the pairs
    are never materialised.
    """
    return _reapplications_expired(application_loans(t))


def first_expired_authorization(t: Tables) -> DataFrame:
    """First authorization time of each user's expired, originated loans."""
    return (t["loans"]
            .filter((F.col("status") == "EXPIRED") & F.col("origination_date").isNotNull())
            .groupBy("user_id")
            .agg(F.min("authorized_at").alias("original_authorized_at")))


def _address_facts(j: DataFrame) -> DataFrame:
    """What the report looks up per (application's user, address), in one aggregate.

    ``has_reapp``: the key has a reapplying originated loan and more than one
    originated loan, counted by the *loan's* user (the reapplications CTE).
    ``expired_here``: originated x expired-originated loans > 1, counted by
    the *application's* user (the expired-reapplications CTE).
    ``expired_groups``: how many addresses of the user are ``expired_here``.

    The two views of the loans are stacked under one key column (two rows per
    loan from one pass), so one aggregate serves both, and a user with a third
    of all loans splits by address. Keys of loans that are not originated are
    in it too, so every application of a user with any fact finds its key. The
    count per user is a window over the aggregate's rows: an address key has
    five hex digits, so no user has more than 16^5 small rows there. Users
    without facts are left out; a NULL address is a key without facts.
    """
    dated, placed = F.col("origination_date").isNotNull(), F.col("address_hash").isNotNull()
    views = F.array(
        F.struct(F.col("loan_user_id").alias("user"), (dated & placed).alias("own"),
                 (dated & placed & F.col("withdrawal_reason").like("USER_REAPPLYING%")).alias("reapplying"),
                 F.lit(False).alias("applied"), F.lit(False).alias("expired")),
        F.struct(F.col("app_user_id").alias("user"), F.lit(False).alias("own"), F.lit(False).alias("reapplying"),
                 (dated & placed).alias("applied"), (dated & placed & (F.col("loan_status") == "EXPIRED")).alias("expired")))
    stacked = (j.select(F.col("address_hash").alias("app_addr"), F.explode(views).alias("v"))
                .select(F.col("v.user").alias("app_user_id"), "app_addr", "v.*").drop("user")
                .filter(F.col("app_user_id").isNotNull()))
    facts = stacked.groupBy("app_user_id", "app_addr").agg(
        ((F.count_if("own") > 1) & (F.count_if("reapplying") > 0)).alias("has_reapp"),
        (F.count_if("applied") * F.count_if("expired") > 1).alias("expired_here"))
    user = Window.partitionBy("app_user_id")
    return (facts.withColumns({"expired_groups": F.count_if("expired_here").over(user),
                               "any_fact": F.max(F.col("has_reapp") | F.col("expired_here")).over(user)})
                 .filter("any_fact").drop("any_fact"))


REAPPLICATION_COLUMNS = (
    "user_id", "loan_application_id", "loan_id", "borrower_name", "listing_address_line1",
    "home_state", "loan_type", "current_status", "facility", "loan_amount", "billable_date",
    "reapplication_rules", "reapplication_results", "program", "test_account",
    "billable_account",
)


def reapplication_report(t: Tables, *, test_agents: Sequence[str] = (),
                         exclude_users: Sequence = (), state: str | None = None,
                         amount_min=None, amount_max=None,
                         start: dt.datetime | None = None, end: dt.datetime | None = None,
                         status: str | None = None, reapplication: str | None = None,
                         test_account: str | None = None, program: str | None = None,
                         user_id=None, strict_address: bool = False,
                         materialize_shared: bool = False) -> DataFrame:
    """Reapplication and billing classification of every authorized loan.

    ``strict_address=False`` keeps the source's join as written: expired
    reapplications match on the user only, and the address test sits on the
    first-expired join. A loan then yields one row per billing label its
    user's address groups produce ('Billable_loan' and/or 'FALSE'); that set
    is computed from per-user counts, without forming the pairs.
    ``strict_address=True`` is the presumably intended form: the address
    test moves to the expired-reapplications join (user and address) and the
    first-expired join is on the user only, one row per loan.

    The loans-applications join feeds two branches (the report rows and the
    address facts, which come from one aggregate). ``materialize_shared``
    checkpoints it once to the shared checkpoint folder instead of computing
    it twice; that runs a job when the report is built (the plan is no longer
    lazy), so it is off by default and pays off when the join is expensive
    to recompute or the report is run repeatedly.

    Optional filters: ``state``, ``amount_min``+``amount_max`` (both or
    neither), ``start``/``end`` (inclusive, on authorization time),
    ``status``, ``reapplication`` (result label), ``test_account``
    ('true'/'false'), ``program``, ``user_id`` (one id, or a list of ids).
    """
    users = t["users"]
    j = application_loans(t)
    if materialize_shared:
        j = materialize(j)
    base = j.filter(F.col("authorized_at").isNotNull())
    user_join = "inner" if (exclude_users or user_id is not None) else "left"
    base = base.join(users, base["loan_user_id"] == users["_id"], user_join)
    base = base.select(
        F.col("loan_user_id").alias("user_id"), "app_user_id",
        F.col("address_hash").alias("app_addr"),
        F.col("app_id").alias("loan_application_id"), F.col("slug").alias("loan_id"),
        F.upper(pg_concat(users["first_name"], " ", users["last_name"])).alias("borrower_name"),
        "listing_address_line1", users["state"].alias("home_state"),
        F.when(F.col("is_ach_only") == F.lit(True), "ACH").otherwise("CARD").alias("loan_type"),
        F.col("loan_status").alias("current_status"), F.col("portfolio").alias("facility"),
        F.col("principal").alias("loan_amount"), F.col("authorized_at").alias("billable_date"),
        "origination_date", "program",
        F.when(F.col("agent_id").isin(list(test_agents)), True).otherwise(False)
        .alias("test_account") if test_agents else F.lit(False).alias("test_account"),
        users["_id"].alias("users_id"), "app_state",
    )

    facts = _address_facts(j).withColumnsRenamed({"app_user_id": "f_user", "app_addr": "f_addr"})
    firsts = first_expired_authorization(t).select(F.col("user_id"),
                                                   "original_authorized_at",
                                                   F.lit(True).alias("has_first"))
    # The users join left the rows partitioned by the loan's user, the key of
    # the first-expired join, so that join comes first (no re-shuffle).
    rows = (base.join(firsts, "user_id", "left")
                .join(facts, (F.col("app_user_id") == F.col("f_user"))
                      & F.col("app_addr").eqNullSafe(F.col("f_addr")), "left"))
    billable = (F.coalesce(F.col("has_first"), F.lit(False))
                & (F.col("billable_date") == F.col("original_authorized_at")))
    here = F.coalesce(F.col("expired_here"), F.lit(False))
    if strict_address:
        has_expired = here
        labels = F.array(F.when(billable, "Billable_loan").otherwise("FALSE"))
    else:
        groups = F.coalesce(F.col("expired_groups"), F.lit(0))
        has_expired = groups > 0
        hit = here & F.coalesce(billable, F.lit(False))
        labels = F.filter(F.array(F.when(hit, F.lit("Billable_loan")),
                                  F.when(~((groups == 1) & hit), F.lit("FALSE"))),
                          lambda x: x.isNotNull())
    rows = rows.withColumn("billable_account", F.explode(labels))

    # Rule 1: reapplied here; rule 2: a loan here lapsed. An expired loan is an
    # original one, told apart by having an origination date; others are new.
    rule = (F.when(F.coalesce(F.col("has_reapp"), F.lit(False)), 1)
             .when(has_expired, 2).otherwise(0))
    original = F.coalesce(F.col("current_status") == "EXPIRED", F.lit(False))
    undated = original & F.col("origination_date").isNull()
    label = F.concat(F.when(original, "REAPP_ORIGINAL").otherwise("REAPP_NEW"),
                     F.when(undated, F.when(rule == 1, "_no_date").otherwise("_no_date_expired"))
                      .otherwise(F.concat(F.lit("_RULE"), rule)))
    rows = (rows.withColumn("reapplication_rules", F.when(rule > 0, label).otherwise("FALSE"))
                .withColumn("reapplication_results",
                            F.when((rule > 0) & ~undated, "REAPP").otherwise("FALSE")))

    both = None if amount_min is None or amount_max is None else (amount_min, amount_max)
    rows = optional_filters(rows, [
        (state, lambda v: F.col("app_state").cast("string") == F.lit(v)),
        (both, lambda v: (F.col("loan_amount") >= F.lit(v[0])) & (F.col("loan_amount") <= F.lit(v[1]))),
        (start, lambda v: F.col("billable_date") >= ntz_lit(v)),
        (end, lambda v: F.col("billable_date") <= ntz_lit(v)),
        (status, lambda v: F.col("current_status").cast("string") == F.lit(v)),
        (reapplication, lambda v: F.col("reapplication_results").cast("string") == F.lit(v)),
        (test_account, lambda v: F.col("test_account").cast("string") == F.lit(v)),
        (program, lambda v: F.col("program").cast("string") == F.lit(v)),
        (user_id, lambda v: (F.col("users_id").isin(list(v))
                             if isinstance(v, (list, tuple, set, frozenset))
                             else F.col("users_id") == F.lit(v))),
    ])
    if exclude_users:
        rows = rows.filter(~F.col("users_id").isin(list(exclude_users)))
    # Ordered by user as the source is; the extra keys make the order total,
    # so a user holding a third of all loans still splits across range
    # partitions instead of landing in one sort task.
    return (rows.select(*REAPPLICATION_COLUMNS).distinct()
                .orderBy(oldest("user_id"), oldest("loan_application_id"), oldest("loan_id"),
                         oldest("billable_account")))
