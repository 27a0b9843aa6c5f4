"""Latest-per-key, void anti-join, pivot and optional filters."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tally.operators.latest import first_value_per_key, latest_per_key, newest, oldest
from tally.operators.optional import optional_filters
from tally.operators.pivot import pivot_sums
from tally.operators.voids import void_cutoffs, without_earlier_than

T0 = dt.datetime(2024, 1, 1)


def ts(h):
    return None if h is None else T0 + dt.timedelta(hours=h)


def test_newest_puts_null_first_like_postgres_desc(spark):
    df = spark.createDataFrame([(1, None, 1), (1, ts(5), 2), (2, ts(1), 3), (2, ts(2), 4)],
                               "k int, t timestamp_ntz, id int")
    got = {r.k: r.id for r in latest_per_key(df, ["k"], [newest("t"), newest("id")]).collect()}
    assert got == {1: 1, 2: 4}
    got = {r.k: r.id for r in latest_per_key(df, ["k"], [oldest("t"), oldest("id")]).collect()}
    assert got == {1: 2, 2: 3}


def test_first_value_per_key_matches_distinct_on(spark):
    df = spark.createDataFrame([(1, None), (1, ts(5)), (2, ts(1)), (2, ts(2)), (3, None)],
                               "k int, t timestamp_ntz")
    asc = {r.k: r.t for r in first_value_per_key(df, ["k"], "t", earliest=True).collect()}
    desc = {r.k: r.t for r in first_value_per_key(df, ["k"], "t", earliest=False).collect()}
    assert asc == {1: ts(5), 2: ts(1), 3: None}
    assert desc == {1: None, 2: ts(2), 3: None}


rows_strategy = st.lists(
    st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 6))),
    min_size=1, max_size=25)


@settings(max_examples=12, deadline=None)
@given(rows_strategy, st.randoms())
def test_latest_per_key_one_row_and_order_invariant(spark, rows, rnd):
    data = [(k, ts(h), i) for i, (k, h) in enumerate(rows)]
    shuffled = data[:]
    rnd.shuffle(shuffled)

    def run(d):
        df = spark.createDataFrame(d, "k int, t timestamp_ntz, id int").repartition(3)
        out = latest_per_key(df, ["k"], [newest("t"), newest("id")]).collect()
        return sorted((r.k, r.id) for r in out)

    def expected():
        best = {}
        for k, t, i in data:
            key = (t is None, t or T0, i)      # NULL first, then newest, then id
            if k not in best or key > best[k][0]:
                best[k] = (key, i)
        return sorted((k, v[1]) for k, v in best.items())

    got = run(shuffled)
    assert got == expected()
    assert len({k for k, _ in got}) == len(got)


def test_without_earlier_than_null_and_equal_rows_survive(spark):
    rows = spark.createDataFrame(
        [(1, ts(1)), (1, ts(3)), (1, None), (2, ts(1))], "k int, created_at timestamp_ntz")
    voids = spark.createDataFrame([(1, ts(3)), (1, ts(2))], "k int, created_at timestamp_ntz")
    cut = void_cutoffs(voids, "k", "created_at", latest=True)
    got = sorted((r.k, r.created_at is None, r.created_at or T0)
                 for r in without_earlier_than(rows, cut, "k", "created_at").collect())
    # ts(1) < latest void ts(3) is dropped; ts(3) (not strictly earlier) and NULL stay.
    assert got == [(1, False, ts(3)), (1, True, T0), (2, False, ts(1))]
    earliest = void_cutoffs(voids, "k", "created_at", latest=False)
    got = sorted(r.created_at or T0 for r in
                 without_earlier_than(rows, earliest, "k", "created_at").collect()
                 if r.k == 1)
    assert got == [T0, ts(3)]     # only ts(1) < ts(2) is dropped


def test_latest_void_with_null_time_cancels_nothing(spark):
    rows = spark.createDataFrame([(1, ts(1))], "k int, created_at timestamp_ntz")
    voids = spark.createDataFrame([(1, ts(3)), (1, None)], "k int, created_at timestamp_ntz")
    cut = void_cutoffs(voids, "k", "created_at", latest=True)
    assert without_earlier_than(rows, cut, "k", "created_at").count() == 1


def test_pivot_missing_key_is_null(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 2), (1, "b", 1), (2, "b", 7)],
                               "k int, acc string, v int")
    got = {r.k: (r.a, r.b, r.c) for r in
           pivot_sums(df, ["k"], "acc", ["a", "b", "c"], F.col("v")).collect()}
    assert got == {1: (7, 1, None), 2: (None, 7, None)}


def test_optional_filters_skip_none(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "x int")
    out = optional_filters(df, [(None, lambda v: F.col("x") == v),
                                (3, lambda v: F.col("x") > v)])
    assert out.count() == 6
