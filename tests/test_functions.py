"""Unit traps for the Postgres-semantics column helpers."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tally.functions.money import clamp0, dollars, round2
from tally.functions.text import addr5, brand_key, pg_concat
from tally.functions.time import (
    from_ny_wall,
    ny_date,
    ny_midnight_utc,
    pg_to_char,
    report_timestamp_text,
    spark_pattern,
    to_ny_wall,
)


def one(spark, expr, ddl="x string", rows=((None,),)):
    return spark.createDataFrame(list(rows), ddl).select(expr.alias("v")).collect()[0]["v"]


def test_pg_concat_skips_null(spark):
    df = spark.createDataFrame([(None, "L1"), ("F1", None), (None, None)], "a string, b string")
    got = [r[0] for r in df.select(pg_concat(F.col("a"), " ", F.col("b"))).collect()]
    assert got == [" L1", "F1 ", " "]
    # Spark's own concat would have returned NULL for all three.
    assert all(r[0] is None for r in df.select(F.concat("a", F.lit(" "), "b")).collect())


def test_to_char_patterns():
    assert spark_pattern("MM/DD/YYYY") == "MM'/'dd'/'yyyy"
    assert spark_pattern("mm/dd/yyyy") == "MM'/'dd'/'yyyy"   # mm is month in Postgres
    assert spark_pattern("YYYY-MM-DD") == "yyyy'-'MM'-'dd"
    assert spark_pattern("MM/DD/YYYY HH:MM") == "MM'/'dd'/'yyyy' 'hh':'MM"


def test_to_char_lowercase_month_and_legacy_clock(spark):
    ts = dt.datetime(2024, 7, 1, 13, 5)
    df = spark.createDataFrame([(ts,)], "t timestamp_ntz")
    row = df.select(pg_to_char("t", "mm/dd/yyyy").alias("a"),
                    F.date_format("t", "mm/dd/yyyy").alias("spark_mm"),
                    pg_to_char("t", "YYYY-MM-DD").alias("b")).collect()[0]
    assert row.a == "07/01/2024"
    assert row.spark_mm == "05/01/2024"       # the trap: Spark's mm is minutes
    assert row.b == "2024-07-01"
    legacy = df.select(report_timestamp_text(ts, legacy_format=True)).collect()[0][0]
    fixed = df.select(report_timestamp_text(ts)).collect()[0][0]
    assert legacy == "07/01/2024 01:07"       # 12-hour clock, then the month
    assert fixed == "07/01/2024 13:05"


def test_new_york_conversions(spark):
    rows = [(dt.datetime(2024, 1, 15, 3, 0),), (dt.datetime(2024, 7, 1, 3, 0),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = df.select(to_ny_wall("t").alias("w"), ny_date("t").alias("d"),
                    from_ny_wall(to_ny_wall("t")).alias("back")).collect()
    assert got[0].w == dt.datetime(2024, 1, 14, 22, 0)       # EST, UTC-5
    assert got[1].w == dt.datetime(2024, 6, 30, 23, 0)       # EDT, UTC-4
    assert got[0].d == dt.date(2024, 1, 14)
    assert [r.back for r in got] == [r[0] for r in rows]


def test_ny_midnight_bound_is_exact(spark):
    day = dt.date(2024, 3, 11)   # the day after the spring-forward change
    bound = ny_midnight_utc(day)
    assert bound == dt.datetime(2024, 3, 11, 4, 0)
    around = [bound - dt.timedelta(microseconds=1), bound, bound + dt.timedelta(microseconds=1)]
    df = spark.createDataFrame([(t,) for t in around], "t timestamp_ntz")
    wall_le = [r[0] for r in df.select(
        to_ny_wall("t") <= F.lit("2024-03-11 00:00:00").cast("timestamp_ntz")).collect()]
    assert wall_le == [t <= bound for t in around]


def test_brand_key_first_match_and_else(spark):
    brands = (("HOME", ("%HOMEDEPOT%", "%THE HOME DEPOT%")), ("PODS", ("%PODS %",)),
              ("AMAZON", ("%AMAZON%", "%AMZN%")))
    names = [("The Home Depot #12",), ("pods moving",), ("PODS",), ("amzn mktp",),
             ("corner shop",), (None,)]
    df = spark.createDataFrame(names, "n string")
    got = [r[0] for r in df.select(brand_key(F.col("n"), brands)).collect()]
    assert got == ["HOME", "PODS", "PODS", "AMAZON", "CORNER SHOP", None]


def test_like_underscore_is_a_wildcard(spark):
    df = spark.createDataFrame([("USER_REAPPLYING_NEW",), ("USERXREAPPLYING",), ("OTHER",)],
                               "w string")
    got = [r[0] for r in df.select(F.col("w").like("USER_REAPPLYING%")).collect()]
    assert got == [True, True, False]


def test_money_helpers(spark):
    df = spark.createDataFrame([(12345, None, Decimal("-0.125"))],
                               "c bigint, n bigint, d decimal(10,3)")
    row = df.select(dollars("c").alias("a"), dollars("c", as_double=False).alias("b"),
                    clamp0(F.col("n")).alias("z"), clamp0(F.lit(-5)).alias("neg"),
                    round2("d").alias("r"), addr5(F.lit("abcdefgh")).alias("h")).collect()[0]
    assert row.a == 123.45 and row.b == Decimal("123.45")
    assert row.z == 0 and row.neg == 0
    assert row.r == Decimal("-0.13")      # half away from zero
    assert row.h == "abcde"


def test_new_york_midnight_of_a_date_is_the_reverse_conversion(spark):
    import datetime as dt

    from pyspark.sql import functions as F
    from tally.functions.time import from_ny_wall
    rows = spark.createDataFrame([(dt.date(2024, 1, 15),), (dt.date(2024, 7, 1),)], "d date").select(
        from_ny_wall(F.col("d"))).collect()
    assert [r[0] for r in rows] == [dt.datetime(2024, 1, 15, 5), dt.datetime(2024, 7, 1, 4)]
