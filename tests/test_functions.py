"""Building blocks: date spine, as-of attachment, exact money sums, moments, safe ratios."""

import datetime as dt
import math
import statistics
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlens.functions import dates as D
from marketlens.functions.money import to_double, units, units_at
from marketlens.functions.ratios import safe_ratio, stddev_from_moments


def test_month_starts_and_bounds():
    spine = D.month_starts("2017-01-01", "2018-07-01")
    assert len(spine) == 19 and spine[0] == dt.date(2017, 1, 1) and spine[-1] == dt.date(2018, 7, 1)
    assert D.month_starts("2016-12-15", "2017-02-01") == [dt.date(2016, 12, 1), dt.date(2017, 1, 1),
                                                          dt.date(2017, 2, 1)]
    assert D.snapshot_dates(["2018-02-01", "2018-01-01", "2018-02-01"]) == (dt.date(2018, 1, 1),
                                                                           dt.date(2018, 2, 1))
    assert D.snapshot_dates(["2018-02-01 00:00:00", dt.datetime(2018, 2, 1)]) == (dt.date(2018, 2, 1),)
    for late in ("2018-07-01 12:00:00", dt.datetime(2018, 7, 1, 12)):
        with pytest.raises(ValueError):  # a time of day is not cut off
            D.snapshot_dates(late)


def test_as_of_exclusive_inclusive_and_many(spark):
    df = spark.createDataFrame([(1, dt.datetime(2018, 1, 31, 23)), (2, dt.datetime(2018, 2, 1)),
                                (3, dt.datetime(2018, 2, 15))], "id int, ts timestamp_ntz")
    got = {(r.id, r.dtRef) for r in D.as_of(df, "ts", ["2018-02-01", "2018-03-01"]).collect()}
    assert got == {(1, dt.date(2018, 2, 1)), (1, dt.date(2018, 3, 1)), (2, dt.date(2018, 3, 1)),
                   (3, dt.date(2018, 3, 1))}
    assert {r.id for r in D.as_of(df, "ts", "2018-02-01").collect()} == {1}
    assert {r.id for r in D.as_of(df, "ts", "2018-02-01", inclusive=True).collect()} == {1, 2}


cents = st.decimals(min_value=Decimal("-99999999.99"), max_value=Decimal("99999999.99"), places=2,
                    allow_nan=False, allow_infinity=False)


@settings(max_examples=20, deadline=None)
@given(st.lists(cents, min_size=1, max_size=40))
def test_unit_sums_equal_exact_decimal_sums(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x decimal(12,2)")
    u, scale = units(df, "x")
    assert scale == 2
    got = df.agg(to_double(F.sum(u), scale).alias("s")).first().s
    assert got == float(sum(values))          # correctly rounded exact sum, bit for bit
    (a, b), common = units_at(df.withColumn("y", F.col("x").cast("decimal(12,4)")), ["x", "y"])
    assert common == 4


def test_moments_stddev_and_safe_ratio(spark):
    xs = [1, 5, 5, 2, 4]
    df = spark.createDataFrame([(x,) for x in xs], "x int")
    r = df.agg(stddev_from_moments(F.count("x"), F.sum("x"), F.sum(F.col("x") * F.col("x"))).alias("sd"),
               safe_ratio(F.sum("x"), F.lit(0)).alias("z"), safe_ratio(F.sum("x"), F.lit(0), 0.0).alias("z0")).first()
    assert math.isclose(r.sd, statistics.stdev(xs), rel_tol=1e-15)
    assert r.z is None and r.z0 == 0.0
    one = spark.createDataFrame([(3,)], "x int").agg(
        stddev_from_moments(F.count("x"), F.sum("x"), F.sum(F.col("x") * F.col("x"))).alias("sd")).first()
    assert one.sd is None
