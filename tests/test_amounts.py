"""256-bit amounts against Python integers."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from transferlens.functions.amounts import (
    DecimalAmounts,
    U256Amounts,
    aggregate,
    u256_from_hex,
    u256_from_long,
    u256_from_text,
)

U = U256Amounts()
EDGES = [0, 1, 2**20, 2**60 - 1, 2**60, 2**120 - 1, 2**120, 10**26, 10**30, 10**52, 10**77, 2**255, 2**256 - 1]


def numbers(seed, count=2000):
    random.seed(seed)
    return EDGES + [random.getrandbits(random.randint(1, 256)) for _ in range(count)]


def frame(spark, values):
    data = [(i, i % 7, format(v, "064x"), str(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "i int, k int, digits string, text string")


def test_hex_and_text_agree_and_render(spark):
    values = numbers(1)
    df = frame(spark, values).select(
        "i", u256_from_hex(F.col("digits")).alias("a"), u256_from_text(F.col("text")).alias("b")
    )
    found = df.select(
        "i", (F.col("a") == F.col("b")).alias("same"), U.to_text(F.col("a")).alias("text"), U.to_double(F.col("a")).alias("d")
    ).collect()
    assert len(found) == len(values)
    for row in found:
        value = values[row.i]
        assert row.same and row.text == str(value)
        assert abs(row.d - value) <= 4e-16 * value


def test_long_and_too_long_text(spark):
    df = spark.createDataFrame([(0,), (2**62,), (2**63 - 1,)], "n bigint")
    found = df.select("n", U.to_text(u256_from_long(F.col("n"))).alias("text")).collect()
    assert all(row.text == str(row.n) for row in found)
    with pytest.raises(PySparkException):
        spark.createDataFrame([("1" * 79,)], "t string").select(u256_from_text(F.col("t"))).collect()


def test_signed_sums(spark):
    values = numbers(2)
    df = frame(spark, values).withColumn("value", u256_from_hex(F.col("digits")))
    delta = F.when(F.col("i") % 2 == 0, F.col("value")).otherwise(U.negate(F.col("value")))
    sums = df.select("k", delta.alias("delta")).groupBy("k").agg(U.total(F.col("delta")).alias("x"))
    for row in sums.select("k", U.to_text(F.col("x")).alias("text"), U.positive(F.col("x")).alias("positive")).collect():
        expected = sum(v if i % 2 == 0 else -v for i, v in enumerate(values) if i % 7 == row.k)
        assert row.text == str(expected) and row.positive == (expected > 0)


def test_positive_sums_before_the_carry(spark):
    """Sums around 0, also those whose parts have another sign than the whole."""
    totals = [0, 1, -1, 2**20, -(2**20), 2**240, -(2**240), 2**240 - 1, 1 - 2**240, 2**255, -(2**255), 2**60 - 1, -(2**60)]
    pairs = [(k, str(max(n, 0) + 2**250), True) for k, n in enumerate(totals)] + [(k, str(max(-n, 0) + 2**250), False) for k, n in enumerate(totals)]
    df = spark.createDataFrame(pairs, "k int, digits string, plus boolean").repartition(3)
    value = u256_from_text(F.col("digits"))
    df = df.select("k", F.when(F.col("plus"), value).otherwise(U.negate(value)).alias("delta"))
    kept = {r.k: r.text for r in aggregate(df, ["k"], [], {"x": "delta"}, positive="x").select("k", U.to_text(F.col("x")).alias("text")).collect()}
    assert kept == {k: str(n) for k, n in enumerate(totals) if n > 0}


def test_order_summary_and_bounds(spark):
    values = numbers(3)
    df = frame(spark, values).withColumn("value", u256_from_hex(F.col("digits")))
    ordered = [r.text for r in df.orderBy(F.desc("value")).select("text").collect()]
    assert ordered == [str(v) for v in sorted(values, reverse=True)]
    summary = U.summary(df, ["k"]).select(
        "k", "transfer_count", U.to_text(F.col("total_volume")).alias("t"), U.to_text(F.col("largest_transfer")).alias("m")
    )
    for row in summary.collect():
        group = [v for i, v in enumerate(values) if i % 7 == row.k]
        assert (row.transfer_count, row.t, row.m) == (len(group), str(sum(group)), str(max(group)))
    for bound in (0, 10**30, 2**120, 2**255):
        assert df.filter(U.exceeds(F.col("value"), bound)).count() == sum(v > bound for v in values)


def test_net_change(spark):
    df = spark.createDataFrame([("7", True, False), ("9", False, True), ("5", True, True)], "t string, i boolean, o boolean")
    for amounts, value in ((U, u256_from_text(F.col("t"))), (DecimalAmounts(), F.col("t").cast("decimal(38,0)"))):
        net = df.withColumn("value", value).select(amounts.net(F.col("i"), F.col("o"), F.col("value")).alias("d"))
        assert net.agg(amounts.to_text(amounts.total(F.col("d"))).alias("x")).first().x == "-2"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=0, max_value=2**256 - 1), min_size=1, max_size=40))
def test_sum_property(spark, values):
    df = frame(spark, values).select(u256_from_hex(F.col("digits")).alias("value"))
    assert df.agg(U.to_text(U.total(F.col("value"))).alias("x")).first().x == str(sum(values))


def test_decimal_overflow_raises(spark):
    df = spark.createDataFrame([("9" * 38,), ("9" * 38,)], "t string").select(F.col("t").cast("decimal(38,0)").alias("v"))
    with pytest.raises(PySparkException):
        df.agg(DecimalAmounts().total(F.col("v"))).collect()
