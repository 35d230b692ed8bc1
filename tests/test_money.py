"""Exact money arithmetic: sums rounded once, averages, lenient parsing."""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal, getcontext

from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions import (
    exact_avg,
    exact_decimal,
    exact_mean,
    exact_sum,
    exact_total,
    half_up_div,
    lenient_number,
    micro_part,
    summable,
    whole_part,
)

getcontext().prec = 60

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("x", T.DoubleType())])


def _agg(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    return {r["k"]: (r["s"], r["a"]) for r in df.groupBy("k").agg(
        exact_sum("x").alias("s"), exact_avg("x").alias("a")).collect()}


def test_sum_is_exact_where_double_sum_is_not(spark):
    data = [("a", 0.1)] * 10 + [("b", 89.9)] * 500
    out = _agg(spark, data)
    assert out["a"][0] == 1.0
    assert out["b"][0] == 44950.0
    assert out["b"][1] == 89.9  # a double average gives 89.9000000000002
    raw = spark.createDataFrame(data, SCHEMA).where("k = 'a'").agg(F.sum("x")).first()[0]
    assert raw != 1.0


def test_average_rounds_half_up_on_half_cent(spark):
    out = _agg(spark, [("a", 0.01), ("a", 0.02), ("b", 1.00), ("b", 1.01), ("c", -0.01), ("c", -0.02)])
    assert out["a"][1] == 0.02  # 0.015 -> 0.02
    assert out["b"][1] == 1.01  # 1.005 -> 1.01 (a double avg rounds to 1.0)
    assert out["c"][1] == -0.02  # half away from zero


def test_nulls_skipped_and_empty_groups_are_null(spark):
    out = _agg(spark, [("a", None), ("a", None), ("b", None), ("b", 2.5), ("c", -0.0)])
    assert out["a"] == (None, None)
    assert out["b"] == (2.5, 2.5)
    assert out["c"] == (0.0, 0.0)


def test_half_up_div_exact_for_large_values(spark):
    df = spark.createDataFrame([(4_611_686_018_427_387_903, 2), (5, 0), (7, 2), (-7, 2)], "n long, d long")
    got = [r["q"] for r in df.select(half_up_div(F.col("n"), F.col("d")).alias("q")).collect()]
    assert got == [2_305_843_009_213_693_952, None, 4, -4]


def test_lenient_number_rejects_dirty_text(spark):
    texts = ["12.50", " 7.25 ", "1e3", "", "abc", None, "150000", "1,000"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["v"] for r in df.select(lenient_number("t").alias("v")).collect()]
    assert got == [12.5, 7.25, 1000.0, None, None, None, 150000.0, None]


def test_sum_is_rounded_once_not_per_row(spark):
    def total(value, n):
        return spark.range(n).select(F.lit(value).alias("x")).agg(exact_sum("x").alias("s")).first()["s"]

    assert total(0.125, 1000) == 125.0
    assert total(0.004, 1000) == 4.0
    assert total(1.005, 1) == 1.01  # as round(1.005, 2) gives it
    assert total(-0.125, 1000) == -125.0


def test_mean_is_not_rounded(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 2.0), ("b", None)], SCHEMA)
    got = {r["k"]: r["m"] for r in df.groupBy("k").agg(exact_mean("x").alias("m")).collect()}
    assert got == {"a": 4 / 3, "b": None}


def test_amounts_beyond_the_fast_path(spark):
    values = [123456789012.34, -123456789012.34, 9999999999.999999, -0.000001, 4294967296.5, 1e17]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select(whole_part("x").alias("w"), micro_part("x").alias("m")).collect()
    for v, r in zip(values, got, strict=True):
        exact = Decimal(repr(v)).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)
        assert r["w"] + Decimal(r["m"]) / 1_000_000 == exact, v
    big = spark.range(1000).select(F.lit(1e15).alias("x")).agg(exact_sum("x").alias("s")).first()["s"]
    assert big == 1e18


def test_text_amounts_never_raise(spark):
    texts = ["10.25", "n/a", "", None, "NaN", "Infinity", " 0.755 ", "1e2"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    r = df.agg(exact_sum("x").alias("s"), exact_avg("x").alias("a"), exact_mean("x").alias("m")).first()
    assert (r["s"], r["a"], r["m"]) == (111.01, 37.0, 111.005 / 3)


money = st.integers(min_value=0, max_value=10_000_000).map(lambda c: c / 100)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), money), min_size=1, max_size=40))
def test_property_matches_decimal_arithmetic(spark, data):
    out = _agg(spark, data)
    for key in {k for k, _ in data}:
        values = [Decimal(str(v)) for k, v in data if k == key]
        total = sum(values)
        avg = (total / len(values)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert out[key][0] == float(total)
        assert out[key][1] == float(avg)


def test_cluster_conf_sizes_partitions_by_shuffle_volume():
    from tallyframe.session import ADVISORY_PARTITION_BYTES, cluster_conf

    small = cluster_conf(total_cores=8, largest_shuffle_bytes=10)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = cluster_conf(total_cores=4000, largest_shuffle_bytes=10 * 1024**4)  # 10 TB shuffle
    assert int(big["spark.sql.shuffle.partitions"]) == -(-10 * 1024**4 // ADVISORY_PARTITION_BYTES)


def test_half_up_div_agrees_with_integer_arithmetic(spark):
    cases = [(2**51 - 1, 3), (2**51 - 1, 2**40 + 7), (2**51, 3), (2**62 - 5, 7), (-(2**51) - 9, 4),
             (4_503_599_627_370_495, 2), (7, 3), (1, 2), (-1, 2), (3, 1_000_000_007)]
    df = spark.createDataFrame(cases, "n long, d long")
    got = [r["q"] for r in df.select(half_up_div(F.col("n"), F.col("d")).alias("q")).collect()]

    def ref(n, d):
        q = (2 * abs(n) + d) // (2 * d)
        return -q if n < 0 else q

    assert got == [ref(n, d) for n, d in cases]


amounts = st.decimals(min_value=-10**9, max_value=10**9, places=6).map(float)


@settings(max_examples=20, deadline=None)
@given(st.lists(amounts, min_size=1, max_size=50))
def test_total_equals_decimal_sum(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.agg(exact_total("x").alias("t"), F.sum(F.col("x").cast("decimal(38,6)")).alias("d")).first()
    assert got["t"] == got["d"]


def test_sums_of_any_size_and_fineness(spark):
    rows = [("large", "1e20"), ("large", "1"), ("large", "-1e20"), ("huge", "1e40"), ("huge", "2.5"), ("java", "12d"), ("java", "12f"),
            ("java", "3"), ("nan", "NaN"), ("blank", " 7 "), ("blank", "+.5"), ("tiny", "1e-18"), ("tiny", "-1e-18"), ("tiny", "0.005"),
            ("wide", "1e27"), ("wide", "0.0000004"), ("wide", "-1e27"), ("mixed", "1234567890123.4567"), ("mixed", "9e18"), ("mixed", "0.1")]
    df = spark.createDataFrame(rows, "k string, t string")
    got = {r["k"]: (r["s"], r["a"], str(r["d"]), r["n"]) for r in df.groupBy("k").agg(
        exact_sum("t").alias("s"), exact_avg("t").alias("a"), exact_decimal("t").alias("d"), F.count(summable("t")).alias("n")).collect()}
    assert got["large"] == (1.0, 0.33, "1.00", 3)
    assert got["huge"] == (2.5, 2.5, "2.50", 1)
    assert got["java"] == (3.0, 3.0, "3.00", 1)
    assert got["nan"] == (None, None, "None", 0)
    assert got["blank"] == (7.5, 3.75, "7.50", 2)
    assert got["tiny"] == (0.01, 0.0, "0.01", 3)
    assert got["wide"] == (0.0, 0.0, "0.00", 3)
    assert got["mixed"][2] == "9000001234567890123.56"


def test_many_amounts_below_a_millionth_add_up(spark):
    many = spark.range(200_000).select(F.lit(4e-7).alias("x"), F.lit("4e-7").alias("t"))
    assert tuple(many.agg(exact_sum("x"), exact_sum("t"), exact_total("x")).first()) == (0.08, 0.08, Decimal("0.08"))


@settings(max_examples=4, deadline=None, phases=(Phase.explicit, Phase.generate))
@given(st.lists(st.one_of(amounts, st.floats(-1e27, 1e27), st.floats(-1e-3, 1e-3)), min_size=1, max_size=60))
def test_total_does_not_depend_on_order_or_partitions(spark, values):
    def total(data, n):
        return spark.createDataFrame([(v,) for v in data], "x double").repartition(n).agg(exact_decimal("x")).first()[0]

    # An amount is a decimal that names its double, which lies within half a unit in its last place.
    room = sum((Decimal(math.ulp(v)) / 2 + Decimal(1).scaleb(-18) for v in values), Decimal("0.005"))
    once = total(values, 1)
    assert once == total(values[::-1], 3)
    assert abs(once - sum(map(Decimal, values))) <= room
