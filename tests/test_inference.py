"""CSV types by one aggregate: against Spark's own inference, and with dirty cells."""

from __future__ import annotations

import math
import random

import pytest

from tallyframe.sources.csv import write_csv
from tallyframe.sources.inference import column_facts, inference_report, read_csv_inferred


def _csv(spark, scratch, rows, names):
    return write_csv(spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names)).repartition(3), scratch("inference"))


CLEAN = {
    "int": ["1", "-5", "+7", "2147483647", "0"], "bigint": ["1", "2147483648", "-9"], "decimal": ["9223372036854775808", "5", "-1"],
    "double": ["1.5", "2", "1e5", "-.5", "3.", "9223372036854775808"], "special": ["1", "NaN", "Inf", "-Inf"],
    "date": ["2020-01-31", "1999-12-01"], "timestamp": ["2020-01-31T10:20:30", "2020-01-31 10:20:30.123", "2021-01-01"],
    "boolean": ["true", "FALSE", "True"], "text": ["a", "1"], "bool_int": ["true", "1"], "date_int": ["2020-01-31", "1"],
    "blank": [" 1", "2"], "empty": [None], "no_day": ["2020-02-31", "2020-02-01"], "long_digits": ["1" * 39, "1"], "a.b": ["1", "2"],
}


def test_types_equal_sparks_own_inference_on_clean_columns(spark, scratch):
    rows = [tuple(v[i % len(v)] if i % 5 else None for v in CLEAN.values()) for i in range(60)]
    path = _csv(spark, scratch, rows, list(CLEAN))
    own = spark.read.option("header", True).option("inferSchema", True).csv(path)
    ours, _ = read_csv_inferred(spark, path)
    assert {f.name: f.dataType.simpleString() for f in ours.schema} == {f.name: f.dataType.simpleString() for f in own.schema}
    text = lambda df: sorted(str(tuple(r)) for r in df.collect())
    assert text(ours) == text(own)


@pytest.mark.parametrize("seed", range(4))
def test_types_equal_sparks_own_inference_on_random_columns(spark, scratch, seed):
    rng = random.Random(seed)
    pool = [v for values in CLEAN.values() for v in values]
    columns = [rng.sample(pool, rng.choice([1, 1, 2, 3])) for _ in range(12)]
    rows = [tuple(rng.choice(c) for c in columns) for _ in range(40)]
    path = _csv(spark, scratch, rows, [f"c{i}" for i in range(12)])
    own = spark.read.option("header", True).option("inferSchema", True).csv(path)
    ours, _ = read_csv_inferred(spark, path)
    assert [f.dataType.simpleString() for f in ours.schema] == [f.dataType.simpleString() for f in own.schema]


def test_tolerance_rejects_dirty_cells_and_counts_them(spark, scratch):
    rows = [("n/a" if i % 25 == 0 else str(i), "7 7" if i == 3 else "12d" if i == 4 else "1.5", "x" if i % 2 else "1") for i in range(200)]
    path = _csv(spark, scratch, rows, ["mostly_int", "mostly_double", "half"])
    df, facts = read_csv_inferred(spark, path, tolerance=0.05)
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "double", "string"]
    report = {r["column"]: (r["n_rows"], r["filled"], r["rejected"]) for r in inference_report(spark, facts, 0.05).collect()}
    assert report == {"mostly_int": (200, 200, 8), "mostly_double": (200, 200, 2), "half": (200, 200, 0)}
    got = df.selectExpr("count_if(mostly_int is null)", "count_if(mostly_double is null)", "count_if(half is null)").first()
    assert tuple(got) == (8, 2, 0)
    strict, _ = read_csv_inferred(spark, path)
    assert [f.dataType.simpleString() for f in strict.schema] == ["string"] * 3


def test_infinities_and_nan_are_read(spark, scratch):
    path = _csv(spark, scratch, [("Inf",), ("-Inf",), ("NaN",), ("1e3",)], ["x"])
    values = sorted(r[0] for r in read_csv_inferred(spark, path)[0].collect() if not math.isnan(r[0]))
    assert values == [-math.inf, 1000.0, math.inf]


def test_header_without_rows_is_text(spark, scratch):
    path = _csv(spark, scratch, [("1", "2")], ["a", "b"])
    text = spark.read.option("header", True).csv(path).where("a = 'none'")
    assert [f.choose() for f in column_facts(text)] == ["string", "string"]


def test_one_scan_without_shuffle_of_rows(spark, scratch):
    path = _csv(spark, scratch, [("1", "x")] * 10, ["a", "b"])
    df, _ = read_csv_inferred(spark, path)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan csv") == 1
