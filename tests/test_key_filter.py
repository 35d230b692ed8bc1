"""The filter of join keys: no match lost, few strangers kept, fewer rows shuffled, bounds and odd keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyframe.operators.eventlog import current_app_log, read_event_logs, stage_metrics
from tallyframe.operators.key_filter import filter_words, key_filter, prefiltered
from tallyframe.plans import reports
from tallyframe.sinks.files import write_noop
from tests import fixtures
from tests.conftest import rows


def test_no_match_is_lost_and_few_others_stay(spark):
    fact = spark.range(200_000).select((F.col("id") % 100_000).alias("k"), "id")
    kept = spark.range(0, 100_000, 10).select(F.col("id").alias("c"))
    got = prefiltered(fact, "k", kept, "c")
    assert got.columns == ["k", "id"]
    assert got.where("k % 10 = 0").count() == 20_000
    assert got.where("k % 10 <> 0").count() < 0.01 * 180_000


def test_the_filter_has_a_size_bound(spark):
    assert [filter_words(n) for n in (0, 1, 4, 5, 4_000_000)] == [1, 1, 1, 2, 1 << 20]
    kept = spark.range(50_000).select(F.col("id").alias("c"))
    assert key_filter(kept, "c", 64).count() <= 64
    fact = spark.range(10).select(F.col("id").alias("k"))
    # Too many keys for the bound: no filter, the same frame.
    assert prefiltered(fact, "k", kept, "c", max_words=64) is fact


@pytest.mark.parametrize("kind", ["string", "double", "decimal(12,2)", "date"])
def test_other_key_types_nulls_and_repeats(spark, kind):
    def of(i):
        return F.date_add(F.lit("2024-01-01").cast("date"), i.cast("int")) if kind == "date" else i.cast(kind)

    i = F.col("id")
    fact = spark.range(3_000).select(of(F.when(i % 7 != 0, i)).alias("k"), (i % 5).alias("_filter"), i.alias("word"))
    kept = spark.range(60).select(of(F.when(i % 2 == 0, i % 20)).alias("c"))
    want = fact.join(kept, fact.k == kept.c, "left_semi")
    got = prefiltered(fact, "k", kept, "c")
    assert rows(got.join(kept, got.k == kept.c, "left_semi")) == rows(want)
    assert got.where("k IS NULL").count() == 0 and got.columns == fact.columns


def test_zero_keys_match_both_signs_and_empty_sides(spark):
    fact = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "k double")
    kept = spark.createDataFrame([(-0.0,)], "c double")
    assert prefiltered(fact, "k", kept, "c").where("k = 0").count() == 2
    assert prefiltered(fact, "k", kept.where("false"), "c").count() == 0
    assert prefiltered(fact.where("false"), "k", kept, "c").count() == 0
    with pytest.raises(ValueError, match="two types"):
        prefiltered(fact, "k", kept.select(F.col("c").cast("string")), "c")


@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_segment_report_does_not_depend_on_the_way(spark, bound):
    orders, customer = fixtures.orders(spark), fixtures.customers(spark)
    whole = reports.customer_sales_report(orders, customer)
    for segment in ("BUILDING", "MACHINERY", "NONE"):
        want = rows(whole.where(F.col("c_mktsegment") == segment), "o_custkey", "c_name", "total_sales")
        assert rows(reports.segment_sales_report(orders, customer, segment, bound)) == want


def _shuffled(spark, df):
    path, sc = current_app_log(spark), spark.sparkContext
    sc.setJobGroup("key-filter-test", "rows shuffled")
    before = set(sc.statusTracker().getJobIdsForGroup("key-filter-test"))
    try:
        write_noop(df)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [s for j in set(tracker.getJobIdsForGroup("key-filter-test")) - before for s in tracker.getJobInfo(j).stageIds]
    return stage_metrics(read_event_logs(spark, path)).where(F.col("stage_id").isin(stages)).agg(F.sum("shuffle_write_records")).first()[0]


def test_rows_shuffled_drop_to_near_the_matching_ones(spark, scratch):
    n, n_kept = 40_000, 2_000
    orders = spark.range(n).select((F.col("id") * 7 % n).alias("o_custkey"), F.lit(1.0).alias("o_totalprice"))
    customer = spark.range(n).select(
        F.col("id").alias("c_custkey"), F.lit("n").alias("c_name"), F.when(F.col("id") % 20 == 0, "S").otherwise("T").alias("c_mktsegment")
    )
    # Stored, or the optimizer would find the keys of the segment in the expressions above.
    path = scratch("customers")
    customer.write.parquet(path)
    customer = spark.read.parquet(path)
    plain = _shuffled(spark, reports.customer_sales_report(orders, customer.where("c_mktsegment = 'S'"), strategy="merge"))
    filtered = _shuffled(spark, reports.segment_sales_report(orders, customer, "S", max_broadcast_rows=0))
    assert plain >= n
    # Sums of the matching customers, the customers, and the filter's words once per task.
    tasks = spark.sparkContext.defaultParallelism
    assert filtered <= 2 * n_kept + tasks * filter_words(n_kept) + 0.01 * n
