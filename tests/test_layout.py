"""Rows per partition and event-log stage figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators.eventlog import current_app_log, read_event_logs, stage_metrics
from tallyframe.operators.layout import distribution_summary, partition_distribution
from tallyframe.plans import reports
from tallyframe.sinks.files import write_noop
from tallyframe.sources.tables import read_table
from tests.conftest import SF_SMALL


def test_rows_per_partition_add_up(spark):
    orders = read_table(spark, SF_SMALL, "orders")
    dist = partition_distribution(orders.repartition(4))
    got = dist.collect()
    assert len(got) == 4
    assert sum(r["count"] for r in got) == orders.count()
    assert {r["partition_id"] for r in got} == {0, 1, 2, 3}


def test_summary_flags_a_hot_key(spark):
    # one key holds a third of the rows
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    s = distribution_summary(partition_distribution(df.repartition(8, "k"))).first()
    assert s["total_rows"] == 3000 and s["partitions"] == 8
    assert s["max_rows"] >= 1000 and s["skew_ratio"] > 2


def test_stage_metrics_from_event_log(spark):
    orders = read_table(spark, SF_SMALL, "orders")
    write_noop(reports.total_sales_by_customer(orders))
    path = current_app_log(spark)
    assert path is not None
    metrics = stage_metrics(read_event_logs(spark, path))
    got = metrics.collect()
    assert got
    assert any(r["shuffle_write_bytes"] > 0 for r in got)
    assert all(r["tasks"] >= 1 and r["failed_tasks"] == 0 for r in got)
    assert all(r["stage_name"] for r in got)


def test_hot_key_is_collapsed_before_the_shuffle(spark):
    """A key holding a third of all rows adds one shuffle record per map task."""
    from tallyframe.operators.aggregates import money_summary

    path = current_app_log(spark)
    n, tasks = 60_000, 6
    df = spark.range(0, n, 1, tasks).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("k"),
        (F.col("id") % 1000 / 100).alias("amount"),
    )
    sc = spark.sparkContext
    sc.setJobGroup("hot-key-test", "aggregate with a hot key")
    try:
        write_noop(money_summary(df, ["k"], "amount", count_as="n", sum_as="total"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stage_ids = [s for j in tracker.getJobIdsForGroup("hot-key-test") for s in tracker.getJobInfo(j).stageIds]
    after = stage_metrics(read_event_logs(spark, path)).where(F.col("stage_id").isin(stage_ids))
    written = after.agg(F.sum("shuffle_write_records")).first()[0]
    distinct_keys = 1 + 500
    assert 0 < written <= tasks * distinct_keys  # not ~n/3 rows for the hot key


def test_finished_applications_compressed_log(spark, scratch):
    """A separate application writes a zstd-compressed log; once it ends, the log reads in full."""
    import os
    import subprocess
    import sys
    import tempfile

    log_dir = tempfile.mkdtemp(prefix="tallyframe-child-events-")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS=(
        f"--conf spark.eventLog.enabled=true --conf spark.eventLog.dir={log_dir} pyspark-shell"))
    proc = subprocess.run(
        [sys.executable, "-m", "tallyframe.jobs.report", "total_sales_by_customer", SF_SMALL, scratch("child")],
        cwd=repo, env=env, capture_output=True, text=True, timeout=300,
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    logs = [n for n in os.listdir(log_dir) if not n.startswith(".")]
    assert logs
    got = stage_metrics(read_event_logs(spark, log_dir)).collect()
    assert got and sum(r["shuffle_write_bytes"] for r in got) > 0
    assert len({r["app"] for r in got}) == 1


def test_rolled_log_files_of_one_application_are_one_log(spark, tmp_path):
    """A stage whose tasks are spread over two rolled files is one row; a longer id is another application."""
    task = '{"Event":"SparkListenerTaskEnd","Stage ID":3,"Stage Attempt ID":0,"Task Info":{"Failed":false,"Killed":false}}'
    done = '{"Event":"SparkListenerStageCompleted","Stage Info":{"Stage ID":3,"Stage Attempt ID":0,"Stage Name":"sum","Number of Tasks":4}}'
    for app, parts in (("app-1", ([task] * 3, [task, done])), ("app-10", ([task, done],))):
        folder = tmp_path / f"eventlog_v2_{app}"
        folder.mkdir()
        for n, lines in enumerate(parts, 1):
            (folder / f"events_{n}_{app}").write_text("\n".join(lines) + "\n")
    got = stage_metrics(read_event_logs(spark, f"file://{tmp_path}")).collect()
    assert sorted((r["app"], r["stage_id"], r["tasks"], r["stage_name"]) for r in got) == [
        ("app-1", 3, 4, "sum"), ("app-10", 3, 1, "sum")]
