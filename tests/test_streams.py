"""Structured Streaming: resume after restart, state across restarts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import exact_sum, micro_part, whole_part
from tallyframe.plans.streams import split_by_arrival
from tallyframe.sources.tables import read_table
from tallyframe.streaming import latest_totals, run_event_totals, run_purchase_copy
from tallyframe.streaming.totals import _publisher
from tests import fixtures as fx
from tests.conftest import SF_SMALL, rows


def _dirs(scratch):
    base = scratch("stream")
    return f"{base}/inbox", f"{base}/out", f"{base}/checkpoint"


def test_split_by_arrival_keeps_every_row(spark):
    events = read_table(spark, SF_SMALL, "events")
    early, late = split_by_arrival(events)
    assert early.count() > 0 and late.count() > 0
    assert early.count() + late.count() == events.count()


def test_purchase_copy_resumes_from_checkpoint(spark, scratch):
    inbox, out, ck = _dirs(scratch)
    early, late = split_by_arrival(read_table(spark, SF_SMALL, "events"))
    early.write.parquet(inbox)
    first = run_purchase_copy(spark, inbox, out, ck)
    assert first == early.count()
    assert run_purchase_copy(spark, inbox, out, ck) == 0  # restart: nothing new
    late.write.mode("append").parquet(inbox)
    assert run_purchase_copy(spark, inbox, out, ck) == late.count()  # only the new files
    batch = read_table(spark, SF_SMALL, "events").where("event_type = 'purchase'")
    cols = ["event_id", "user_id", "value", "ts"]
    assert rows(spark.read.parquet(out), *cols) == rows(batch, *cols)


def test_event_totals_state_survives_restart(spark, scratch):
    inbox, out, ck = _dirs(scratch)
    events = read_table(spark, SF_SMALL, "events")
    early, late = split_by_arrival(events)
    early.write.parquet(inbox)
    run_event_totals(spark, inbox, out, ck)
    assert run_event_totals(spark, inbox, out, ck) == 0
    late.write.mode("append").parquet(inbox)
    assert run_event_totals(spark, inbox, out, ck) == late.count()
    expected = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total_value"))
    assert rows(latest_totals(spark, out)) == rows(expected)


def test_publishing_a_replayed_batch_is_idempotent(spark, scratch):
    out = scratch("totals")
    batch = fx.events(spark).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(whole_part("value")).alias("whole"), F.sum(micro_part("value")).alias("micros"))
    publish = _publisher(out)
    publish(batch, 0)
    publish(batch, 1)
    publish(batch, 1)  # replay after a failure
    assert spark.read.parquet(out).count() == 2 * batch.count()
    assert latest_totals(spark, out).count() == batch.count()


def test_backlog_in_bounded_batches(spark, scratch):
    inbox, out, ck = _dirs(scratch)
    events = read_table(spark, SF_SMALL, "events")
    events.repartition(6).write.parquet(inbox)  # six files
    assert run_event_totals(spark, inbox, out, ck, max_files_per_trigger=2) == events.count()
    batches = spark.read.parquet(out).select("batch_id").distinct().count()
    assert batches == 3
    expected = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total_value"))
    assert rows(latest_totals(spark, out)) == rows(expected)


def test_crash_after_publish_is_replayed_exactly_once(spark, scratch, monkeypatch):
    """The batch function dies after writing its snapshot, before the batch commits.

    The restart replays the same batch id, which rewrites its own partition:
    the totals are right and no second snapshot of that batch exists.
    """
    import pytest

    from tallyframe.streaming import totals

    inbox, out, ck = _dirs(scratch)
    events = read_table(spark, SF_SMALL, "events")
    events.write.parquet(inbox)
    real = totals._publisher
    calls = {"n": 0}

    def crashing(output_dir):
        publish = real(output_dir)

        def wrapped(batch, batch_id):
            publish(batch, batch_id)
            calls["n"] += 1
            if calls["n"] == 1:
                raise RuntimeError("driver lost after publishing")

        return wrapped

    monkeypatch.setattr(totals, "_publisher", crashing)
    with pytest.raises(Exception):
        run_event_totals(spark, inbox, out, ck)
    monkeypatch.setattr(totals, "_publisher", real)
    assert run_event_totals(spark, inbox, out, ck) == events.count()  # batch 0 again
    assert [r[0] for r in spark.read.parquet(out).select("batch_id").distinct().collect()] == [0]
    expected = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total_value"))
    assert rows(latest_totals(spark, out)) == rows(expected)
    assert run_event_totals(spark, inbox, out, ck) == 0


def test_more_batches_than_a_query_remembers(spark, scratch):
    """120 micro-batches: every row is counted and only the newest snapshots stay."""
    from tallyframe.streaming.totals import KEPT_SNAPSHOTS

    inbox, out, ck = _dirs(scratch)
    events = read_table(spark, SF_SMALL, "events")
    events.repartition(120).write.parquet(inbox)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    assert run_event_totals(spark, inbox, out, ck, max_files_per_trigger=1, state_partitions=1) == events.count()
    assert spark.conf.get("spark.sql.shuffle.partitions") == partitions
    kept = sorted(r[0] for r in spark.read.parquet(out).select("batch_id").distinct().collect())
    assert kept == list(range(120 - KEPT_SNAPSHOTS, 120))
    expected = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total_value"))
    assert rows(latest_totals(spark, out)) == rows(expected)
