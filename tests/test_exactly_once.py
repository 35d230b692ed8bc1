"""Streams that die between a batch's write and its commit; totals per key in a state store on disk."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import exact_sum
from tallyframe.plans.streams import split_by_arrival
from tallyframe.sources.tables import read_table
from tallyframe.streaming import Ledger, committed_purchases, latest_keyed_totals, run_keyed_totals, run_ledgered_purchase_copy
from tallyframe.streaming.keyed_totals import merge_changes
from tallyframe.streaming.ledger import AFTER_LEDGER, AFTER_WRITE, BEFORE_WRITE
from tests.conftest import SF_SMALL, rows

COLUMNS = ["event_id", "user_id", "value", "ts"]


def _dirs(scratch):
    base = scratch("stream")
    return f"{base}/inbox", f"{base}/out", f"{base}/checkpoint"


def _dying(at, batch):
    def step(point, batch_id):
        if (point, batch_id) == (at, batch):
            raise RuntimeError(f"died {point}")

    return step


@pytest.mark.parametrize("point", [BEFORE_WRITE, AFTER_WRITE, AFTER_LEDGER])
def test_a_crash_at_any_step_gives_what_one_run_gives(spark, scratch, point):
    inbox, out, ck = _dirs(scratch)
    events = read_table(spark, SF_SMALL, "events")
    events.repartition(3).write.parquet(inbox)
    with pytest.raises(Exception, match=f"died {point}"):
        run_ledgered_purchase_copy(spark, inbox, out, ck, 1, _dying(point, 1))
    seen = committed_purchases(spark, out)
    assert sorted(Ledger(spark, out).batches()) == ([0, 1] if point == AFTER_LEDGER else [0])
    assert {r[0] for r in seen.select("batch_id").distinct().collect()} == ({0, 1} if point == AFTER_LEDGER else {0})
    run_ledgered_purchase_copy(spark, inbox, out, ck, 1)
    assert run_ledgered_purchase_copy(spark, inbox, out, ck, 1) == 0
    want = events.where("event_type = 'purchase'")
    assert rows(committed_purchases(spark, out), *COLUMNS) == rows(want, *COLUMNS)
    assert sorted(Ledger(spark, out).batches()) == [0, 1, 2]
    assert Ledger(spark, out).audit().where("ledger_rows <> data_rows").count() == 0


def test_half_written_batches_are_not_read_and_are_rewritten(spark, scratch):
    inbox, out, ck = _dirs(scratch)
    events = read_table(spark, SF_SMALL, "events")
    events.write.parquet(inbox)
    # What a writer leaves that died within batch 0.
    events.where("event_type = 'purchase'").select(*COLUMNS).limit(5).write.parquet(Ledger(spark, out).folder(0))
    assert committed_purchases(spark, out).count() == 0
    run_ledgered_purchase_copy(spark, inbox, out, ck)
    want = events.where("event_type = 'purchase'")
    assert rows(committed_purchases(spark, out), *COLUMNS) == rows(want, *COLUMNS)


def test_a_ledger_entry_is_made_once(spark, scratch):
    from tallyframe.sinks.fs import create_once

    path = scratch("entry")
    assert create_once(spark, path) and not create_once(spark, path)


def _expected(events):
    return events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total_value"))


def test_keyed_totals_survive_restarts_and_publish_only_changed_keys(spark, scratch):
    inbox, out, ck = _dirs(scratch)
    events = read_table(spark, SF_SMALL, "events")
    early, late = split_by_arrival(events)
    few = late.where("user_id % 10 = 3")
    run = lambda: run_keyed_totals(spark, inbox, out, ck, state_partitions=2, merge_at=100)
    early.write.parquet(inbox)
    run()
    assert run() == 0
    few.write.mode("append").parquet(inbox)
    assert run() == few.count()
    late.where("user_id % 10 <> 3").write.mode("append").parquet(inbox)
    run()
    assert rows(latest_keyed_totals(spark, out, "user_id")) == rows(_expected(events))
    users = lambda df: df.select("user_id").distinct().count()
    published = list(Ledger(spark, f"{out}/changes").batches().values())
    assert published == [users(early), users(few), users(late.where("user_id % 10 <> 3"))]
    provider = spark.read.json(f"{ck}/metadata")  # the checkpoint is a query's own
    assert provider.count() == 1


def test_changes_are_merged_into_bases_and_dropped_one_base_later(spark, scratch):
    inbox, out, ck = _dirs(scratch)
    events = read_table(spark, SF_SMALL, "events")
    events.repartition(5).write.parquet(inbox)
    run_keyed_totals(spark, inbox, out, ck, max_files_per_trigger=1, state_partitions=2)
    assert rows(latest_keyed_totals(spark, out, "user_id")) == rows(_expected(events))
    bases, changes = Ledger(spark, f"{out}/bases").batches(), Ledger(spark, f"{out}/changes").batches()
    assert 1 <= len(bases) <= 2 and len(changes) < 5 and max(changes) == 4
    with pytest.raises(RuntimeError):
        merge_changes(spark, out, "user_id", 0.0, _dying(AFTER_WRITE, 4)) or _raise_if_merged(bases)
    assert rows(latest_keyed_totals(spark, out, "user_id")) == rows(_expected(events))


def _raise_if_merged(bases):
    # All batches are in the last base already, so there was nothing to merge.
    assert max(bases) == 4
    raise RuntimeError
