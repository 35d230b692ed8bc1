"""Structured Streaming jobs: resume-safe copy, stateful totals."""

from tallyframe.streaming.keyed_totals import latest_keyed_totals, merge_changes, run_keyed_totals
from tallyframe.streaming.ledger import Ledger, write_once
from tallyframe.streaming.purchases import (
    committed_purchases,
    event_stream,
    purchases,
    run_ledgered_purchase_copy,
    run_purchase_copy,
)
from tallyframe.streaming.totals import event_totals, latest_totals, run_event_totals

__all__ = [
    "Ledger",
    "committed_purchases",
    "event_stream",
    "event_totals",
    "latest_keyed_totals",
    "latest_totals",
    "merge_changes",
    "purchases",
    "run_event_totals",
    "run_keyed_totals",
    "run_ledgered_purchase_copy",
    "run_purchase_copy",
    "write_once",
]
