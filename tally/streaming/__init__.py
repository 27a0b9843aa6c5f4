"""Structured Streaming forms of the ledger operators."""

from tally.streaming.ledger import (
    current_from_changes,
    ledger_stream_from_events,
    run_settled_stream,
    settled_state,
    write_changes,
)

__all__ = ["current_from_changes", "ledger_stream_from_events", "run_settled_stream",
           "settled_state", "write_changes"]
