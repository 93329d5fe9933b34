"""Structured Streaming forms: change log and views, migration, extraction, records, gates."""

from filetally.streaming.changes import (
    current_entries,
    entry_view,
    read_changes,
    start_change_stream,
    start_view_stream,
)
from filetally.streaming.migrate import start_extraction_stream, start_migration_stream
from filetally.streaming.records import (
    read_checkpoints,
    read_ledger,
    read_records,
    start_gate_stream,
    start_record_stream,
)

__all__ = [
    "current_entries",
    "entry_view",
    "read_changes",
    "read_checkpoints",
    "read_ledger",
    "read_records",
    "start_change_stream",
    "start_extraction_stream",
    "start_gate_stream",
    "start_migration_stream",
    "start_record_stream",
    "start_view_stream",
]
