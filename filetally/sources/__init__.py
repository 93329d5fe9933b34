"""Readers and writers of landed data, state, reports and file records."""

from filetally.sources.keyed_state import KeyedState
from filetally.sources.keyed_table import KeyedTable
from filetally.sources.listing import (
    flatten_pages,
    land_listing,
    read_listing,
    stream_listing,
    stream_pages,
)
from filetally.sources.records import plan_writes, write_records
from filetally.sources.report import (
    Report,
    order_violations,
    read_report,
    report_lines,
    write_report,
)
from filetally.sources.sharing import flatten_members, read_links, read_members, read_shared_folders
from filetally.sources.staged import file_digests, read_staged
from filetally.sources.state import Scope, State, read_state, read_state_json, write_state

__all__ = [
    "KeyedState",
    "KeyedTable",
    "Report",
    "Scope",
    "State",
    "file_digests",
    "flatten_members",
    "flatten_pages",
    "land_listing",
    "order_violations",
    "plan_writes",
    "read_links",
    "read_listing",
    "read_members",
    "read_report",
    "read_shared_folders",
    "read_staged",
    "read_state",
    "read_state_json",
    "report_lines",
    "stream_listing",
    "stream_pages",
    "write_records",
    "write_report",
    "write_state",
]
