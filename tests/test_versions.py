import pytest

from filetally.errors import ConfigurationError
from filetally.operators import warehouse
from filetally.operators.contract import check_contract
from filetally.operators.versions import (
    advance_extraction_state,
    classify,
    extraction_bounds,
    extraction_candidates,
    file_contents,
    with_transferable,
)
from filetally.schemas import EXTRACTION_RESULT, EXTRACTION_STATE, LONG, STRING, struct

FILES = struct(
    file_id=STRING, rev=STRING, content_hash=STRING, name=STRING, size=LONG, path_lower=STRING,
    path_display=STRING, client_modified=STRING, server_modified=STRING,
)
DOC = {"file_id": "id:a", "rev": "r1", "content_hash": "h1", "name": "a.PDF", "size": 10,
       "path_lower": "/a.pdf", "path_display": "/a.PDF", "client_modified": "2026-01-01T00:00:00Z"}
MIB = 1024 * 1024


def ids(df):
    return sorted(r.file_id for r in df.collect())


def test_classify_by_bytes_not_by_path(rows):
    state = rows(
        EXTRACTION_STATE,
        *[{"file_id": f"id:{k}", "rev": "r1", "content_hash": "h1", "path": "/old"} for k in "abc"],
    )
    now = rows(FILES, DOC, {**DOC, "file_id": "id:b", "rev": "r2"},
               {**DOC, "file_id": "id:c", "content_hash": "h2"}, {**DOC, "file_id": "id:new"})
    got = {r.file_id: r.change for r in classify(now, state).collect()}
    assert got == {"id:a": "unchanged", "id:b": "changed", "id:c": "changed", "id:new": "new"}


def test_size_is_marked_inclusively(rows):
    df = rows(FILES, {**DOC, "size": MIB}, {**DOC, "file_id": "id:b", "size": MIB + 1})
    got = {r.file_id: r.transferable for r in with_transferable(df, 1).collect()}
    assert got == {"id:a": True, "id:b": False}


def test_candidates_by_extension_size_and_version(rows):
    files = rows(
        FILES, DOC, {**DOC, "file_id": "id:big", "size": MIB + 1},
        {**DOC, "file_id": "id:edge", "size": MIB}, {**DOC, "file_id": "id:txt", "name": "a.txt"},
        {**DOC, "file_id": "id:done"}, {**DOC, "file_id": "id:new-rev", "rev": "r2"},
    )
    state = rows(EXTRACTION_STATE, *[
        {"file_id": f, "rev": "r1", "content_hash": "h1"} for f in ("id:done", "id:new-rev")])
    assert ids(extraction_candidates(files, state, [".PDF"], 1)) == ["id:a", "id:edge", "id:new-rev"]
    everything = extraction_candidates(files, state, [".pdf"], 1, mode="full_refresh")
    assert ids(everything) == ["id:a", "id:done", "id:edge", "id:new-rev"]


def test_only_eligible_files_need_identity(rows, fails_with):
    nameless = rows(FILES, {**DOC, "rev": None, "name": "a.txt"}, {**DOC, "rev": "", "size": 2 * MIB})
    assert extraction_candidates(nameless, None, [".pdf"], 1).count() == 0
    with fails_with("no stable id, rev or content hash"):
        extraction_candidates(rows(FILES, {**DOC, "content_hash": None}), None, [".pdf"]).count()


def test_extraction_settings(rows):
    for suffixes in ([], [".exe"], [".pdf", ".txt"]):
        with pytest.raises(ConfigurationError):
            extraction_candidates(rows(FILES), None, suffixes)
    for bounds in ((0, 300), (51, 300), (True, 300), (10, 9), (10, 601)):
        with pytest.raises(ConfigurationError):
            extraction_bounds(*bounds)
    assert extraction_bounds() == 10 * MIB
    with pytest.raises(ConfigurationError):
        extraction_candidates(rows(FILES), None, [".pdf"], mode="append")


def result(file_id, status, **fields):
    return {"file_id": file_id, "rev": "r1", "content_hash": "h1", "status": status, **fields}


def test_outcomes_become_records(rows):
    files = rows(FILES, *[{**DOC, "file_id": f"id:{k}"} for k in "abcdefg"])
    results = rows(
        EXTRACTION_RESULT,
        result("id:a", "complete", markdown="# A"),
        result("id:b", "failed", error_type="conversion_failure_error", error_code="other"),
        result("id:c", "failed", error_type="user_error", error_code="x", error_message="locked"),
        result("id:d", "timed_out"),
        result("id:e", "other"),
        result("id:stale", "failed", error_code="access_error"),
        {**result("id:f", "succeeded"), "rev": "r0"},
    )
    records = file_contents(files, results)
    got = {r.file_id: r for r in records.collect()}
    assert sorted(got) == ["id:a", "id:b", "id:c", "id:d", "id:e"]
    assert (got["id:a"].extraction_status, got["id:a"].markdown) == ("succeeded", "# A")
    failed = got["id:b"]
    assert (failed.error_type, failed.error_code, failed.error_message) == (
        "conversion_failure_error", "other", "Extraction failed: conversion_failure_error.")
    assert failed.error_details.asDict() == {"type": "conversion_failure_error", "message": None}
    assert got["id:c"].error_message == got["id:c"].error_details.message == "locked"
    assert (got["id:d"].extraction_status, got["id:d"].error_type) == ("timed_out", "timeout")
    assert (got["id:e"].extraction_status, got["id:e"].error_type) == ("failed", "unknown_status")
    assert all(r.violations == 0 for r in check_contract(records, "file_contents").collect())
    assert warehouse.succeeded_documents(records).count() == 1
    codes = {r.error_code: r.documents for r in warehouse.failures_by_code(records).collect()}
    assert codes == {"other": 1, "x": 1, None: 1}

    before = rows(EXTRACTION_STATE, {"file_id": "id:a", "rev": "r0", "content_hash": "h0"},
                  {"file_id": "id:d", "rev": "r0", "content_hash": "h0", "path": "/d"},
                  {"file_id": "id:vanished", "rev": "r9", "content_hash": "h9"})
    after = {r.file_id: (r.rev, r.path) for r in advance_extraction_state(before, records).collect()}
    assert after == {"id:a": ("r1", "/a.pdf"), "id:b": ("r1", "/a.pdf"), "id:c": ("r1", "/a.pdf"),
                     "id:d": ("r0", "/d"), "id:e": ("r1", "/a.pdf"), "id:vanished": ("r9", None)}


@pytest.mark.parametrize(
    "fields, message",
    [
        ({"status": "failed", "error_code": "ratelimit_error"}, "systemic error ratelimit_error"),
        ({"status": "failed", "error_type": "odd", "error_code": "odd"}, "Unexpected extraction"),
        ({"status": "failed"}, "Unexpected extraction"),
        ({"status": "in_progress"}, "Unexpected extraction"),
        ({"status": "succeeded"}, "no Markdown"),
    ],
)
def test_other_outcomes_fail_the_job(rows, fails_with, fields, message):
    results = rows(EXTRACTION_RESULT, {**result("id:a", None), **fields})
    with fails_with(message):
        file_contents(rows(FILES, DOC), results).select("file_id").collect()
