import json
from pathlib import Path

import pytest

from filetally.errors import ContractError
from filetally.operators.reconcile import (
    reconcile,
    reconcile_tables,
    side_inventory,
    summarize,
)
from filetally.operators.repair import (
    check_drift,
    repair_actions,
    repair_outcomes,
    repair_summary,
    report_violations,
    validate_report,
)
from filetally.schemas import LISTING_ROW, REPORT
from filetally.sources.report import read_report, write_report


def file(path, root, ordinal=0, **fields):
    return {"entry_type": "file", "id": f"id:{path}", "name": path, "ordinal": ordinal,
            "path_lower": f"{root}/{path}".lower(), "path_display": f"{root}/{path}", "rev": "r",
            "size": 10, "content_hash": "h", **fields}


@pytest.fixture
def report(rows):
    def make(source, destination):
        return reconcile(
            side_inventory(rows(LISTING_ROW, *source), "/src", "source"),
            side_inventory(rows(LISTING_ROW, *destination), "/dst", "destination"),
        )

    return make


def by_path(df):
    return {r.path: r for r in df.collect()}


SOURCE = [
    file("Same.txt", "/src"), file("missing.txt", "/src"), file("size.txt", "/src", size=1),
    file("hash.txt", "/src", content_hash="a"), file("nohash.txt", "/src", content_hash=None),
    file("bad.txt", "/elsewhere", 7),
    {"entry_type": "folder", "id": "id:f", "path_lower": "/src/f", "path_display": "/src/f"},
]
DESTINATION = [
    file("same.txt", "/dst"), file("extra.txt", "/dst"), file("size.txt", "/dst", size=None),
    file("hash.txt", "/dst", content_hash="b"), file("nohash.txt", "/dst"),
    file("x", "/dst", 3, path_display=None),
]


def test_every_status_in_one_report(report):
    rows_ = report(SOURCE, DESTINATION)
    got = by_path(rows_)
    assert {p: (r.status, r.reason) for p, r in got.items()} == {
        "Same.txt": ("matched", "matched"),
        "missing.txt": ("missing", "source_only"),
        "extra.txt": ("extra_destination", "destination_only"),
        "size.txt": ("mismatched", "size_mismatch"),
        "hash.txt": ("mismatched", "content_hash_mismatch"),
        "nohash.txt": ("error", "missing_content_hash"),
        "/elsewhere/bad.txt": ("error", "invalid_relative_path"),
        "/dst/x": ("error", "invalid_relative_path"),
    }
    assert got["Same.txt"].content.asDict() == {"status": "matched", "reason": "content_match"}
    assert got["size.txt"].content.reason == "size_mismatch"
    assert got["size.txt"].namespace.asDict() == {"status": "not_comparable", "reason": None}
    assert got["missing.txt"].namespace.reason == "source_only"
    assert got["extra.txt"].source is None and got["extra.txt"].destination.file_id
    bad, hidden = got["/elsewhere/bad.txt"], got["/dst/x"]
    assert (bad.sort_key, bad.destination) == ("~invalid-source-00000007", None)
    assert (hidden.sort_key, hidden.source) == ("~invalid-destination-00000003", None)
    assert hidden.destination.rev == "r"
    total = summarize(rows_).first().asDict(recursive=True)
    assert total == {"type": "summary", "total_paths": 8, "matched": 1, "missing": 1,
                     "mismatched": 2, "extra_destination": 1, "errors": 3,
                     "metadata_mismatches": {"client_modified": 0}}


Z = "2026-08-01T10:00:00Z"


@pytest.mark.parametrize(
    "source, destination, status",
    [
        (Z, Z, "matched"),
        (Z, "2026-08-01T12:00:00+02:00", "matched"),
        (Z, "2026-08-01T10:00:00", "matched"),
        (Z, "2026-08-01T10:00:01Z", "mismatched"),
        (None, None, "not_comparable"),
        (None, Z, "source_missing"),
        (Z, None, "destination_missing"),
        ("soon", Z, "not_comparable"),
        (None, "soon", "source_missing"),
        ("soon", None, "destination_missing"),
    ],
)
def test_client_modified_never_changes_the_status(report, source, destination, status):
    rows_ = report([file("a", "/src", client_modified=source, server_modified=Z)],
                   [file("a", "/dst", client_modified=destination)])
    row = rows_.first()
    modified = row.metadata.client_modified
    assert (row.status, modified.status) == ("matched", status)
    assert (modified.source is not None) == (status == "mismatched")
    assert summarize(rows_).first().metadata_mismatches[0] == int(status == "mismatched")


def test_reported_times_are_utc(report):
    row = report([file("a", "/src", client_modified="2026-08-01T12:00:00+02:00",
                       server_modified="2026-08-01T10:00:00.5Z")], []).first()
    assert row.source.client_modified == Z
    assert row.source.server_modified == "2026-08-01T10:00:00.500000Z"


@pytest.mark.parametrize("side", ["source", "destination"])
def test_duplicate_paths_fail(report, rows, fails_with, side):
    root = {"source": "/src", "destination": "/dst"}[side]
    twice = [file("File.txt", root), file("file.txt", root)]
    given = {"source": [], "destination": [], side: twice}
    message = f"duplicate_normalized_path in {side} inventory: file.txt"
    with fails_with(message):
        report(given["source"], given["destination"]).select("status").collect()
    with fails_with(message):
        side_inventory(rows(LISTING_ROW, *twice), root, side).files.count()


def test_inventory_views(rows):
    side = side_inventory(rows(LISTING_ROW, *SOURCE), "/SRC", "source")
    assert side.files.count() == 5
    assert [r.path for r in side.issues.collect()] == ["/elsewhere/bad.txt"]


def test_any_two_tables(spark, fails_with):
    left = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, None, 1), (4, "d", None)],
                                 "k int, h string, n int")
    right = spark.createDataFrame([(1, "a", 1), (2, "x", 1), (3, "c", 1), (4, "d", 2), (5, "e", 1)],
                                  left.schema)
    got = reconcile_tables(left, right, ["k"], ["n", "h"], required=["h"]).collect()
    assert {r.k: (r.status, r.reason) for r in got} == {
        1: ("matched", "matched"), 2: ("mismatched", "h_mismatch"), 3: ("error", "missing_h"),
        4: ("mismatched", "n_mismatch"), 5: ("extra_destination", "destination_only"),
    }
    with fails_with("duplicate key"):
        reconcile_tables(left.union(left), right, ["k"], ["n"]).collect()


def test_report_round_trip_is_sorted(report, spark, tmp_path):
    rows_ = report(SOURCE, DESTINATION)
    write_report(rows_, str(tmp_path / "r"))
    parts = sorted((tmp_path / "r" / "details").glob("*.json"))
    lines = [json.loads(x) for p in parts for x in p.read_text().splitlines()]
    assert [x["path"] for x in lines][:2] == ["extra.txt", "hash.txt"]
    assert [x["path"] for x in lines][-2:] == ["/dst/x", "/elsewhere/bad.txt"]
    stored = read_report(spark, str(tmp_path / "r"))
    assert stored.details.count() == 8
    assert stored.summary.first() == summarize(rows_).first()
    assert {r.path: r.status for r in stored.details.collect()} == {
        r.path: r.status for r in rows_.collect()}


RECORD = {"path": "a.txt", "status": "missing",
          "source": {"file_id": "id:a", "rev": "r", "size": 1, "content_hash": "h"}}


def lines_file(tmp_path, *records):
    path = Path(tmp_path) / "report.jsonl"
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in records))
    return str(path)


def test_a_single_file_report_is_accepted(spark, tmp_path):
    path = lines_file(tmp_path, RECORD, {"path": "b", "status": "matched"}, {"type": "summary"})
    details = validate_report(read_report(spark, path).details)
    acts = {r.path: r.actionable for r in repair_actions(details).collect()}
    assert acts == {"a.txt": True, "b": False}


@pytest.mark.parametrize(
    "records",
    [[RECORD], [RECORD, {"type": "summary"}, {"type": "summary"}]],
)
def test_report_needs_one_summary(spark, tmp_path, records):
    with pytest.raises(ContractError, match="exactly one summary"):
        read_report(spark, lines_file(tmp_path, *records))


@pytest.mark.parametrize(
    "line",
    ["{not json", {**RECORD, "source": "text"},
     {**RECORD, "source": {**RECORD["source"], "size": True}},
     {**RECORD, "source": {**RECORD["source"], "size": 1.5}}],
)
def test_report_lines_must_fit(spark, tmp_path, fails_with, line):
    with fails_with("valid JSON lines"):
        read_report(spark, lines_file(tmp_path, line, {"type": "summary"})).details.collect()


def changed(**source):
    return {**RECORD, "source": {**RECORD["source"], **source}}


@pytest.mark.parametrize(
    "records, rule",
    [
        ([{**RECORD, "path": "../a"}], "invalid_relative_path"),
        ([{**RECORD, "path": None}], "invalid_relative_path"),
        ([RECORD, {**RECORD, "path": "A.TXT"}], "duplicate_path"),
        ([{**RECORD, "path": "straße"}, {**RECORD, "path": "STRASSE"}], "duplicate_path"),
        ([{**RECORD, "status": "odd"}], "unknown_status"),
        ([{**RECORD, "status": None}], "unknown_status"),
        ([{**RECORD, "source": None}], "missing_source"),
        ([changed(file_id="")], "invalid_file_id"),
        ([changed(rev=None)], "invalid_rev"),
        ([changed(content_hash="")], "invalid_content_hash"),
        ([changed(size=-1)], "invalid_size"),
        ([changed(size=None)], "invalid_size"),
    ],
)
def test_invalid_reports_are_refused_whole(rows, records, rule):
    details = rows(REPORT, *records)
    assert [r.rule for r in report_violations(details).collect()] == [rule]
    with pytest.raises(ContractError):
        validate_report(details)


def test_skipped_rows_need_no_source(rows):
    details = rows(REPORT, {"path": "a", "status": "matched"}, {"path": "b", "status": "error"})
    assert report_violations(details).count() == 0


def test_drift_and_outcomes(rows):
    def record(path, status="missing", **fields):
        source = {"file_id": f"id:{path}", "rev": "r", "size": 10, "content_hash": "h", **fields}
        return {"path": path, "status": status, "source": source}

    details = rows(
        REPORT, record("Ok.txt"), record("over.txt", "mismatched"), record("rev.txt", rev="old"),
        record("size.txt", size=11), record("hash.txt", content_hash="x"), record("gone.txt"),
        record("moved.txt"), record("same.txt", "matched"),
        {"path": "extra.txt", "status": "extra_destination"},
    )
    names = ["Ok.txt", "over.txt", "rev.txt", "size.txt", "hash.txt", "same.txt"]
    current = rows(LISTING_ROW, *[file(n, "/Src") for n in names],
                   file("moved.txt", "/Src", path_lower="/src/new.txt"))
    outcomes = repair_outcomes(check_drift(repair_actions(details), current, "/Src"))
    assert {r.path: r.action for r in outcomes.collect()} == {
        "Ok.txt": "uploaded", "over.txt": "overwritten", "rev.txt": "error", "size.txt": "error",
        "hash.txt": "error", "gone.txt": "error", "moved.txt": "error", "same.txt": "skipped",
        "extra.txt": "skipped",
    }
    assert repair_summary(outcomes).first().asDict() == {
        "type": "summary", "uploaded": 1, "overwritten": 1, "skipped": 2, "errors": 5}


def test_lines_are_numbered_through_all_files_and_blocks(spark, tmp_path):
    """A single file read in many blocks, and details in several files."""
    from filetally.sources.report import order_violations, report_lines

    rows = [f'{{"type": "file", "path": "p{k:04d}", "status": "matched"}}' for k in range(300)]
    summary = '{"type": "summary", "files": 300}'
    single = tmp_path / "single.jsonl"
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        for at, behind in ((300, 0), (120, 180), (0, 300)):
            single.write_text("\n".join([*rows[:at], summary, *rows[at:]]) + "\n")
            lines = report_lines(spark, str(single))
            assert lines.rdd.getNumPartitions() > 5
            got = [(r.line, r.path) for r in lines.orderBy("line").collect()]
            expected = [f"p{k:04d}" for k in range(300)]
            expected.insert(at, None)
            assert got == list(enumerate(expected, 1))
            found = [tuple(r) for r in order_violations(lines).collect()]
            assert found == ([("row_after_summary", behind)] if behind else [])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    folder = tmp_path / "two"
    details = spark.createDataFrame([(f"p{k:04d}", "file") for k in range(50)], "path string, type string")
    details.repartitionByRange(4, "path").sortWithinPartitions("path").write.json(f"{folder}/details")
    spark.createDataFrame([("summary",)], "type string").write.json(f"{folder}/summary")
    got = [r.path for r in report_lines(spark, str(folder)).orderBy("line").collect()]
    assert got == [f"p{k:04d}" for k in range(50)] + [None]


def test_issues_without_a_place_keep_their_rows_in_a_stable_order(spark, rows, tmp_path):
    from filetally.schemas import LISTING_ROW
    from filetally.sources.report import report_lines, write_report

    def outside(ordinal, file_id, path="/Elsewhere/x"):
        return {"page": 0, "ordinal": ordinal, "entry_type": "file", "id": file_id, "name": "x",
                "path_display": path, "path_lower": path.lower(), "rev": "r", "size": 1,
                "content_hash": "h"}

    files = [outside(None, "id:c"), outside(None, "id:a"), outside(7, "id:b"), outside(7, "id:d")]
    for k, order in enumerate((files, files[::-1])):
        listing = rows(LISTING_ROW, *order).repartition(3)
        made = reconcile(side_inventory(listing, "/S", "source"),
                         side_inventory(rows(LISTING_ROW), "/D", "destination"))
        path = str(tmp_path / str(k))
        write_report(made, path)
        lines = report_lines(spark, path).where("type = 'file'").orderBy("line").collect()
        assert [r.source.file_id for r in lines if r.source] == ["id:a", "id:c", "id:b", "id:d"]
