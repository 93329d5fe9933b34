import json

import pytest

from filetally.errors import ConfigurationError, ContractError
from filetally.schemas import EXTRACTION_STATE, LISTING_ROW, TRANSFER_STATE
from filetally.session import require_utc, scratch, shared_folder
from filetally.sources.listing import as_listing_rows, land_listing, read_listing
from filetally.sources.state import Scope, State, read_state, read_state_json, write_state


def entry(ordinal, path, kind="file", **more):
    return {"page": ordinal // 2, "ordinal": ordinal, "entry_type": kind, "id": f"id:{ordinal}",
            "name": path.rsplit("/", 1)[1], "path_display": path, "path_lower": path.lower(), **more}


LISTING = [
    entry(0, "/Root/a.txt"), entry(1, "/Root/F", "folder"), entry(2, "/Root/F/b.txt"),
    entry(3, "/Root/gone.txt", "deleted"), entry(4, "/Rootless/c.txt"),
]


@pytest.mark.parametrize("layout", ["rows", "pages"])
def test_listing_scope(rows, spark, tmp_path, layout):
    path = str(tmp_path / layout)
    listing = rows(LISTING_ROW, *LISTING)
    if layout == "rows":
        listing.write.parquet(path)
    else:
        land_listing(listing, path, page_size=2)

    def names(*args):
        return [r.name for r in read_listing(spark, path, *args, layout=layout)
                .orderBy("ordinal").collect()]

    assert names() == ["a.txt", "F", "b.txt", "gone.txt", "c.txt"]
    assert names("/ROOT/") == ["a.txt", "F", "b.txt", "gone.txt"]
    assert names("/root", False) == ["a.txt", "F", "gone.txt"]
    assert names("/root", True, False) == ["a.txt", "F", "b.txt"]
    assert read_listing(spark, path, layout=layout).columns == LISTING_ROW.names


def test_listing_filters_reach_the_scan(rows, spark, tmp_path):
    rows(LISTING_ROW, *LISTING).write.parquet(str(tmp_path / "rows"))
    df = read_listing(spark, str(tmp_path / "rows"), "/root", True, False).select("name")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(path_lower,/root/)" in plan
    assert "entry_type" in plan.split("PushedFilters")[1]
    assert "ReadSchema: struct<entry_type:string,name:string,path_lower:string>" in plan


def test_layouts_are_closed(spark):
    with pytest.raises(ConfigurationError):
        read_listing(spark, "/nowhere", layout="columns")


def test_narrow_relations_are_completed(spark):
    df = as_listing_rows(spark.createDataFrame([("a", 1)], "name string, size int"))
    assert df.schema.simpleString() == LISTING_ROW.simpleString()


ROW = {"file_id": "id:a", "path": "a.txt", "rev": "r1", "content_hash": "h1"}


def test_state_versions(rows, spark, tmp_path):
    path = str(tmp_path / "state")
    assert read_state(spark, path).files.count() == 0
    first = State(rows(TRANSFER_STATE, ROW, {**ROW, "file_id": "id:b"}), Scope("/R/"), "c0")
    write_state(first, path, 0)
    got = read_state(spark, path)
    assert (got.scope, got.cursor, got.version, got.base) == (Scope("/R"), "c0", 0, 0)
    assert got.can_resume and got.files.count() == 2
    changes = spark.createDataFrame(
        [("id:b", None, None, None, True), ("id:c", "c", "r", "h", False)],
        "file_id string, path string, rev string, content_hash string, removed boolean")
    for _ in range(2):  # writing a version again changes nothing
        write_state(got.advanced(got.files, "c1", Scope("/R")), path, 1, changes=changes)
    got = read_state(spark, path)
    assert (got.cursor, got.version, got.base) == ("c1", 1, 0)
    assert sorted(r.file_id for r in got.files.collect()) == ["id:a", "id:c"]
    back = changes.where("removed").selectExpr(
        "file_id", "'b2' AS path", "'r2' AS rev", "'h2' AS content_hash", "false AS removed")
    write_state(got.advanced(got.files, "c2", Scope("/R")), path, 2, changes=back)
    got = read_state(spark, path)
    assert {r.file_id: r.path for r in got.files.collect()} == {
        "id:a": "a.txt", "id:b": "b2", "id:c": "c"}
    write_state(got, path, 40, changes=back)  # a complete version is due
    assert read_state(spark, path).base == 40
    assert read_state(spark, path, before=1).files.count() == 2


def test_a_version_without_header_does_not_exist(rows, spark, tmp_path):
    path = str(tmp_path / "state")
    write_state(State(rows(TRANSFER_STATE, ROW), Scope("/R"), "c"), path, 0)
    rows(TRANSFER_STATE).write.parquet(f"{path}/files/version=1")
    assert read_state(spark, path).version == 0


@pytest.mark.parametrize("bad", [{"path": "../a"}, {"path": None}, {"rev": ""}, {"file_id": None}])
def test_invalid_state_rows_are_refused(rows, tmp_path, fails_with, bad):
    with fails_with("transfer state has an invalid row"):
        write_state(State(rows(TRANSFER_STATE, {**ROW, **bad})), str(tmp_path / "s"), 0)


def test_extraction_state_may_lack_a_path(rows, spark, tmp_path):
    path = str(tmp_path / "s")
    write_state(State(rows(EXTRACTION_STATE, {**ROW, "path": None}), layout=1), path, 0,
                kind="extraction")
    assert read_state(spark, path, kind="extraction").files.first().path is None


def document(tmp_path, value):
    path = tmp_path / "state.json"
    path.write_text(json.dumps(value) if not isinstance(value, str) else value)
    return str(path)


FILES = {"id:a": {"path": "a", "rev": "r", "content_hash": "h"}}
SCOPED = {"scope": {"path": "/R/", "recursive": True}, "files": FILES}


def test_stored_documents(spark, tmp_path):
    state = read_state_json(spark, document(tmp_path, {"version": 3, "cursor": "c", **SCOPED}))
    assert (state.scope, state.cursor, state.can_resume) == (Scope("/R"), "c", True)
    assert [tuple(r) for r in state.files.collect()] == [("id:a", "a", "r", "h")]
    older = read_state_json(spark, document(tmp_path, {"version": 2, "cursor": "c", **SCOPED}))
    assert (older.cursor, older.can_resume, older.legacy) == (None, False, False)
    oldest = read_state_json(spark, document(tmp_path, {"version": 1, "files": FILES}))
    assert oldest.legacy and oldest.scope is None and not oldest.can_resume
    extraction = {"version": 1, "files": {"id:a": {"rev": "r", "content_hash": "h"}}}
    got = read_state_json(spark, document(tmp_path, extraction), kind="extraction")
    assert got.files.first().path is None


def sound():
    """A valid document of the newest layout, to break one rule of at a time."""
    ledger = {"path": "books/ledger.csv", "rev": "7f", "content_hash": "ab12"}
    return {"version": 3, "cursor": "page-9", "scope": {"path": "/Books", "recursive": False},
            "files": {"n-41": ledger}}


BREAKS = {
    "unknown layout": lambda d: d.update(version=9),
    "no layout": lambda d: d.pop("version"),
    "no cursor": lambda d: d.pop("cursor"),
    "blank cursor": lambda d: d.update(cursor=""),
    "no scope": lambda d: d.pop("scope"),
    "scope without depth": lambda d: d["scope"].pop("recursive"),
    "scope without path": lambda d: d["scope"].pop("path"),
    "no files": lambda d: d.pop("files"),
    "files as a list": lambda d: d.update(files=["n-41"]),
    "blank id": lambda d: d["files"].update({"": d["files"].pop("n-41")}),
    "no rev": lambda d: d["files"]["n-41"].pop("rev"),
    "blank hash": lambda d: d["files"]["n-41"].update(content_hash=""),
    "path that climbs": lambda d: d["files"]["n-41"].update(path="books/../../ledger.csv"),
}


def test_the_document_that_is_broken_below_is_sound(spark, tmp_path):
    assert read_state_json(spark, document(tmp_path, sound())).files.count() == 1


@pytest.mark.parametrize("rule", BREAKS)
def test_a_document_with_one_broken_rule_is_refused(spark, tmp_path, rule):
    broken = sound()
    BREAKS[rule](broken)
    with pytest.raises(Exception, match="state"):
        read_state_json(spark, document(tmp_path, broken)).files.collect()


def test_a_document_that_is_no_json_is_refused(spark, tmp_path):
    with pytest.raises(ContractError):
        read_state_json(spark, document(tmp_path, "version 3"))


def test_advancing(rows):
    state = State(rows(TRANSFER_STATE), Scope("/R"), "old")
    assert state.advanced(state.files, "new", Scope("/R")).cursor == "new"
    assert state.advanced(state.files, "new", Scope("/R"), errors=1).cursor == "old"
    with pytest.raises(ContractError):
        state.advanced(state.files, "", Scope("/R"))


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named and scratch(spark, "x").startswith(named)
    require_utc(spark)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ConfigurationError):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
