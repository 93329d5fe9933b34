import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import types as T

from filetally.errors import ContractError
from filetally.operators.keyed import dedupe_replay
from filetally.operators.relations import entries
from filetally.schemas import EXTRACTION_RESULT, LISTING_PAGE, LISTING_ROW, TRANSFER_STATE
from filetally.sources.listing import stream_listing, stream_pages
from filetally.sources.keyed_state import KeyedState
from filetally.sources.state import Scope, State, read_header, read_state, write_state
from filetally.streaming import (
    current_entries,
    read_changes,
    start_change_stream,
    start_extraction_stream,
    start_migration_stream,
)


def entry(ordinal, file_id, path, rev="r1", kind="file", page=0, **more):
    return {"page": page, "ordinal": ordinal, "entry_type": kind, "id": file_id,
            "name": path.rsplit("/", 1)[1], "path_display": path, "path_lower": path.lower(),
            "rev": rev, "content_hash": rev, "size": 1, **more}


PAGES = [
    [entry(0, "id:a", "/R/a.pdf"), entry(1, "id:b", "/R/b.pdf")],
    [entry(2, "id:a", "/R/a.pdf", "r2", page=1), entry(3, None, "/R/b.pdf", kind="deleted", page=1)],
]


@pytest.fixture
def feed(rows, tmp_path):
    """Land pages one file at a time."""

    def land(*pages, more=()):
        folder = tmp_path / "in"
        folder.mkdir(exist_ok=True)
        for page in pages:
            number = len(list(folder.iterdir()))
            landed = {"page": page[0]["page"], "first_ordinal": page[0]["ordinal"],
                      "cursor": f"page-{number}", "entries": page,
                      "has_more": page[0]["page"] in more}
            temporary = tmp_path / f"landing-{number}"
            rows(LISTING_PAGE, landed).coalesce(1).write.parquet(str(temporary))
            part = next(temporary.glob("part-*.parquet"))
            (folder / f"page-{number:04d}.parquet").write_bytes(part.read_bytes())
        return str(folder)

    return land


def test_streamed_changes_equal_the_batch(feed, rows, spark, tmp_path):
    source = feed(*PAGES, PAGES[0])  # the first page is replayed at the end
    target, checkpoint = str(tmp_path / "log"), str(tmp_path / "cp")
    start_change_stream(stream_listing(spark, source), target, checkpoint).awaitTermination()
    log = read_changes(spark, target)
    assert log.count() == 6
    batch = entries(rows(LISTING_ROW, *PAGES[0], *PAGES[1]), keep=["page", "ordinal"])
    expected = sorted(map(str, dedupe_replay(batch, ["entry_key"], ["page", "ordinal"]).collect()))
    assert sorted(map(str, current_entries(log).collect())) == expected
    latest = {r.entry_key: r.rev for r in current_entries(log).collect()}
    assert latest == {"file:id:a": "r2", "file:id:b": "r1", "deleted:/r/b.pdf": None}


def test_a_failed_page_is_repeated_whole(feed, spark, tmp_path):
    source = feed(*PAGES)
    target, checkpoint = str(tmp_path / "log"), str(tmp_path / "cp")

    def break_second(batch):
        return batch.where("CASE WHEN page = 1 THEN raise_error('down') IS NULL ELSE true END")

    listing = stream_listing(spark, source)
    with pytest.raises(StreamingQueryException):
        start_change_stream(listing, target, checkpoint, mapper=break_second).awaitTermination()
    assert {r.page for r in read_changes(spark, target).collect()} == {0}
    start_change_stream(stream_listing(spark, source), target, checkpoint).awaitTermination()
    assert sorted(r.ordinal for r in read_changes(spark, target).collect()) == [0, 1, 2, 3]
    source = feed([entry(4, "id:c", "/R/c.pdf", page=2)])
    start_change_stream(stream_listing(spark, source), target, checkpoint).awaitTermination()
    assert read_changes(spark, target).count() == 5


def versions(spark, path, **kwargs):
    return {r.file_id: (r.path, r.rev) for r in read_state(spark, path, **kwargs).files.collect()}


@pytest.mark.parametrize("keyed", [False, True])
def test_incremental_migration(feed, spark, tmp_path, keyed):
    target, checkpoint, scope = str(tmp_path / "m"), str(tmp_path / "cp"), Scope("/R")

    def run(*pages, **options):
        source = feed(*pages)
        start_migration_stream(stream_listing(spark, source), target, checkpoint, scope,
                               rename_policy="propagate", delete_policy="delete",
                               keyed=keyed, **options).awaitTermination()
        return state()

    def state():
        if keyed:
            files = KeyedState(f"{target}/state").files(spark)
            return {r.file_id: (r.path, r.rev) for r in files.collect()}
        return versions(spark, f"{target}/state")

    assert run(PAGES[0]) == {"id:a": ("a.pdf", "r1"), "id:b": ("b.pdf", "r1")}
    assert run(PAGES[1]) == {"id:a": ("a.pdf", "r2")}
    moved = [entry(4, "id:a", "/R/new.pdf", "r2"), entry(5, None, "/R/a.pdf", kind="deleted")]
    asked = []

    def only(wanted):
        def transfer(due):
            asked.append(sorted(r.file_id for r in due.collect()))
            return due.where(f"file_id = '{wanted}'")
        return transfer

    added = [entry(6, "id:c", "/R/c.pdf"), entry(7, "id:d", "/R/d.pdf")]
    with pytest.raises(StreamingQueryException):  # one transfer fails: no progress of the state
        run([*moved, *added], transfer=only("id:c"))
    assert state() == {"id:a": ("a.pdf", "r2")}
    assert run(transfer=only("id:d")) == {
        "id:a": ("new.pdf", "r2"), "id:c": ("c.pdf", "r1"), "id:d": ("d.pdf", "r1")}
    assert asked == [["id:c", "id:d"], ["id:d"]]  # what was delivered is not asked for again
    head = read_header(spark, f"{target}/state", None)
    assert (head.version, head.base, head.cursor) == (2, 2 if keyed else 0, "batch-2")
    decided = spark.read.parquet(f"{target}/decisions").where("batch_id = 2").collect()
    assert sorted((r.operation, r.file_id, r.transfer) for r in decided if r.operation) == [
        ("move", "id:a", False)]


def test_migration_needs_a_cursor_once_there_is_state(feed, rows, spark, tmp_path):
    target = str(tmp_path / "m")
    row = {"file_id": "id:x", "path": "x", "rev": "r", "content_hash": "h"}
    write_state(State(rows(TRANSFER_STATE, row), Scope("/R")), f"{target}/state", -1)
    with pytest.raises((StreamingQueryException, ContractError), match="no cursor"):
        start_migration_stream(stream_listing(spark, feed(PAGES[0])), target,
                               str(tmp_path / "cp"), Scope("/R")).awaitTermination()
    assert versions(spark, f"{target}/state") == {"id:x": ("x", "r")}


def test_incremental_extraction(feed, rows, spark, tmp_path):
    target, checkpoint = str(tmp_path / "x"), str(tmp_path / "cp")
    asked = []

    def extract(due):
        asked.append(sorted((r.file_id, r.rev) for r in due.collect()))
        late = len(asked) == 1
        return rows(EXTRACTION_RESULT, *[
            {"file_id": f, "rev": r, "content_hash": r,
             "status": "timed_out" if late and f == "id:b" else "succeeded", "markdown": "#"}
            for f, r in asked[-1]])

    def run(*pages):
        start_extraction_stream(stream_listing(spark, feed(*pages)), target, checkpoint, extract,
                                [".pdf"]).awaitTermination()

    run(PAGES[0])
    run([*PAGES[0], entry(9, "id:t", "/R/t.txt")], PAGES[1])
    assert asked == [[("id:a", "r1"), ("id:b", "r1")], [("id:b", "r1")], [("id:a", "r2")]]
    done = versions(spark, f"{target}/state", kind="extraction")
    assert done == {"id:a": ("/r/a.pdf", "r2"), "id:b": ("/r/b.pdf", "r1")}
    records = spark.read.parquet(f"{target}/file_contents")
    assert sorted(r.extraction_status for r in records.collect()) == [
        "succeeded", "succeeded", "succeeded", "timed_out"]


def page_of(number, *entries):
    return [dict(e, page=number) for e in entries]


def test_a_run_is_planned_once_its_last_page_has_landed(feed, spark, tmp_path):
    """The tombstone lands before the new path, and pages of a run in any order."""
    target, checkpoint, scope = str(tmp_path / "m"), str(tmp_path / "cp"), Scope("/R")

    def run(*pages, more=()):
        start_migration_stream(stream_pages(spark, feed(*pages, more=more)), target, checkpoint,
                               scope, rename_policy="propagate", delete_policy="delete",
                               ).awaitTermination()
        return versions(spark, f"{target}/state")

    first = page_of(0, entry(0, "id:a", "/R/a.pdf"), entry(1, "id:b", "/R/b.pdf"))
    second = page_of(1, entry(2, "id:c", "/R/c.pdf"), entry(3, "id:out", "/Other/x.pdf"))
    assert run(first, more=[0]) == {}
    whole = {"id:a": ("a.pdf", "r1"), "id:b": ("b.pdf", "r1"), "id:c": ("c.pdf", "r1")}
    assert run(second) == whole
    state = read_state(spark, f"{target}/state")
    assert (state.version, state.cursor) == (1, "page-1")

    gone = page_of(2, entry(4, None, "/R/a.pdf", kind="deleted"), entry(5, None, "/R/c.pdf", kind="deleted"))
    come = page_of(3, entry(6, "id:a", "/R/sub/a.pdf"))
    assert run(first, come, more=[0]) == whole  # a replay, and the run's page 2 is missing
    assert run(gone, more=[2]) == {"id:a": ("sub/a.pdf", "r1"), "id:b": ("b.pdf", "r1")}
    decided = spark.read.parquet(f"{target}/decisions").where("batch_id = 4").collect()
    assert sorted((r.operation, r.file_id, r.transfer) for r in decided if r.operation) == [
        ("delete", "id:c", False), ("move", "id:a", False)]
    assert run(page_of(4, entry(7, "id:d", "/R/d.pdf")), page_of(5, entry(8, "id:d", "/R/d.pdf", "r2")),
               more=[4])["id:d"] == ("d.pdf", "r2")
    assert read_state(spark, f"{target}/state").cursor == "page-6"


def test_timeouts_are_settled_without_new_pages(feed, rows, spark, tmp_path):
    target, checkpoint = str(tmp_path / "x"), str(tmp_path / "cp")
    asked, late = [], {"id:a", "id:b"}

    def extract(due):
        asked.append(sorted((r.file_id, r.rev) for r in due.collect()))
        return rows(EXTRACTION_RESULT, *[
            {"file_id": f, "rev": r, "content_hash": r,
             "status": "timed_out" if f in late else "succeeded", "markdown": "#"}
            for f, r in asked[-1]])

    def run(*pages):
        start_extraction_stream(stream_listing(spark, feed(*pages)), target, checkpoint, extract,
                                [".pdf"]).awaitTermination()
        return versions(spark, f"{target}/state", kind="extraction")

    assert run(PAGES[0]) == {}
    late.discard("id:b")
    assert run() == {"id:b": ("/r/b.pdf", "r1")}  # nothing landed
    late.clear()
    # A newer version of what is pending comes with the next page: the old one is not due.
    assert run(PAGES[1]) == {"id:b": ("/r/b.pdf", "r1"), "id:a": ("/r/a.pdf", "r2")}
    calls = len(asked)
    assert run()["id:a"] == ("/r/a.pdf", "r2")
    assert [a for a in asked[calls:] if a] == []  # a last wake-up may find nothing to do
    assert asked[0] == [("id:a", "r1"), ("id:b", "r1")]
    assert ("id:a", "r2") in asked[-1] or ("id:a", "r2") in asked[calls - 1]


def test_a_keyed_state_reads_the_buckets_a_delta_names(rows, spark, tmp_path):
    table = KeyedState(str(tmp_path / "keyed"), buckets=16)
    FILES = T.StructType([*TRANSFER_STATE.fields, T.StructField("removed", T.BooleanType())])

    def row(k, path=None, removed=False):
        return {"file_id": f"id:{k}", "path": path or f"Dir/File-{k}", "rev": "r",
                "content_hash": "h", "removed": removed}

    table.merge(rows(FILES, *[row(k) for k in range(200)]), 0)
    table.merge(rows(FILES, row(3, "moved/Straße"), row(4, removed=True), row(5, "dir/file-5")), 1)
    table.merge(rows(FILES, row(3, "moved/Straße"), row(4, removed=True), row(5, "dir/file-5")), 1)
    assert table.files(spark).count() == 199

    def named(ids, paths):
        found = table.named(
            spark.createDataFrame([(f"id:{k}",) for k in ids], "file_id string"),
            spark.createDataFrame([(p,) for p in paths], "path string"))
        return {r.file_id: r.path for r in found.collect()}, found.inputFiles()

    got, read = named([7, 4], ["DIR/FILE-9", "Dir/File-3", "MOVED/STRASSE", "dir/File-5", "none"])
    assert got == {"id:7": "Dir/File-7", "id:9": "Dir/File-9", "id:3": "moved/Straße",
                   "id:5": "dir/file-5"}
    data = [f for f in read if "/by_id/rows/" in f]
    assert 0 < len(data) <= 5 and not [f for f in read if "/by_path/" in f]
