"""Streamed queries land their input spread over the tasks, however large it is."""

from pathlib import Path

import pytest

from filetally.catalog import QUERIES, streams
from filetally.session import shared_folder


@pytest.fixture
def tables(spark, tmp_path):
    """Tables of eight files each, whose rows are not in order."""
    documents = spark.range(240).selectExpr(
        "(id * 77) % 240 AS doc_id", "concat('text ', id) AS text", "'en' AS lang",
        "concat('s', id % 3) AS source", "CAST(100 AS BIGINT) AS n_chars",
    )
    events = spark.range(1200).selectExpr(
        "(id * 77) % 1200 AS event_id", "id % 40 AS user_id", "CAST(id AS DOUBLE) AS value",
        "element_at(array('error', 'signup', 'view'), CAST(id % 3 + 1 AS INT)) AS event_type",
    )
    for name, rows in (("documents", documents), ("events", events)):
        rows.repartition(8).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def landed(spark, label):
    """The files of the last folder of that label."""
    folder = max(
        Path(shared_folder(spark), "filetally").glob(f"{label}-*"), key=lambda f: f.stat().st_mtime
    )
    return sorted(folder.glob("*.parquet"))


def test_retried_documents_land_as_one_batch_of_several_files(spark, tables):
    got = {r.file_id: r.attempts for r in streams.streamed_extraction_retries(spark, tables).collect()}
    assert len(landed(spark, "retried-pages")) > 1
    # Of the suffixes the extraction knows; what timed out took one more attempt, not more.
    assert got and got == {
        f: 2 if n % 13 == 5 and n % 11 != 3 else 1 for f, n in ((f, int(f[3:])) for f in got)
    }
    assert 2 in got.values()


@pytest.mark.parametrize("name, label, batch_form", [
    ("streamed_changes", "change-pages", "change_entries"),
    ("streamed_current_entries", "change-pages", "current_entries"),
    ("streamed_entry_view", "view-pages", "current_entries")])
def test_files_of_a_feed_follow_its_rows(spark, tables, monkeypatch, name, label, batch_form):
    monkeypatch.setattr(streams, "LANDED", 200, raising=False)
    got = sorted(map(tuple, getattr(streams, name)(spark, tables).collect()))
    assert got == sorted(map(tuple, QUERIES[batch_form](spark, tables).collect()))
    files = landed(spark, label)
    pages = [{r.page for r in spark.read.parquet(str(f)).select("page").distinct().collect()}
             for f in files]
    assert len(files) == 6 and sum(map(len, pages)) == 12  # a page is in one file


def test_buckets_of_a_view_follow_its_feed(spark, tables, monkeypatch):
    monkeypatch.setattr(streams, "LANDED", 40, raising=False)
    got = sorted(map(tuple, streams.streamed_entry_view(spark, tables).collect()))
    assert got == sorted(map(tuple, QUERIES["current_entries"](spark, tables).collect()))
    view = max(Path(shared_folder(spark), "filetally").glob("entry-view-*/rows"),
               key=lambda f: f.stat().st_mtime)
    buckets = {int(f.name.removeprefix("bucket=")) for f in view.glob("batch_id=*/bucket=*")}
    assert len(buckets) > 16 and buckets <= set(range(30))  # 1,200 rows, 40 to a bucket at most


def test_ranges_of_files_land_in_several_files_a_batch(spark, tables):
    got = sorted(map(tuple, streams.streamed_files(spark, tables).collect()))
    assert got == sorted(map(tuple, QUERIES["written_records"](spark, tables).collect()))
    assert len(landed(spark, "landed-files")) > 3


def test_ranges_of_records_land_in_several_files_a_batch(spark, tables):
    got = {r.idx: r.outcome for r in streams.streamed_records(spark, tables).collect()}
    assert got == {0: "written", 1: "invalid"} | {i: "not_reached" for i in range(2, 240)}
    assert len(landed(spark, "landed-records")) > 3
    ledger = max(Path(shared_folder(spark), "filetally").glob("record-stream-*/ledger"),
                 key=lambda f: f.stat().st_mtime)
    assert [f.name for f in sorted(ledger.glob("batch_id=*"))] == [f"batch_id={k}" for k in range(3)]
