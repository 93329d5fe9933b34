from hashlib import sha512

import pytest
from pyspark.sql import functions as F

from filetally.schemas import FILE_RECORD, LISTING_ROW
from filetally.operators.records import releasable_checkpoints, validate_records
from filetally.sources.listing import stream_listing
from filetally.sources.records import plan_writes
from filetally.streaming import (
    current_entries,
    entry_view,
    read_checkpoints,
    read_ledger,
    read_records,
    start_gate_stream,
    start_record_stream,
    start_view_stream,
)
from filetally.streaming.records import gate_batch, settle_batch

RECORD = {"stream": "s", "content_base64": "aGVsbG8gd29ybGQ="}


@pytest.fixture
def land(tmp_path):
    """Land DataFrames as one file each, in order."""

    def append(folder, *frames):
        place = tmp_path / folder
        place.mkdir(exist_ok=True)
        for frame in frames:
            number = len(list(place.iterdir()))
            staged = tmp_path / f"{folder}-landing-{number}"
            frame.coalesce(1).write.parquet(str(staged))
            part = next(staged.glob("part-*.parquet"))
            (place / f"{number:04d}.parquet").write_bytes(part.read_bytes())
        return str(place)

    return append


def records(rows, *paths, first=0):
    made = [{**RECORD, "idx": first + i, "path": p} for i, p in enumerate(paths)]
    return rows(FILE_RECORD, *made)


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run_records(spark, folder, tmp_path, **options):
    raw = stream(spark, folder, FILE_RECORD)
    target = str(tmp_path / "target")
    start_record_stream(validate_records(raw, "/R"), target, str(tmp_path / "cp"),
                        **options).awaitTermination()
    return target, {r.idx: r.outcome for r in read_ledger(spark, target).collect()}


def test_bytes_of_a_batch_stay_where_they_are(spark, rows, tmp_path):
    paths = [f"{sha512(b'%d' % i).hexdigest()}/{i}" for i in range(400)]
    records(rows, *paths).repartitionByRange(8, "idx").write.parquet(str(tmp_path / "in"))
    batch = validate_records(spark.read.schema(FILE_RECORD).parquet(str(tmp_path / "in")), "/R")
    # The plan is above this size, the indexes of the files are below.
    session = {"spark.sql.autoBroadcastJoinThreshold": "16k", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in session}
    try:
        for name, value in session.items():
            spark.conf.set(name, value)
        for batch_id in (0, 1):  # the second one has nothing but replays
            settle_batch(batch, batch_id, str(tmp_path / "target"))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    landed, held = (
        [{r.idx for r in spark.read.parquet(str(f)).select("idx").collect()}
         for f in (tmp_path / folder).glob("*.parquet")]
        for folder in ("in", "target/files/batch_id=0")
    )
    assert sorted(i for h in held for i in h) == list(range(400)) and len(landed) == 8
    assert all(any(part <= h for h in held) for part in landed)
    assert spark.read.parquet(str(tmp_path / "target/files/batch_id=1")).count() == 0


def test_records_over_several_batches_equal_one_run(spark, rows, land, tmp_path):
    one, two = records(rows, "a", "b", "a"), records(rows, "b", "c", "../bad", "d", first=3)
    target, outcomes = run_records(spark, land("in", one, one, two, two), tmp_path)
    whole = validate_records(one.unionByName(two), "/R")
    assert outcomes == {r.idx: r.outcome for r in plan_writes(whole).collect()}
    assert {r.idx: r.destination_path for r in read_records(spark, target).collect()} == {
        2: "/R/a", 3: "/R/b", 4: "/R/c"}
    after = records(rows, "e", first=7)  # the run has ended
    assert run_records(spark, land("in", after), tmp_path)[1][7] == "not_reached"


def test_a_repeated_batch_changes_nothing(spark, rows, tmp_path):
    target = str(tmp_path / "t")
    one = validate_records(records(rows, "a", "b"), "/R")
    two = validate_records(records(rows, "a", "c", first=2), "/R")

    def state():
        files = sorted((r.idx, r.destination_path) for r in read_records(spark, target).collect())
        return files, sorted(map(tuple, read_ledger(spark, target).collect()))

    settle_batch(one, 0, target)
    settle_batch(two, 1, target)
    before = state()
    settle_batch(two, 1, target)
    settle_batch(one, 2, target)  # landed again, as a batch of its own
    assert state() == before and [f[1] for f in before[0]] == ["/R/b", "/R/a", "/R/c"]


def test_the_fail_policy_minds_what_the_target_holds(spark, rows, land, tmp_path):
    existing = spark.createDataFrame([("/R/kept",)], "destination_path string")
    source = land("in", records(rows, "a", "b"), records(rows, "c", "a", "d", first=2))
    _, outcomes = run_records(spark, source, tmp_path, policy="fail", existing=existing)
    assert outcomes == {0: "written", 1: "written", 2: "written", 3: "conflict", 4: "not_reached"}
    other = tmp_path / "other"
    other.mkdir()
    source = land("in2", records(rows, "x", "kept", "y"))
    _, outcomes = run_records(spark, source, other, policy="fail", existing=existing)
    assert outcomes == {0: "written", 1: "conflict", 2: "not_reached"}


LOG = "run int, idx int, kind string, failed boolean"


def test_a_live_gate_equals_the_batch_form(spark, land, tmp_path):
    every = [(run, i, "state" if i % 3 == 2 else "record", (run, i) in {(1, 7), (2, 0), (1, 9)})
             for i in range(12) for run in (1, 2, 3)]
    parts = [spark.createDataFrame(every[k : k + 9], LOG) for k in range(0, len(every), 9)]
    folder = land("log", *parts, parts[0])
    target = str(tmp_path / "gate")
    log = stream(spark, folder, parts[0].schema)
    start_gate_stream(log, target, str(tmp_path / "cp")).awaitTermination()
    got = {(int(r.run), r.idx): r.released for r in read_checkpoints(spark, target).collect()}
    whole = releasable_checkpoints(spark.createDataFrame(every, LOG)).collect()
    first = {(1, 2), (2, 2), (3, 2)}  # landed again once the failures were known
    assert {k: v for k, v in got.items() if k not in first} == {
        (r.run, r.idx): r.released for r in whole if (r.run, r.idx) not in first}
    assert got[3, 2] and got[1, 2] and not got[2, 2]
    gate_batch(parts[1], 1, target)  # repeated
    assert {(int(r.run), r.idx): r.released for r in read_checkpoints(spark, target).collect()} == got


def test_a_view_reads_the_buckets_of_its_keys(spark, rows, land, tmp_path):
    def entry(page, ordinal, file_id, rev, kind="file"):
        path = f"/R/{file_id}"
        return {"page": page, "ordinal": ordinal, "entry_type": kind, "id": f"id:{file_id}",
                "name": file_id, "path_display": path, "path_lower": path, "rev": rev,
                "content_hash": rev, "size": 1}

    pages = [
        rows(LISTING_ROW, *[entry(0, k, f"f{k}", "r1") for k in range(40)]),
        rows(LISTING_ROW, entry(1, 50, "f3", "r2"), entry(1, 51, "new", "r1")),
    ]
    folder = land("pages", *pages, pages[0])  # the first page is replayed at the end
    listing = stream_listing(spark, folder, layout="rows")
    view = entry_view(listing, str(tmp_path / "view"), buckets=8)
    start_view_stream(listing, view, str(tmp_path / "cp")).awaitTermination()
    from filetally.streaming.changes import entries_with_order

    whole = entries_with_order(pages[0].unionByName(pages[1]))
    expected = sorted(map(str, current_entries(whole).collect()))
    assert sorted(map(str, view.read(spark).collect())) == expected
    wanted = spark.createDataFrame([("file:id:f3",), ("none",)], "entry_key string")
    found = view.lookup(wanted)
    assert [(r.entry_key, r.rev) for r in found.collect()] == [("file:id:f3", "r2")]
    buckets = {r.bucket for r in wanted.select(view.bucket_of().alias("bucket")).collect()}
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in found.inputFiles()} <= buckets
    second = spark.read.parquet(str(tmp_path / "view" / "rows" / "batch_id=1"))
    assert second.select("bucket").distinct().count() <= 2  # two keys changed
    before = view.read(spark, before=1)
    assert before.count() == 40 and before.where(F.col("rev") == "r2").isEmpty()
