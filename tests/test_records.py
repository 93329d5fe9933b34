import base64
import hashlib

import pytest

from filetally.errors import ConfigurationError, ContractError
from filetally.operators.records import (
    missing_folders,
    releasable_checkpoints,
    validate_operations,
    validate_records,
    verify_staged,
)
from filetally.schemas import FILE_RECORD, OPERATION, STAGED_REFERENCE
from filetally.sources.records import plan_writes, write_records
from filetally.sources.staged import file_digests, read_staged, write_staged

TEXT = b"hello world"
DIGEST = hashlib.sha256(TEXT).hexdigest()
RECORD = {"idx": 0, "stream": "s", "path": "folder/report.pdf",
          "content_base64": base64.b64encode(TEXT).decode(), "sha256": DIGEST,
          "modified_at": "2026-08-18T14:00:00+02:00"}


def error_of(rows, **changes):
    checked = validate_records(rows(FILE_RECORD, {**RECORD, **changes}), "/Exports", 1, ["s"])
    return checked.first().error


def test_a_sound_record(rows):
    row = validate_records(rows(FILE_RECORD, RECORD), "/Exports").first()
    assert row.error is None and bytes(row.content) == TEXT
    assert (row.destination_path, row.sha256, row.modified_at) == (
        "/Exports/folder/report.pdf", DIGEST, "2026-08-18T12:00:00Z")
    row = validate_records(rows(FILE_RECORD, RECORD), "", metadata_policy="ignore").first()
    assert (row.destination_path, row.modified_at) == ("/folder/report.pdf", None)
    bare = {**RECORD, "sha256": None, "modified_at": None}
    row = validate_records(rows(FILE_RECORD, bare), "").first()
    assert (row.error, row.sha256, row.modified_at) == (None, None, None)


@pytest.mark.parametrize("path", ["/abs", "a\\b", "a//b", "../a", "a/./b", "a/"])
def test_bad_paths(rows, path):
    assert error_of(rows, path=path) == "invalid_path"


@pytest.mark.parametrize("text", ["not base64!", "SGVsbG8", "SGVsbG8==", "SGVs bG8=", "====",
                                  "SGVsbG8=\n", "SG=sbG8=", "é" * 4])
def test_bad_base64(rows, text):
    assert error_of(rows, content_base64=text) == "invalid_base64"


@pytest.mark.parametrize("length", range(1, 9))
def test_base64_of_every_tail_length(rows, length):
    body = bytes(range(length))
    text = base64.b64encode(body).decode()
    row = validate_records(
        rows(FILE_RECORD, {**RECORD, "content_base64": text, "sha256": None}), "").first()
    assert bytes(row.content) == body


def test_size_cap_is_inclusive(rows):
    cap = 1024 * 1024
    for extra, error in ((0, None), (1, "content_too_large")):
        text = base64.b64encode(b"x" * (cap + extra)).decode()
        assert error_of(rows, content_base64=text, sha256=None) == error


@pytest.mark.parametrize("digest, error", [
    ("ABC", "invalid_sha256"), (DIGEST.upper(), "invalid_sha256"), ("", "invalid_sha256"),
    (hashlib.sha256(b"x").hexdigest(), "sha256_mismatch")])
def test_digests(rows, digest, error):
    assert error_of(rows, sha256=digest) == error


@pytest.mark.parametrize("time", [
    "2026-08-18 12:00:00Z", "2026-08-18T12:00:00", "2026-02-30T12:00:00Z", "", "now",
    "2026-08-18T25:00:00Z", "2026-08-18T12:00:00+0200"])
def test_bad_times(rows, time):
    assert error_of(rows, modified_at=time) == "invalid_modified_at"


def test_first_rule_wins(rows):
    bad = {"stream": "x", "path": "", "content_base64": "", "sha256": "x", "modified_at": "x"}
    order = [("stream", "s", "unknown_stream"), ("path", "a", "missing_path"),
             ("content_base64", RECORD["content_base64"], "missing_content"),
             ("sha256", DIGEST, "invalid_sha256"), ("modified_at", None, "invalid_modified_at")]
    for field, good, error in order:
        assert error_of(rows, **bad) == error
        bad[field] = good
    assert error_of(rows, **bad) is None


def test_bounds_policies_and_fail_closed(rows):
    df = rows(FILE_RECORD, {**RECORD, "content_base64": "secret text"})
    for bad in ({"max_mb": 0}, {"max_mb": 65}, {"max_mb": True}, {"metadata_policy": "drop"}):
        with pytest.raises(ConfigurationError):
            validate_records(df, "", **bad)
    with pytest.raises(ContractError) as caught:
        validate_records(df, "", fail_closed=True)
    assert "secret" not in str(caught.value)
    with pytest.raises(ConfigurationError):
        validate_records(df, "/root/")


def records(rows, *paths):
    content = [base64.b64encode(str(i).encode()).decode() for i in range(len(paths))]
    return validate_records(
        rows(FILE_RECORD, *[{"idx": i, "path": p, "content_base64": content[i]}
                            for i, p in enumerate(paths)]), "/R")


def planned(df):
    return [r.outcome for r in sorted(df.collect(), key=lambda r: r.idx)]


def test_write_plans(rows, spark):
    four = records(rows, "a", "b", "a", "c")
    assert planned(plan_writes(four)) == ["superseded", "written", "written", "written"]
    assert planned(plan_writes(four, policy="fail")) == [
        "written", "written", "conflict", "not_reached"]
    taken = spark.createDataFrame([("/R/b",)], "destination_path string")
    assert planned(plan_writes(four, taken, "fail")) == [
        "written", "conflict", "not_reached", "not_reached"]
    broken = records(rows, "a", "../x", "a", "b")
    assert planned(plan_writes(broken)) == ["written", "invalid", "not_reached", "not_reached"]
    assert planned(plan_writes(broken, policy="fail")) == [
        "written", "invalid", "not_reached", "not_reached"]
    with pytest.raises(ConfigurationError):
        plan_writes(four, policy="merge")


def test_written_records_converge_on_replay(rows, spark, tmp_path):
    target = str(tmp_path / "out")
    for _ in range(2):
        write_records(records(rows, "a", "b", "a"), target)
        got = {r.destination_path: bytes(r.content) for r in spark.read.parquet(target).collect()}
        assert got == {"/R/a": b"2", "/R/b": b"1"}
    with pytest.raises(ContractError):
        write_records(records(rows, "a", "../x"), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    write_records(records(rows, "a", "../x", "b"), str(tmp_path / "part"), fail_closed=False)
    assert [r.idx for r in spark.read.parquet(str(tmp_path / "part")).collect()] == [0]


def test_missing_folders(spark):
    paths = spark.createDataFrame(
        [("/R/a/b/1",), ("/R/a/b/2",), ("/R/c/3",), ("/R/4",)], "destination_path string")
    existing = spark.createDataFrame([("/R/c",), ("/other",)], "folder string")
    assert sorted(r.folder for r in missing_folders(paths, existing, "/R").collect()) == [
        "/R/a", "/R/a/b"]
    assert sorted(r.folder for r in missing_folders(paths, existing, "").collect()) == [
        "/R", "/R/a", "/R/a/b"]


@pytest.fixture(params=[True, False], ids=["content", "listing"])
def staging(request, spark, tmp_path):
    folder = tmp_path / "stage + area"
    folder.mkdir()
    (folder / "one file.bin").write_bytes(TEXT)
    return folder, read_staged(spark, str(folder), content=request.param)


def reference(folder, **changes):
    return {"idx": 0, "staging_file_url": str(folder / "one file.bin"), "relative_path": "a/one.bin",
            "file_size_bytes": len(TEXT), "sha256": DIGEST,
            "client_modified": "2026-08-18T12:00:00Z", **changes}


def test_staged_files(rows, staging):
    folder, staged = staging
    url = "file://" + str(folder / "one file.bin").replace(" ", "%20")
    for place in (str(folder / "one file.bin"), url, url.replace("file://", "file://localhost")):
        row = verify_staged(rows(STAGED_REFERENCE, reference(folder, staging_file_url=place)),
                            staged, "/R").first()
        assert (row.error, row.destination_path, row.sha256) == (None, "/R/a/one.bin", DIGEST)
        assert row.client_modified == "2026-08-18T12:00:00Z"


@pytest.mark.parametrize("changes, error", [
    ({"staging_file_url": None}, "missing_staging_url"),
    ({"staging_file_url": "https://host/x"}, "not_a_local_url"),
    ({"staging_file_url": "file://host/x"}, "not_a_local_url"),
    ({"staging_file_url": "//host/x"}, "not_a_local_url"),
    ({"staging_file_url": "/nowhere"}, "staged_file_unavailable"),
    ({"staging_file_url": "file:/nowhere"}, "staged_file_unavailable"),
    ({"relative_path": ""}, "missing_relative_path"),
    ({"relative_path": "../a"}, "invalid_relative_path"),
    ({"file_size_bytes": None}, "invalid_size"), ({"file_size_bytes": -1}, "invalid_size"),
    ({"file_size_bytes": 1}, "size_mismatch"), ({"sha256": "0" * 64}, "sha256_mismatch"),
    ({"sha256": "short"}, None), ({"sha256": None}, None),
    ({"client_modified": "yesterday"}, "invalid_client_modified"),
    ({"client_modified": "2026-08-18T12:00:00"}, "invalid_client_modified"),
    ({"client_modified": None}, None)])
def test_staged_file_rules(rows, staging, changes, error):
    folder, staged = staging
    refs = rows(STAGED_REFERENCE, reference(folder, **changes))
    assert verify_staged(refs, staged, "").first().error == error
    if error == "invalid_client_modified":
        row = verify_staged(refs, staged, "", metadata_policy="ignore").first()
        assert (row.error, row.client_modified) == (None, None)


def test_staged_files_of_any_size_are_read(spark, tmp_path):
    (tmp_path / "big.bin").write_bytes(b"x" * (3 * 1024 * 1024 + 1))
    (tmp_path / "small.bin").write_bytes(b"x")
    got = {r.path.rsplit("/", 1)[1]: r for r in read_staged(spark, str(tmp_path)).collect()}
    assert len(got["big.bin"].content) == got["big.bin"].length == 3 * 1024 * 1024 + 1
    assert bytes(got["small.bin"].content) == b"x"


def test_a_file_that_no_row_can_hold_is_no_digest_mismatch(rows, staging):
    folder, staged = staging
    unread = staged.selectExpr("path", "length", "CAST(NULL AS BINARY) AS content")
    refs = rows(STAGED_REFERENCE, reference(folder))
    assert verify_staged(refs, unread, "").first().error == "digest_unavailable"
    refs = rows(STAGED_REFERENCE, reference(folder, sha256=None))
    assert verify_staged(refs, unread, "").first().error is None


def test_only_named_files_are_read_and_of_any_size(rows, spark, tmp_path):
    """A file beyond what a row holds, sparse on disk, and one that vanishes before it is read."""
    big, gone, other = (tmp_path / n for n in ("big.bin", "gone.bin", "other.bin"))
    size = 2**31 + 5
    with big.open("wb") as f:
        f.truncate(size)
    state, piece = hashlib.sha256(), bytes(1 << 20)
    for at in range(0, size, 1 << 20):
        state.update(piece[: size - at])
    gone.write_bytes(b"x")
    other.write_bytes(b"unnamed")
    staged = read_staged(spark, str(tmp_path), content=False).cache()
    assert staged.count() == 3
    gone.unlink()
    refs = rows(STAGED_REFERENCE, *[
        reference(tmp_path, idx=i, staging_file_url=str(path), file_size_bytes=length, sha256=digest)
        for i, (path, length, digest) in enumerate([
            (big, size, state.hexdigest()), (big, size, "0" * 64), (gone, 1, "0" * 64),
            (other, 7, None)])])
    checked = verify_staged(refs, staged, "/R")
    assert [r.error for r in checked.orderBy("idx").collect()] == [
        None, "sha256_mismatch", "digest_unavailable", None]
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and plan.count("MapInArrow") == 1
    other.unlink()  # no digest was asked for: it is not opened
    assert checked.where("idx = 3").first().error is None
    staged.unpersist()


MOVE = {"operation": "move", "file_id": "i", "old_path": "a", "old_content_hash": "h",
        "new_path": "b", "new_content_hash": "h"}


@pytest.mark.parametrize("changes, error", [
    ({}, None), ({"operation": "delete", "new_path": None, "new_content_hash": None}, None),
    ({"operation": "copy"}, "invalid_operation"), ({"operation": None}, "invalid_operation"),
    ({"file_id": ""}, "missing_file_id"), ({"old_path": None}, "missing_old_path"),
    ({"old_path": "../a"}, "invalid_old_path"), ({"old_content_hash": ""}, "missing_old_content_hash"),
    ({"new_path": None}, "missing_new_path"), ({"new_path": "/b"}, "invalid_new_path"),
    ({"new_content_hash": None}, "missing_new_content_hash")])
def test_control_records(rows, changes, error):
    assert validate_operations(rows(OPERATION, {**MOVE, **changes})).first().error == error


def test_checkpoint_gate(spark):
    log = spark.createDataFrame(
        [(1, 0, "record", False), (1, 1, "state", False), (1, 2, "record", True),
         (1, 3, "state", False), (1, 4, "record", False), (1, 5, "state", False),
         (2, 0, "state", False), (2, 1, "record", True)],
        "run int, idx int, kind string, failed boolean")
    got = {(r.run, r.idx): r.released for r in releasable_checkpoints(log).collect()}
    assert got == {(1, 1): True, (1, 3): False, (1, 5): False, (2, 0): True}


def test_rows_staged_as_files_are_listed_and_read_by_the_tasks(spark, tmp_path):
    texts = {f"a=%{i} é.txt": f"text {i}\n".encode() for i in range(40)} | {"empty.txt": b""}
    staged = spark.createDataFrame(list(texts.items()), "name string, content binary")
    for _ in range(2):  # a repeated task writes the same again
        assert write_staged(staged, f"file://{tmp_path}") == 41
    (tmp_path / "_hidden").mkdir()
    (tmp_path / "_hidden" / "empty.txt").write_bytes(b"x")
    listed = read_staged(spark, str(tmp_path), content=False)
    assert listed.inputFiles() and not any("folder=" in f for f in listed.inputFiles())
    got = {r.path: r.length for r in listed.collect()}
    assert {p.rsplit("/", 1)[1]: n for p, n in got.items()} == {
        name: len(content) for name, content in texts.items()
    }
    digests = file_digests(listed)
    assert digests.rdd.getNumPartitions() == 2  # as many as there are tasks, however short
    assert {r.path.rsplit("/", 1)[1]: r.digest for r in digests.collect()} == {
        name: hashlib.sha256(content).hexdigest() for name, content in texts.items()
    }


def test_names_are_listed_as_sparks_reader_lists_them(spark, tmp_path):
    names = ["part-1.txt", "part-12.txt", "part-a.csv", "part-(1).txt", "a^b.txt", "a,b.txt", "x]",
             "line\nbreak.txt", ".hidden.txt", "_hidden.txt", "_a=b.txt", "copy.txt._COPYING_"]
    for folder in ("", "_skipped", ".skipped", "k=1/deep", "empty"):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        for name in names if folder != "empty" else ():
            (tmp_path / folder / name).write_text(name)
    patterns = [None, "part-*.txt", "part-?.txt", "part-[0-9].txt", "part-[!0-9]*", "*.{csv,txt}",
                "a^b.txt", "{a^b,copy}.txt", "part-(1).txt", r"part-\?.txt", "a,b*", "*]"]
    for pattern in patterns:
        sparks, tasks = (
            {(r.path, r.length) for r in read_staged(spark, str(tmp_path), pattern, c)
             .select("path", "length").collect()}
            for c in (True, False)
        )
        assert tasks == sparks, pattern
