import itertools

import pytest

from filetally.errors import ConfigurationError, ContractError
from filetally.plans import (
    apply_operations,
    deduplicate_changes,
    migration_inventory,
    next_state,
    plan_delta,
    plan_migration,
    plan_snapshot,
    split_delta,
    state_changes,
    transfer_records,
)
from filetally.schemas import BOOLEAN, LISTING_ROW, LONG, OPERATION, STRING, TRANSFER_STATE, struct
from filetally.sources.state import Scope, State

FILES = struct(file_id=STRING, path=STRING, rev=STRING, content_hash=STRING, size=LONG,
               transferable=BOOLEAN, ordinal=LONG)
PATHS = struct(path=STRING)
SCOPE = Scope("/Exports/", True)


def version(file_id, path, rev="r1", content_hash="h1", **more):
    return {"file_id": file_id, "path": path, "rev": rev, "content_hash": content_hash, "size": 5,
            "transferable": True, **more}


@pytest.fixture
def state(rows):
    def make(*records, scope=SCOPE, cursor="cursor-1", layout=3):
        return State(rows(TRANSFER_STATE, *records), scope, cursor, layout)

    return make


def operations(plan):
    return [(r.operation, r.file_id, r.old_path, r.old_content_hash, r.new_path, r.new_content_hash)
            for r in plan.operations.orderBy("phase", "file_id").collect()]


def transfers(plan):
    return {r.file_id: (r.path, r.rev) for r in plan.transfers.collect()}


# state row?, path differs, bytes differ, rename policy -> operation, transfer path
TABLE = [
    (False, False, False, "ignore", None, "new.pdf"),
    (False, False, False, "propagate", None, "new.pdf"),
    (True, False, False, "ignore", None, None),
    (True, False, False, "propagate", None, None),
    (True, False, True, "ignore", None, "new.pdf"),
    (True, False, True, "propagate", None, "new.pdf"),
    (True, True, False, "ignore", None, None),
    (True, True, True, "ignore", None, "New.pdf"),
    (True, True, False, "propagate", "move", None),
    (True, True, True, "propagate", "move", "new.pdf"),
]


@pytest.mark.parametrize("form", ["snapshot", "delta"])
@pytest.mark.parametrize("known, renamed, changed, rename, operation, path", TABLE)
def test_truth_table(rows, state, form, known, renamed, changed, rename, operation, path):
    old = "New.pdf" if renamed else "new.pdf"  # comparison is case-sensitive
    stored = [version("id:a", old, "r0" if changed else "r1")] if known else []
    current = rows(FILES, version("id:a", "new.pdf"))
    options = {"scope": SCOPE, "rename_policy": rename, "delete_policy": "ignore"}
    plan = (plan_snapshot(current, state(*stored), **options) if form == "snapshot"
            else plan_delta(current, rows(PATHS), state(*stored), **options))
    assert [(o[0], o[2], o[4]) for o in operations(plan)] == (
        [("move", old, "new.pdf")] if operation else [])
    assert transfers(plan) == ({"id:a": (path, "r1")} if path else {})


def test_absent_ids_are_deleted_only_on_request(rows, state):
    stored = [version("id:gone", "gone.pdf", content_hash="h2"), version("id:here", "a")]
    current = rows(FILES, version("id:here", "a"))
    kept = plan_snapshot(current, state(*stored), scope=SCOPE)
    assert operations(kept) == []
    plan = plan_snapshot(current, state(*stored), scope=SCOPE, delete_policy="delete")
    assert operations(plan) == [("delete", "id:gone", "gone.pdf", "h2", None, None)]


def test_moves_come_before_deletes(rows, state):
    stored = [version("id:a", "gone"), version("id:z", "old", content_hash="h0")]
    plan = plan_snapshot(rows(FILES, version("id:z", "new")), state(*stored), scope=SCOPE,
                         rename_policy="propagate", delete_policy="delete")
    assert operations(plan) == [("move", "id:z", "old", "h0", "new", "h1"),
                                ("delete", "id:a", "gone", "h1", None, None)]
    assert transfers(plan) == {"id:z": ("new", "r1")}


def test_oversized_files_are_present_but_not_transferred(rows, state):
    stored = [version("id:big", "old", "r0")]
    current = rows(FILES, version("id:big", "new", transferable=False),
                   version("id:new", "b", transferable=False))
    plan = plan_snapshot(current, state(*stored), scope=SCOPE, rename_policy="propagate",
                         delete_policy="delete")
    assert [o[0] for o in operations(plan)] == ["move"] and transfers(plan) == {}


@pytest.mark.parametrize("bad", [
    {"file_id": ""}, {"rev": None}, {"content_hash": ""}, {"path": "../x"}, {"path": None}])
def test_versions_are_checked(rows, state, fails_with, bad):
    with fails_with("A file has an invalid path" if "path" in bad else "requires non-empty id"):
        plan = plan_snapshot(rows(FILES, {**version("id:a", "a"), **bad}), state(), scope=SCOPE)
        plan.transfers.collect()


def test_duplicate_ids_in_an_inventory_fail(rows, state, fails_with):
    with fails_with("duplicate file_id id:a"):
        plan_snapshot(rows(FILES, version("id:a", "a"), version("id:a", "b")), state(),
                      scope=SCOPE).operations.collect()


def test_policies_are_closed_sets(rows, state):
    for rename, delete in (("copy", "ignore"), ("ignore", "drop")):
        with pytest.raises(ConfigurationError):
            plan_snapshot(rows(FILES), state(), scope=SCOPE, rename_policy=rename,
                          delete_policy=delete)


def test_scope_rules(rows, state):
    current = rows(FILES, version("id:a", "a"))
    other = Scope("/Other", True)
    adopted = plan_snapshot(current, state(scope=None, cursor=None), scope=SCOPE,
                            delete_policy="delete")
    assert adopted.state.scope == SCOPE
    mismatched = state(version("id:a", "a"), scope=other)
    for policies in ({"rename_policy": "propagate"}, {"delete_policy": "delete"}):
        with pytest.raises(ContractError):
            plan_snapshot(current, mismatched, scope=SCOPE, **policies)
    fresh = plan_snapshot(current, mismatched, scope=SCOPE)
    assert transfers(fresh) == {"id:a": ("a", "r1")} and fresh.state.scope == SCOPE
    legacy = state(version("id:a", "a"), scope=None, cursor=None, layout=1)
    with pytest.raises(ContractError):
        plan_snapshot(current, legacy, scope=SCOPE, delete_policy="delete")
    assert transfers(plan_snapshot(current, legacy, scope=SCOPE)) == {"id:a": ("a", "r1")}
    for scope in (None, other, Scope("/Exports", False)):
        with pytest.raises(ContractError):
            plan_delta(current, rows(PATHS), state(scope=scope), scope=SCOPE)


def test_delta_tombstones(rows, state):
    stored = [version("id:deleted", "Gone/A.pdf", content_hash="h2"),
              version("id:renamed", "old.pdf"), version("id:kept", "kept.pdf"),
              version("id:one", "twin.pdf"), version("id:two", "TWIN.pdf")]
    changed = rows(FILES, version("id:renamed", "new.pdf"), version("id:new", "b.pdf"))
    dead = rows(PATHS, *[{"path": p} for p in (
        "gone/a.PDF", "GONE/A.pdf", "OLD.pdf", "unknown.pdf", "twin.PDF")])
    options = {"scope": SCOPE, "delete_policy": "delete"}
    moved = plan_delta(changed, dead, state(*stored), rename_policy="propagate", **options)
    assert operations(moved) == [
        ("move", "id:renamed", "old.pdf", "h1", "new.pdf", "h1"),
        ("delete", "id:deleted", "Gone/A.pdf", "h2", None, None),
        ("delete", "id:two", "TWIN.pdf", "h1", None, None),
    ]
    pinned = plan_delta(changed, dead, state(*stored), rename_policy="ignore", **options)
    assert [o[1] for o in operations(pinned)] == ["id:deleted", "id:two"]
    ignored = plan_delta(changed, dead, state(*stored), scope=SCOPE)
    assert operations(ignored) == [] and transfers(ignored) == {"id:new": ("b.pdf", "r1")}


def test_delta_input_from_a_listing(rows):
    def entry(kind, path, ordinal, **more):
        return {"entry_type": kind, "path_display": path, "path_lower": path and path.lower(),
                "ordinal": ordinal, "rev": "r1", "content_hash": "h1", "size": 1, **more}

    listing = rows(
        LISTING_ROW,
        entry("file", "/Exports/A/a.pdf", 1, id="id:a", name="a.pdf"),
        entry("file", "/Exports/A/b.pdf", 2, id="id:a", name="b.pdf", rev="r2"),
        entry("file", "/Exports/big.pdf", 3, id="id:big", name="big.pdf", size=2**21),
        entry("file", "/Exports/x.txt", 4, id="id:x", name="x.txt"),
        entry("deleted", "/exports/Gone.pdf", 5), entry("deleted", None, 6),
        entry("folder", "/Exports/F", 7, id="id:f", name="F"),
    )
    changed, dead = split_delta(listing, "/Exports", max_mb=1, globs=["**/*.pdf"])
    latest = deduplicate_changes(changed).collect()
    assert [(r.file_id, r.path, r.rev) for r in latest] == [("id:a", "A/b.pdf", "r2")]
    assert [r.path for r in dead.collect()] == ["Gone.pdf"]
    everything = migration_inventory(listing, "/Exports", max_mb=1)
    assert {r.path: r.transferable for r in everything.collect()} == {
        "A/a.pdf": True, "A/b.pdf": True, "big.pdf": False, "x.txt": True}


def test_delta_only_with_a_cursor(rows, state):
    current, dead = rows(FILES, version("id:a", "a")), rows(PATHS)
    stored = version("id:gone", "gone")
    kwargs = {"scope": SCOPE, "changed": current, "tombstones": dead, "delete_policy": "delete"}
    assert operations(plan_migration(state(stored), **kwargs)) == []
    rescan = plan_migration(state(stored), scope=SCOPE, inventory=current, delete_policy="delete")
    assert [o[1] for o in operations(rescan)] == ["id:gone"]
    assert rescan.state.cursor == "cursor-1"  # kept until the rescan is committed
    with pytest.raises(ConfigurationError):
        plan_migration(state(stored, cursor=None), **kwargs)


def op(kind, file_id, old="a", new=None, **more):
    return {"operation": kind, "file_id": file_id, "old_path": old, "old_content_hash": "h1",
            "new_path": new, "new_content_hash": "h1" if new else None, **more}


def test_state_folding(rows, fails_with):
    stored = rows(TRANSFER_STATE, version("id:move", "a"), version("id:both", "b"),
                  version("id:gone", "c"), version("id:back", "d"), version("id:same", "e"))
    ops = rows(OPERATION, op("move", "id:move", "a", "a2"), op("move", "id:both", "b", "b2"),
               op("delete", "id:gone"), op("delete", "id:back"))
    sent = rows(FILES, version("id:both", "b2", "r2"), version("id:back", "d2", "r2"),
                version("id:new", "n"))
    after = {r.file_id: (r.path, r.rev) for r in next_state(stored, ops, sent).collect()}
    assert after == {"id:move": ("a2", "r1"), "id:both": ("b2", "r2"), "id:back": ("d2", "r2"),
                     "id:same": ("e", "r1"), "id:new": ("n", "r1")}
    delta = {r.file_id: (r.path, r.removed) for r in state_changes(stored, ops, sent).collect()}
    assert delta == {"id:move": ("a2", False), "id:both": ("b2", False), "id:gone": (None, True),
                     "id:back": ("d2", False), "id:new": ("n", False)}
    for kind in ("move", "delete"):
        with fails_with("does not match the state"):
            next_state(stored, rows(OPERATION, op(kind, "id:x", "a", "b")), rows(FILES)).collect()


def test_transfer_outcomes(spark, rows):
    plan = struct(file_id=STRING, path=STRING, rev=STRING, content_hash=STRING, size=LONG,
                  path_lower=STRING, path_display=STRING, client_modified=STRING,
                  server_modified=STRING)
    due = rows(plan, *[version(f"id:{k}", f"{k}.bin", size=3, client_modified="2026-01-01T00:00:00Z")
                       for k in ("ok", "rev", "size", "gone")])
    staged = spark.createDataFrame(
        [("id:ok", "r1", b"abc"), ("id:rev", "r2", b"abc"), ("id:size", "r1", b"abcd")],
        "file_id string, rev string, content binary")
    got = {r.file_id: r for r in transfer_records(due, staged).collect()}
    assert {k: r.outcome for k, r in got.items()} == {
        "id:ok": "transferred", "id:rev": "skipped_changed", "id:size": "skipped_byte_count",
        "id:gone": "skipped_unavailable"}
    assert got["id:ok"].sha256.startswith("ba7816bf") and got["id:rev"].sha256 is None
    assert got["id:ok"].last_modified == "2026-01-01T00:00:00Z"


NUMBERED = struct(idx=LONG, **{f.name: f.dataType for f in OPERATION.fields})
INDEX = struct(path=STRING, content_hash=STRING)


def outcomes(rows, target, *ops):
    numbered = [{"idx": i, **o} for i, o in enumerate(ops)]
    index = [{"path": f"/R/{p}", "content_hash": h} for p, h in target.items()]
    done = apply_operations(rows(NUMBERED, *numbered), rows(INDEX, *index), "/R").collect()
    return [r.outcome for r in sorted(done, key=lambda r: r.idx)]


@pytest.mark.parametrize(
    "target, operation, outcome",
    [
        ({"b": "h1"}, op("move", "i", "a", "b"), "already_moved"),
        ({"b": "h2"}, op("move", "i", "a", "b", new_content_hash="h2"), "already_moved"),
        ({"b": "x"}, op("move", "i", "a", "b"), "error_source_unavailable"),
        ({}, op("move", "i", "a", "b"), "error_source_unavailable"),
        ({"a": "x"}, op("move", "i", "a", "b"), "error_source_changed"),
        ({"a": None}, op("move", "i", "a", "b"), "error_source_changed"),
        ({"a": "x", "b": "h1"}, op("move", "i", "a", "b"), "error_source_changed"),
        ({"a": "h1", "b": "h1"}, op("move", "i", "a", "b"), "error_destination_exists"),
        ({"a": "h1"}, op("move", "i", "a", "b"), "moved"),
        ({}, op("delete", "i", "a"), "already_absent"),
        ({"a": "x"}, op("delete", "i", "a"), "error_target_changed"),
        ({"a": "h1"}, op("delete", "i", "a"), "deleted"),
    ],
)
def test_apply_outcomes(rows, target, operation, outcome):
    assert outcomes(rows, target, operation) == [outcome]


def in_sequence(target, ops):
    """Brute force: apply one operation after the other."""
    target, seen = dict(target), []
    for o in ops:
        old, new, have = o["old_path"], o["new_path"], o["old_content_hash"]
        if o["operation"] == "delete":
            result = ("already_absent" if old not in target else "error_target_changed"
                      if target[old] != have else "deleted")
        elif old not in target:
            arrived = new in target and target[new] in (have, o["new_content_hash"])
            result = "already_moved" if arrived else "error_source_unavailable"
        else:
            result = ("error_source_changed" if target[old] != have else
                      "error_destination_exists" if new in target else "moved")
        if result == "moved":
            target[new] = target.pop(old)
        if result == "deleted":
            del target[old]
        seen.append(result)
    return seen


@pytest.mark.parametrize("case", [
    [op("move", "1", "a", "b"), op("move", "2", "b", "c"), op("delete", "3", "c")],
    [op("move", "1", "a", "t"), op("move", "2", "b", "a"), op("move", "3", "t", "b")],
    [op("move", "1", "a", "z")] * 5 + [op("delete", "2", "z")] * 3 + [op("move", "1", "a", "z")],
    [op("delete", "1", "a"), op("delete", "1", "a", old_content_hash="x"), op("delete", "1", "a"),
     op("move", "9", "solo", "elsewhere")],
    [op("move", "1", "a", "b2"), op("move", "2", "b2", "x"), op("move", "3", "b", "x"),
     op("delete", "4", "x")],
    [op("move", str(i), n, "x") for i, n in enumerate(["q", "a", "b", "solo", "a", "r"])],
    [op("move", "1", "a", "a"), op("move", "2", "b", "c"), op("move", "3", "c", "c")],
    [op("move", "1", "a", "b"), op("delete", "2", "b"), op("move", "3", "a", "b"),
     op("delete", "4", "b"), op("move", "5", "solo", "a"), op("move", "6", "a", "b")],
])
def test_operations_sharing_paths_equal_sequential_application(rows, case):
    target = {"a": "h1", "b": "h1", "solo": "h1"}
    assert outcomes(rows, target, *case) == in_sequence(target, case)


def test_many_mixed_operations_equal_sequential_application(rows):
    names = itertools.cycle("abcde")
    ops = [op("delete", str(i), next(names)) if i % 4 == 3 else
           op("move", str(i), next(names), "abcde"[(i * 3) % 5] + "x"[: i % 2]) for i in range(14)]
    target = {"a": "h1", "c": "h1", "e": "h2"}
    assert outcomes(rows, target, *ops) == in_sequence(target, ops)


def test_many_operations_on_one_path_equal_sequential_application(rows):
    """A hot path, with more operations than there are ranges to cut its order into."""
    names = ["hot", "a", "b", "hot", "c", "hot", "d"]
    ops = [op("delete", str(i), names[i % 7]) if i % 3 == 0 else
           op("move", str(i), names[(i * 5) % 7], names[(i // 2) % 7],
              old_content_hash="h1" if i % 11 else "other") for i in range(600)]
    target = {"a": "h1", "c": "h1", "hot": "h1", "d": "h2"}
    assert outcomes(rows, target, *ops) == in_sequence(target, ops)


@pytest.mark.parametrize("present, first", [(True, "moved"), (False, "error_source_unavailable")])
def test_a_long_chain_takes_few_tables(rows, spark, monkeypatch, present, first):
    """Two hundred moves hand one file on; without it all of them fail, one after the other."""
    import filetally.plans.apply as module

    written = []
    kept = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, label: written.append(label) or kept(df, label))
    chain = [
        {"idx": k, "operation": "move", "file_id": "id:x", "old_path": f"p{k}",
         "old_content_hash": "h", "new_path": f"p{k + 1}", "new_content_hash": "h"}
        for k in range(200)
    ]
    index = [{"path": "/R/p0", "content_hash": "h"}] if present else []
    done = apply_operations(rows(NUMBERED, *chain), rows(INDEX, *index), "/R").collect()
    assert {r.outcome for r in done} == {first}
    assert len(done) == 200 and all(r.needed_ordering for r in done)
    # Two to begin with and three a pass; a surprise adds a doubling step per factor of two.
    assert len(written) <= (5 if present else 5 + 1 + 9 + 3)
