import pytest

from filetally.errors import ConfigurationError
from filetally.operators import warehouse
from filetally.operators.contract import check_contract, check_state
from filetally.operators.keyed import (
    assert_unique,
    dedupe_replay,
    dedupe_strict,
    duplicate_keys,
    pair_by_key,
)
from filetally.operators.relations import (
    entries,
    file_properties,
    files,
    folders,
    scope_rejects,
    shared_folders,
    shared_links,
    sharing_acl,
)
from filetally.schemas import (
    LINK,
    LISTING_ROW,
    MEMBER_ROW,
    MEMBERS,
    SHARED_FOLDER,
    TEMPLATE,
    TRANSFER_STATE,
)
from filetally.sources.sharing import flatten_members

FILE = {
    "entry_type": "file", "id": "id:file1", "name": "example.txt", "rev": "0123", "size": 12,
    "path_lower": "/docs/example.txt", "path_display": "/Docs/Example.txt",
    "client_modified": "2026-08-01T00:00:00Z", "server_modified": "2026-08-02T00:00:00Z",
    "content_hash": "a" * 64, "is_downloadable": True,
}
FOLDER = {
    "entry_type": "folder", "id": "id:folder", "name": "Docs", "path_lower": "/docs",
    "path_display": "/Docs", "shared_folder_id": "sf:1",
}
DELETED = {
    "entry_type": "deleted", "name": "gone.txt", "path_lower": "/docs/gone.txt",
    "path_display": "/Docs/Gone.txt",
}


def holds(df, stream):
    return all(r.violations == 0 for r in check_contract(df, stream).collect())


def test_entries_shape_each_kind(rows):
    log = entries(rows(LISTING_ROW, FILE, FOLDER, DELETED))
    got = {r.entry_key: r.asDict() for r in log.collect()}
    assert set(got) == {"file:id:file1", "folder:id:folder", "deleted:/docs/gone.txt"}
    file, folder, gone = (got[k] for k in ("file:id:file1", "folder:id:folder",
                                           "deleted:/docs/gone.txt"))
    assert (file["operation"], file["id"], file["size"], file["shared_folder_id"]) == (
        "upsert", "id:file1", 12, None)
    assert (folder["operation"], folder["rev"], folder["shared_folder_id"]) == (
        "upsert", None, "sf:1")
    assert (gone["operation"], gone["id"], gone["path_display"]) == (
        "delete", None, "/Docs/Gone.txt")
    assert holds(log, "entries")


def test_entries_reject_an_unknown_kind(rows, fails_with):
    with fails_with("Unsupported metadata type"):
        entries(rows(LISTING_ROW, {**FILE, "entry_type": "symlink"})).collect()


def test_files_and_folders_snapshots(rows):
    sharing = {"read_only": True, "parent_shared_folder_id": "sf:p", "modified_by": "dbid:1"}
    lock = {"is_lockholder": True, "lockholder_name": "N", "created": "2026-08-01T00:00:00Z"}
    shared = {"read_only": False, "shared_folder_id": "sf:1", "traverse_only": True}
    listing = rows(
        LISTING_ROW,
        {**FILE, "sharing_info": sharing, "file_lock_info": lock},
        {**FILE, "id": "id:plain"},
        {**FOLDER, "sharing_info": shared},
        DELETED,
    )
    got = {r.id: r for r in files(listing).collect()}
    assert set(got) == {"id:file1", "id:plain"}
    assert got["id:file1"].sharing_info.asDict() == sharing
    assert got["id:file1"].file_lock_info.lockholder_name == "N"
    assert got["id:plain"].sharing_info is None and got["id:plain"].file_lock_info is None
    assert holds(files(listing), "files")
    only = folders(listing).collect()
    assert [r.id for r in only] == ["id:folder"]
    assert only[0].sharing_info.traverse_only is True
    assert holds(folders(listing), "folders")


def group(template, *fields):
    return {"template_id": template, "fields": [{"name": n, "value": v} for n, v in fields]}


def with_groups(*groups, **changes):
    return {**FILE, "property_groups": list(groups), **changes}


def test_file_properties_rows_and_names(rows):
    listing = rows(
        LISTING_ROW,
        with_groups(group("ptid:contract", ("Customer", "ACME"), ("Status", None)),
                    group("ptid:unknown", ("X", "1"))),
        {**FILE, "id": "id:none", "property_groups": None},
        {**FOLDER, "property_groups": [group("ptid:contract", ("Customer", "no"))]},
    )
    names = rows(TEMPLATE, {"template_id": "ptid:contract", "name": "Contract"})
    got = file_properties(listing, names)
    by_key = {r.property_key: r for r in got.collect()}
    assert set(by_key) == {
        "id:file1|ptid:contract|Customer", "id:file1|ptid:contract|Status",
        "id:file1|ptid:unknown|X",
    }
    row = by_key["id:file1|ptid:contract|Customer"]
    assert (row.template_name, row.field_value, row.field_id) == ("Contract", "ACME", None)
    assert by_key["id:file1|ptid:unknown|X"].template_name is None
    assert holds(got, "file_properties")
    values = warehouse.documents_per_value(got, "Customer").collect()
    assert [(r.field_value, r.documents) for r in values] == [("ACME", 1)]
    assert warehouse.template_properties(got, "Contract").count() == 2


def test_file_properties_drop_identical_and_refuse_conflicting(rows, fails_with):
    names = rows(TEMPLATE)
    same = with_groups(group("t", ("a", "1")))
    assert file_properties(rows(LISTING_ROW, same, same), names).count() == 1
    other = with_groups(group("t", ("a", None)))
    with fails_with("Conflicting duplicate file properties for id:file1|t|a"):
        file_properties(rows(LISTING_ROW, same, other), names).collect()


@pytest.mark.parametrize(
    "record, message",
    [
        (with_groups(group("", ("a", "1"))), "no template ID"),
        (with_groups(group(None, ("a", "1"))), "no template ID"),
        (with_groups(group("t", ("", "1"))), "no field name"),
        (with_groups(group("t", ("a", "1")), id=None), "no file ID"),
    ],
)
def test_file_properties_need_identity(rows, fails_with, record, message):
    with fails_with(message):
        file_properties(rows(LISTING_ROW, record), rows(TEMPLATE)).count()


def test_a_file_without_id_and_without_properties_is_no_error(rows):
    listing = rows(LISTING_ROW, {**FILE, "id": None, "property_groups": []})
    assert file_properties(listing, rows(TEMPLATE)).count() == 0


LINK_ROW = {
    "kind": "file", "url": "https://host/a", "id": "id:document", "name": "document.txt",
    "path_lower": "/reports/document.txt", "expires": "2026-09-01T02:00:00+02:00",
    "link_permissions": {"resolved_visibility": "public", "requested_visibility": "team_only",
                         "allow_download": True, "effective_audience": "public",
                         "link_access_level": "viewer"},
    "client_modified": "2026-08-01T00:00:00Z", "server_modified": "2026-08-02T00:00:00",
    "rev": "0123", "size": 10,
    "team_member_info": {"display_name": "N", "member_id": "m", "team_info": {"id": "t"}},
}


def test_shared_links_nest_target_and_settings(rows):
    links = shared_links(
        rows(
            LINK, LINK_ROW,
            {"kind": "folder", "url": "https://host/f", "name": "F", "path_lower": "/reports/f"},
            {"kind": "paper", "url": "https://host/o", "name": "O", "path_lower": "/reports"},
            {"kind": "file", "url": "https://host/x", "name": "X", "path_lower": "/reports-old/x"},
            {"kind": "file", "url": "https://host/n", "name": "N"},
        ),
        "/Reports",
    )
    got = {r.link_key: r for r in links.collect()}
    assert set(got) == {"https://host/a", "https://host/f", "https://host/o"}
    row = got["https://host/a"]
    assert row.target.asDict() == {"id": "id:document", "type": "file",
                                   "path_lower": "/reports/document.txt", "path_display": None}
    assert row.settings.asDict() == {"requested_visibility": "team_only",
                                     "effective_visibility": "public",
                                     "link_access_level": "viewer", "allow_download": True}
    assert (row.expires, row.client_modified, row.server_modified) == (
        "2026-09-01T00:00:00Z", "2026-08-01T00:00:00Z", None)
    assert row.team_member_info.team_info.id == "t"
    assert [got[f"https://host/{k}"].link_type for k in "afo"] == ["file", "folder", "other"]
    assert got["https://host/f"].settings.allow_download is None
    assert holds(links, "shared_links")
    assert [r.url for r in warehouse.expiring_links(links).collect()] == ["https://host/a"]
    public = warehouse.public_downloadable_links(links).collect()
    assert [(r.url, r.target_type) for r in public] == [("https://host/a", "file")]


def test_links_without_path_are_dropped_even_with_an_empty_root(rows):
    landed = rows(LINK, LINK_ROW, {"kind": "file", "url": "https://host/n", "name": "N"})
    assert [r.url for r in shared_links(landed, "").collect()] == ["https://host/a"]
    rejects = scope_rejects(landed, "path_lower", "/Elsewhere").collect()
    assert sorted(r.reject_reason for r in rejects) == ["missing_path", "outside_root"]


SHARED = {"shared_folder_id": "sf:1", "name": "Team", "path_lower": "/team", "path_display": "/Team",
          "policy": {"member_policy": "anyone"}, "owner_team": {"id": "t", "name": "T"}}


def test_shared_folders_are_not_scoped(rows):
    got = shared_folders(rows(SHARED_FOLDER, SHARED, {"shared_folder_id": "sf:2", "name": "No path"}))
    assert got.count() == 2 and holds(got, "shared_folders")


def member(principal="user", **fields):
    return {"shared_folder_id": "sf:1", "principal_type": principal, **fields}


def test_sharing_acl_identities(rows):
    members = rows(
        MEMBER_ROW,
        member(principal_id="dbid:1", email="a@x", same_team=True, access_level="owner"),
        member(principal_id="", email="b@x", same_team=False, is_inherited=True),
        member("group", principal_id="g:1", email="hidden@x", display_name="G"),
        member("invitee", email="c@x"),
        member("other", kind="ServiceMember", principal_id="x", email="y", same_team=True),
        member(principal_id="dbid:9", shared_folder_id="sf:out"),
    )
    outside = {**SHARED, "shared_folder_id": "sf:out", "path_lower": "/team-old"}
    acl = sharing_acl(rows(SHARED_FOLDER, SHARED, outside), members, "/TEAM")
    got = {r.acl_key: r for r in acl.collect()}
    assert set(got) == {"sf:1|user|dbid:1", "sf:1|user|b@x", "sf:1|group|g:1",
                        "sf:1|invitee|c@x", "sf:1|other|ServiceMember"}
    assert got["sf:1|user|dbid:1"].is_external is False
    assert got["sf:1|user|b@x"].is_external is True
    assert got["sf:1|group|g:1"].principal_email is None
    assert got["sf:1|invitee|c@x"].is_external is None
    other = got["sf:1|other|ServiceMember"]
    assert (other.principal_id, other.principal_email, other.is_external) == (None, None, None)
    assert holds(acl, "sharing_acl")
    assert {r.principal_email for r in warehouse.user_access(acl).collect()} == {"a@x", "b@x"}


def test_sharing_acl_failures(rows, fails_with):
    folders_ = rows(SHARED_FOLDER, SHARED)
    with fails_with("user has no stable identity"):
        sharing_acl(folders_, rows(MEMBER_ROW, member()), "").collect()
    with fails_with("group has no stable identity"):
        sharing_acl(folders_, rows(MEMBER_ROW, member("group", email="g@x")), "").collect()
    with fails_with("no stable ID"):
        sharing_acl(rows(SHARED_FOLDER, {**SHARED, "shared_folder_id": ""}),
                    rows(MEMBER_ROW, member(principal_id="a")), "").collect()
    one = member(principal_id="dbid:1", access_level="owner")
    assert sharing_acl(folders_, rows(MEMBER_ROW, one, one), "").count() == 1
    with fails_with("Conflicting duplicate sharing records for resource sf:1"):
        sharing_acl(folders_, rows(MEMBER_ROW, one, {**one, "access_level": None}), "").collect()


def test_members_out_of_scope_are_not_tested(rows):
    bad = [member(shared_folder_id="sf:out"), member(shared_folder_id="", principal_id="a")]
    outside = {**SHARED, "shared_folder_id": "sf:out", "path_lower": None}
    folders_ = rows(SHARED_FOLDER, SHARED, outside)
    assert sharing_acl(folders_, rows(MEMBER_ROW, *bad), "/Team").count() == 0


def test_member_pages_flatten(rows):
    page = {
        "shared_folder_id": "sf:1",
        "users": [{"access_type": "owner", "is_inherited": False,
                   "user": {"account_id": "dbid:1", "email": "a@x", "same_team": True}}],
        "groups": [{"access_type": "viewer", "group": {"group_id": "g:1", "group_name": "G"}}],
        "invitees": [{"access_type": "editor", "invitee": {"tag": "email", "email": "c@x"}},
                     {"access_type": "editor", "invitee": {"tag": "other", "email": "d@x"},
                      "user": {"account_id": "dbid:2"}}],
        "others": [{"access_type": "viewer", "kind": "ServiceMember"}],
    }
    got = flatten_members(rows(MEMBERS, page, {"shared_folder_id": "sf:2"})).collect()
    assert [(r.principal_type, r.principal_id, r.email) for r in got] == [
        ("user", "dbid:1", "a@x"), ("group", "g:1", None), ("invitee", None, "c@x"),
        ("invitee", "dbid:2", None), ("other", None, None),
    ]
    assert got[0].access_level == "owner" and got[4].kind == "ServiceMember"


def test_dedup_forms(spark, fails_with):
    df = spark.createDataFrame(
        [("a", 1, None, 1), ("a", 1, None, 1), ("b", 2, "x", 1)], "k string, n int, s string, o int"
    )
    assert dedupe_strict(df, ["k"]).count() == 2
    clash = df.union(spark.createDataFrame([("b", 2, None, 1)], df.schema))
    with fails_with("conflicting duplicate records"):
        dedupe_strict(clash, ["k"]).collect()
    with fails_with("twice"):
        assert_unique(df, ["k"], "'twice'").count()
    assert [tuple(r) for r in duplicate_keys(df, ["k"]).collect()] == [("a", 2)]
    log = spark.createDataFrame([("a", 1, 1), ("a", 2, 0), ("a", 2, 1)], "k string, p int, o int")
    assert [tuple(r) for r in dedupe_replay(log, ["k"], ["p", "o"]).collect()] == [("a", 2, 1)]


def test_pairing(spark):
    left = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    right = spark.createDataFrame([("b", "x"), ("c", "y"), ("c", "y")], "k string, w string")
    got = {r.k: r for r in pair_by_key(left, right, ["k"]).collect()}
    assert got["a"].right is None and got["a"].left.v == 1
    assert got["b"].left is not None and got["b"].left.v is None and got["b"].right.w == "x"
    assert got["c"].left is None and got["c"].right_rows == 2


def test_contract_reports_structure_and_values(rows, spark):
    state = rows(TRANSFER_STATE, {"file_id": "a", "path": "../x", "rev": "", "content_hash": "h"},
                 {"file_id": "a", "path": "x", "rev": "r", "content_hash": None})
    found = {(r.rule, r.column): r.violations for r in check_state(state).collect()}
    assert found[("safe_path", "path")] == 1 and found[("unique", "file_id")] == 1
    assert found[("non_empty", "rev")] == 1 and found[("non_empty", "content_hash")] == 1
    odd = spark.createDataFrame([("x", 1)], "shared_folder_id string, extra int")
    kinds = {(r.rule, r.column) for r in check_contract(odd, "shared_folders").collect()
             if r.violations}
    assert ("missing_column", "name") in kinds and ("extra_column", "extra") in kinds
    wrong = spark.createDataFrame([("k", 5)], "acl_key string, resource_id int")
    kinds = {(r.rule, r.column) for r in check_contract(wrong, "sharing_acl").collect()
             if r.violations}
    assert ("wrong_type", "resource_id") in kinds
    with pytest.raises(ConfigurationError):
        check_contract(odd, "nothing")
