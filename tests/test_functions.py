import pytest

from filetally import functions as fn
from filetally.errors import ConfigurationError
from filetally.functions.paths import glob_pattern


def test_fold_equals_full_case_folding_for_every_character(spark):
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(map(chr, points[i : i + 64])) for i in range(0, len(points), 64)]
    df = spark.createDataFrame([(t, t.casefold()) for t in texts], "v string, expected string")
    wrong = df.select("v", "expected", fn.fold("v").alias("got")).where("got <> expected").collect()
    # Only characters of newer Unicode versions, known to one side, may differ.
    differing = {
        a for r in wrong for a, b, c in zip(r.v, r.expected, r.got, strict=False) if b != c
    }
    assert len(differing) < 64 and len(wrong) < 20


@pytest.mark.parametrize("text", ["STRASSE", "straße", "ΌΣΟΣ", "ﬀ ﬃ ﬖ", "İstanbul", "ᾳ Ꮿ ꭰ", "a/B"])
def test_fold_samples(column, text):
    assert column([text, text.upper(), None], fn.fold) == [
        text.casefold(), text.upper().casefold(), None,
    ]


@pytest.mark.parametrize(
    "path, root, expected",
    [
        ("/reports/a.txt", "/Reports", True),
        ("/reports", "/Reports/", True),
        ("/reports-old/a.txt", "/Reports", False),
        ("/other/a.txt", "/Reports", False),
        ("/any", "", True),
        (None, "", False),
        ("", "", False),
        (None, "/Reports", False),
        ("/reports%/x", "/reports_", False),
        ("/strasse/x", "/Straße", True),
    ],
)
def test_in_scope(column, path, root, expected):
    assert column([path], lambda c: fn.in_scope(c, root)) == [expected]


@pytest.mark.parametrize("root", ["relative", "/a//b", "/a/", "/a/../b", "/./a", "/a\\b", "/", None])
def test_invalid_roots(root):
    with pytest.raises(ConfigurationError):
        fn.validate_root(root)


def test_valid_roots():
    assert [fn.validate_root(r) for r in ("", "/a", "/A/b c")] == ["", "/a", "/A/b c"]


@pytest.mark.parametrize(
    "lower, display, root, expected",
    [
        ("/source-root/report.pdf", "/Source-Root/Report.pdf", "/SOURCE-ROOT",
         ("report.pdf", "Report.pdf")),
        ("/root/a/b.txt", "/Root/A/B.txt", "/root", ("a/b.txt", "A/B.txt")),
        ("/root/a/b.txt", "/Else/A/B.txt", "/root", ("a/b.txt", "a/b.txt")),
        ("/root", "/Root", "/root", (None, None)),
        ("/rootless/a", "/Rootless/a", "/root", (None, None)),
        ("/other/a", "/other/a", "/root", (None, None)),
        ("/root/../a", "/root/../a", "/root", (None, None)),
        ("/root//a", "/root//a", "/root", (None, None)),
        (None, "/Root/a", "/root", (None, None)),
        ("/root/a", "", "/root", (None, None)),
        ("/a/b", "/A/B", "", ("a/b", "A/B")),
        ("a/b", "A/B", "", (None, None)),
    ],
)
def test_relative_path(spark, lower, display, root, expected):
    df = spark.createDataFrame([(lower, display)], "l string, d string")
    path = fn.relative_path("l", "d", root)
    assert tuple(df.select(path.normalized, path.display).first()) == expected


@pytest.mark.parametrize(
    "path, safe",
    [("a", True), ("a/b.txt", True), ("...", True), ("a/..b", True), ("", False), ("/a", False),
     ("a/", False), ("a//b", False), ("a/./b", False), ("..", False), ("a/..", False),
     ("a\\b", False), (None, False), ("a\n", True), ("..\n", True)],
)
def test_is_safe_relative(column, path, safe):
    assert column([path], fn.is_safe_relative) == [safe]


@pytest.mark.parametrize(
    "display, name, root, expected",
    [
        ("/Exports/A/b.txt", "b.txt", "/exports", "A/b.txt"),
        ("/Exports/A/b.txt", "b.txt", "/Exports/", "A/b.txt"),
        ("//Other/b.txt", "b.txt", "/Exports", "Other/b.txt"),
        (None, "b.txt", "/Exports", "b.txt"),
        ("/A/b.txt", "b.txt", "", "A/b.txt"),
    ],
)
def test_transfer_path(spark, display, name, root, expected):
    df = spark.createDataFrame([(display, name)], "d string, n string")
    assert df.select(fn.transfer_path("d", "n", root)).first()[0] == expected


def test_target_and_ancestors(column):
    assert column(["a/b"], lambda c: fn.target_path("/R", c)) == ["/R/a/b"]
    assert column(["a/b"], lambda c: fn.target_path("", c)) == ["/a/b"]
    assert column(["/R/a/b/c.txt", "/R/c.txt"], lambda c: fn.ancestors(c, "/R")) == [
        ["/R/a", "/R/a/b"], [],
    ]
    assert column(["/a/b/c.txt", "/c.txt"], lambda c: fn.ancestors(c, "")) == [["/a", "/a/b"], []]


def test_extension(column):
    names = ["x.tar.GZ", ".bashrc", "a.", "a", "Report.PDF", "a.b/c"]
    assert column(names, fn.extension) == [".gz", "", "", "", ".pdf", ""]


@pytest.mark.parametrize(
    "glob, path, hit",
    [
        ("*.pdf", "a.pdf", True), ("*.pdf", "x/a.pdf", False), ("**/*.pdf", "a.pdf", True),
        ("**/*.pdf", "x/y/a.pdf", True), ("x/**", "x/y/z", True), ("x/**", "y/x", False),
        ("a?.txt", "ab.txt", True), ("a?.txt", "a/.txt", False), ("[ab].txt", "b.txt", True),
        ("[!ab].txt", "b.txt", False), ("[!ab].txt", "c.txt", True), ("a.b", "axb", False),
        ("a+(b)", "a+(b)", True), ("**", "x/y", True),
    ],
)
def test_globs(column, glob, path, hit):
    assert column([path], lambda c: fn.matches_globs(c, [glob])) == [hit]


def test_no_globs_keep_everything(column):
    assert column(["a", "b/c"], lambda c: fn.matches_globs(c, [])) == [True, True]
    assert glob_pattern(["a", "b"]) == r"(?s)\A(?:a|b)\z"


TIMES = [
    "2026-08-18T14:00:00+02:00", "2026-08-18T12:00:00Z", "2026-08-18T12:00:00.250000Z",
    "2026-08-18T12:00:00", "2026-02-30T12:00:00Z", "yesterday", None, "2026-08-18",
]


def test_three_policies_for_times(column):
    assert column(TIMES, lambda c: fn.to_utc(c, "keep")) == TIMES
    aware = ["2026-08-18T12:00:00Z", "2026-08-18T12:00:00Z", "2026-08-18T12:00:00.250000Z"]
    assert column(TIMES, lambda c: fn.to_utc(c, "null")) == [*aware, None, None, None, None, None]
    assert column(TIMES, lambda c: fn.to_utc(c, "assume_utc")) == [
        *aware, "2026-08-18T12:00:00Z", None, None, None, "2026-08-18T00:00:00Z",
    ]
    with pytest.raises(ConfigurationError):
        fn.to_utc("v", "guess")


def test_last_modified(spark):
    df = spark.createDataFrame(
        [("2026-01-02T00:00:00Z", "2026-01-01T00:00:00Z"),
         ("2026-01-02T00:00:00", "2026-01-01T01:00:00+01:00"), (None, None)],
        "s string, c string",
    )
    got = [str(r[0]) for r in df.select(fn.last_modified("s", "c").cast("string")).collect()]
    assert got == ["2026-01-02 00:00:00", "2026-01-01 00:00:00", "1970-01-01 00:00:00"]


def test_keys_keep_nulls_visible(spark):
    df = spark.createDataFrame([("id", None)], "a string, b string")
    row = df.select(
        fn.entry_key("'file'", "a"), fn.property_key("a", "b", "a"), fn.acl_key("a", "a", "a"),
        fn.version_key("a", "a", "a"),
    ).first()
    assert tuple(row) == ("file:id", None, "id|id|id", "id:id:id")


def test_media_types(spark):
    names = ["a.PDF", "x.tar.gz", "x.tgz", "x.gz", ".bashrc", "noext", "a.unknownext", "b.html"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.media_type for r in fn.with_media_type(df).collect()}
    assert got["a.PDF"] == "application/pdf" and got["b.html"] == "text/html"
    assert got["x.tar.gz"] == got["x.tgz"] == "application/x-tar"
    assert all(got[n] is None for n in ("x.gz", ".bashrc", "noext", "a.unknownext"))


def test_literals_are_quoted(column):
    assert column(["/it's/a"], lambda c: fn.in_scope(c, "/It's")) == [True]


def test_what_is_told_plain_before_lowering_folds_by_lowering():
    """Below the first character with a folding of its own, lowering and two replacements do."""
    from filetally.functions.paths import _fold_rules

    first = min(map(ord, _fold_rules().single_from))
    assert first > 0x140
    for code in range(first):
        lowered = chr(code).lower().replace("ß", "ss").replace("µ", "μ")
        assert lowered == chr(code).casefold()
