"""Path scope, relative paths, folding and globs, as SQL text.

Segment rules are written as regular expressions, as higher-order functions take a whole
projection out of whole-stage codegen. ``ancestors`` and ``fold`` use one: folding as nested
replacements made code that was too large to compile and ran interpreted.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

from filetally.errors import ConfigurationError
from filetally.guards import quote

# A '', '.' or '..' segment anywhere (which covers a leading, trailing or doubled '/'),
# or a backslash. ``\z`` and not ``$``: the latter also matches before a last newline.
UNSAFE_SEGMENT = r"(^|/)\.{0,2}(/|\z)|\\"


def validate_root(root: object) -> str:
    """Return ``root`` if it is '' or an absolute path without '', '.' or '..' segments."""
    if not isinstance(root, str):
        raise ConfigurationError("root must be a string.")
    if root == "":
        return ""
    if not root.startswith("/") or "\\" in root:
        raise ConfigurationError("root must be an absolute POSIX path.")
    if {"", ".", ".."} & set(root[1:].split("/")):
        raise ConfigurationError("root contains an invalid path segment.")
    return root


class _FoldRules(NamedTuple):
    single_from: str
    single_to: str
    suffixes: tuple[tuple[str, str], ...]
    expanding: str
    plain: str


def _ranges(codes: list[int], gap: int = 48) -> str:
    """A character class that covers ``codes``; near ones share a range, so it has few parts."""
    parts: list[list[int]] = []
    for code in sorted(codes):
        if parts and code - parts[-1][1] <= gap:
            parts[-1][1] = code
        else:
            parts.append([code, code])
    return "[" + "".join(f"\\x{{{low:x}}}-\\x{{{high:x}}}" for low, high in parts) + "]"


@lru_cache(maxsize=1)
def _fold_rules() -> _FoldRules:
    """Derive, from Unicode data, what full case folding adds to plain lower-casing.

    After ``lower`` a character folds to itself, to one other character (``translate``),
    or to several; the latter are grouped by the tail they gain, so that one regular
    expression per tail plus the same ``translate`` covers them. The two of Western
    European text, sharp s and micro sign, are replaced before any of that.
    """
    single: dict[str, str] = {}
    tails: dict[str, list[str]] = {}
    for code in range(0x80, 0x110000):
        char = chr(code)
        folded = char.casefold()
        if folded == char or char.lower() != char or char in "ßµ":
            continue
        single[char] = folded[0]
        if len(folded) > 1:
            tails.setdefault(folded[1:], []).append(char)
    groups = tuple((tail, "".join(chars)) for tail, chars in tails.items())
    expanding = _ranges([ord(c) for _, chars in groups for c in chars])
    plain = f"[^\\x{{0}}-\\x{{{min(map(ord, single)) - 1:x}}}]"
    return _FoldRules("".join(single), "".join(single.values()), groups, expanding, plain)


def fold(col: str) -> str:
    """Full Unicode case folding.

    ASCII values, told by their length, only pay for ``lower``; Western European ones for a
    search for one range of characters besides, before they are lowered. The rest goes through
    one replacement per tail.
    """
    rules = _fold_rules()
    lowered = f"replace(replace(lower({col}), 'ß', 'ss'), 'µ', 'μ')"
    tails = ", ".join(
        f"struct({quote(f'([{chars}])')} AS chars, {quote(f'$1{tail}')} AS gain)"
        for tail, chars in rules.suffixes
    )
    expanded = (
        f"reduce(array({tails}), {lowered}, (text, t) -> regexp_replace(text, t.chars, t.gain))"
    )
    return (
        f"CASE WHEN octet_length({col}) = char_length({col}) THEN lower({col}) "
        f"WHEN NOT {col} RLIKE {quote(rules.plain)} THEN {lowered} "
        f"ELSE translate(CASE WHEN {lowered} RLIKE {quote(rules.expanding)} "
        f"THEN {expanded} ELSE {lowered} END, {quote(rules.single_from)}, "
        f"{quote(rules.single_to)}) END"
    )


def in_scope(path: str, root: str | None) -> str:
    """Is ``path`` the root or below it, by whole components and ignoring case.

    A null or empty path is never in scope, not even for an empty root.
    """
    present = f"coalesce({path} <> '', false)"
    if not isinstance(root, str) or root == "":
        return present
    base = quote(root.rstrip("/").casefold() + "/")
    # The closing '/' makes the root itself and everything below it one prefix test.
    return f"({present} AND startswith(concat({fold(path)}, '/'), {base}))"


def is_safe_relative(path: str) -> str:
    """Relative, and free of backslashes and of '', '.' and '..' segments; null is not safe."""
    return f"coalesce(NOT ({path} RLIKE {quote(UNSAFE_SEGMENT)}), false)"


class RelativePath(NamedTuple):
    normalized: object
    display: object


def relative_path(path_lower: str, path_display: str, root: str) -> RelativePath:
    """Both paths below ``root``: lower-cased key and case-keeping display.

    Both are null where either input is missing, lies outside the root or has an unsafe
    remainder. The display falls back to the key if the display path is under another root.
    """
    root = validate_root(root)
    prefix = f"{root.lower()}/"
    rest = f"lower(substring({path_lower}, {len(prefix) + 1}))"
    normalized = (
        f"CASE WHEN {path_display} <> '' AND startswith({path_lower}, {quote(prefix)}) "
        f"AND {is_safe_relative(rest)} THEN {rest} END"
    )
    if root:
        depth = root.count("/")
        segments = f"split({path_display}, '/')"
        head = f"array_join(slice({segments}, 2, {depth}), '/')"
        tail = f"array_join(slice({segments}, {depth + 2}, 2147483647), '/')"
        display = (
            f"CASE WHEN size({segments}) > {depth + 1} AND {tail} <> '' "
            f"AND {fold(head)} = {quote(root[1:].casefold())} THEN {tail} ELSE {rest} END"
        )
    else:
        display = (
            f"CASE WHEN startswith({path_display}, '/') THEN substring({path_display}, 2) "
            f"ELSE {rest} END"
        )
    return RelativePath(normalized, f"CASE WHEN ({normalized}) IS NOT NULL THEN {display} END")


def transfer_path(path_display: str, name: str, root: str) -> str:
    """Display path (or the name without one) relative to ``root``, case kept.

    A path outside the root only loses its leading slashes.
    """
    path = f"coalesce(nullif({path_display}, ''), {name})"
    root = root.rstrip("/")
    outside = f"trim(LEADING '/' FROM {path})"
    if not root:
        return outside
    return (
        f"CASE WHEN startswith({fold(path)}, {quote(root.casefold() + '/')}) "
        f"THEN substring({path}, {len(root) + 2}) ELSE {outside} END"
    )


def target_path(root: str, relative: str) -> str:
    """Absolute path of ``relative`` below ``root``."""
    return f"concat({quote(validate_root(root) + '/')}, {relative})"


def ancestors(path: str, root: str) -> str:
    """Folders of an absolute ``path`` strictly below ``root``, outermost first."""
    first = validate_root(root).count("/") + 2
    segments = f"split({path}, '/')"
    last = f"(size({segments}) - 1)"
    return (
        f"CASE WHEN {last} >= {first} THEN transform(sequence({first}, {last}), "
        f"upto -> array_join(slice({segments}, 1, upto), '/')) "
        "ELSE CAST(array() AS ARRAY<STRING>) END"
    )


def parent(path: str) -> str:
    """The folder an absolute path lies in ('' for the top level)."""
    return f"regexp_replace({path}, {quote(r'/[^/]*\z')}, '')"


def extension(name: str) -> str:
    """Lower-cased last suffix with its dot; '' for none (``.bashrc``, ``a.``, ``a``)."""
    return f"lower(regexp_extract({name}, {quote(r'(?s)^.+(\.[^./]+)\z')}, 1))"


def glob_pattern(globs: list[str]) -> str:
    """One anchored expression for all globs.

    ``*`` and ``?`` stay within a segment, ``**`` crosses segments (``**/`` also matches no
    segment at all), ``[..]`` and ``[!..]`` are character sets.
    """
    return r"(?s)\A(?:" + "|".join(_glob_expression(glob) for glob in globs) + r")\z"


def _glob_expression(glob: str) -> str:
    token = re.compile(r"\*\*/|\*\*|\*|\?|\[[!^]?\]?[^\]]*\]|.", re.DOTALL)
    fixed = {"**/": "(?:.*/)?", "**": ".*", "*": "[^/]*", "?": "[^/]"}
    parts = []
    for match in token.finditer(glob):
        text = match.group()
        if text in fixed:
            parts.append(fixed[text])
        elif text.startswith("[") and len(text) > 1:
            negated = text[1] in "!^"
            body = re.sub(r"([\\\[\]&^])", r"\\\1", text[1 + negated : -1])
            parts.append(f"[{'^/' if negated else ''}{body}]")
        else:
            parts.append(re.escape(text))
    return "".join(parts)


def matches_globs(path: str, globs: list[str]) -> str:
    """Does ``path`` match any of ``globs``; an empty list keeps every path."""
    if not globs:
        return "true"
    return f"coalesce({path} RLIKE {quote(glob_pattern(globs))}, false)"
