"""Scalar functions as ``Column`` builders, all of them built-in expressions.

Arguments are column names or SQL expressions. The modules hold the same functions as SQL
text, for ``selectExpr`` and ``where``; operators use that form, because a whole expression
then costs the driver one call, however large it is.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import functions as F

from filetally.functions import keys, paths, times
from filetally.functions.media import with_media_type
from filetally.functions.paths import validate_root


def _column(text):
    @wraps(text)
    def build(*args, **kwargs):
        return F.expr(text(*args, **kwargs))

    return build


fold = _column(paths.fold)
in_scope = _column(paths.in_scope)
is_safe_relative = _column(paths.is_safe_relative)
transfer_path = _column(paths.transfer_path)
target_path = _column(paths.target_path)
ancestors = _column(paths.ancestors)
extension = _column(paths.extension)
matches_globs = _column(paths.matches_globs)
has_offset = _column(times.has_offset)
to_instant = _column(times.to_instant)
to_utc = _column(times.to_utc)
last_modified = _column(times.last_modified)
entry_key = _column(keys.entry_key)
property_key = _column(keys.property_key)
acl_key = _column(keys.acl_key)
version_key = _column(keys.version_key)


def relative_path(path_lower: str, path_display: str, root: str) -> paths.RelativePath:
    """Normalized and display path below ``root`` as columns."""
    return paths.RelativePath(*map(F.expr, paths.relative_path(path_lower, path_display, root)))


__all__ = [
    "acl_key",
    "ancestors",
    "entry_key",
    "extension",
    "fold",
    "has_offset",
    "in_scope",
    "is_safe_relative",
    "last_modified",
    "matches_globs",
    "property_key",
    "relative_path",
    "target_path",
    "to_instant",
    "to_utc",
    "transfer_path",
    "validate_root",
    "version_key",
    "with_media_type",
]
