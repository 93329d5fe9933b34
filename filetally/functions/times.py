"""Instants from landed date-time strings, as SQL text.

The raw string is kept in every relation, because offset presence and the difference
between an absent and a malformed value both carry meaning.
"""

from __future__ import annotations

from filetally.errors import ConfigurationError
from filetally.guards import quote

_CLOCK = r"\d{2}:\d{2}(:\d{2}([.,]\d+)?)?"
_OFFSET = r"(Z|[+-]\d{2}:\d{2})"
# The place after the minutes of a time without seconds.
_NO_SECONDS = r"(?<=[T ]\d{2}:\d{2})(?=Z|[+-]|\z)"
WITH_OFFSET = rf"\A\d{{4}}-\d{{2}}-\d{{2}}[T ]{_CLOCK}{_OFFSET}\z"
ANY_OFFSET = rf"\A\d{{4}}-\d{{2}}-\d{{2}}([T ]{_CLOCK}{_OFFSET}?)?\z"
# Records for writing demand the 'T' separator.
RFC3339 = rf"\A\d{{4}}-\d{{2}}-\d{{2}}T{_CLOCK}{_OFFSET}\z"


def has_offset(col: str) -> str:
    return f"coalesce({col} RLIKE {quote(WITH_OFFSET)}, false)"


def to_instant(col: str, naive: str) -> str:
    """Timestamp of a raw string; null for a malformed one.

    ``naive`` says what a value without offset is: ``null`` or ``assume_utc``. The latter
    relies on the session zone, which is UTC. The parser wants seconds, so a time of minute
    precision gets them.
    """
    accepted = {"null": WITH_OFFSET, "assume_utc": ANY_OFFSET}
    if naive not in accepted:
        raise ConfigurationError("naive must be keep, null or assume_utc.")
    full = f"regexp_replace(translate({col}, ',', '.'), {quote(_NO_SECONDS)}, ':00')"
    return f"CASE WHEN {col} RLIKE {quote(accepted[naive])} THEN try_to_timestamp({full}) END"


def format_utc(instant: str) -> str:
    """ISO string with ``Z``; the fraction is shown only when it is not zero."""
    rendered = f"date_format({instant}, 'yyyy-MM-dd\\'T\\'HH:mm:ss.SSSSSS')"
    return f"concat(regexp_replace({rendered}, '[.]000000', ''), 'Z')"


def to_utc(col: str, naive: str = "null") -> str:
    """UTC string of a raw string under one of three policies for values without offset.

    ``keep`` leaves every value as it was landed, ``null`` drops values without offset,
    ``assume_utc`` reads them as UTC.
    """
    if naive == "keep":
        return col
    return format_utc(to_instant(col, naive))


def last_modified(server: str, client: str) -> str:
    """First of the two with an offset, else the epoch."""
    return (
        f"coalesce({to_instant(server, 'null')}, {to_instant(client, 'null')}, "
        "timestamp_seconds(0))"
    )
