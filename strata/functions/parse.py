"""Tolerant parsers for text fields: timestamps, dates, delimited lines, URLs.

Patterns accept padded and unpadded parts (``yyyy-M-d`` reads ``2026-03-01``
and ``2026-3-1``), like Python's ``strptime`` that the source jobs used.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

#: what ``str.strip`` takes for white space
_WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

TS_PATTERN = "yyyy-M-d H:m:s"
DATE_PATTERN = "yyyy-M-d"


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ``yyyy-M-d H:m:s`` and ``yyyy-M-d`` as anchored patterns: 1-2 digit parts, nothing around them, no year 0000
_TS_RE = r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"
_DATE_RE = r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
_MONTH_RE = r"^(?!0000)[0-9]{4}-[0-9]{1,2}$"
_YEAR_RE = r"^(?!0000)[0-9]{4}$"
_ANY_DATE_RE = r"^(?!0000)[0-9]{4}(-[0-9]{1,2}(-[0-9]{1,2})?)?$"


def _matched(c: Column, regex: str, kind: str) -> Column:
    """One match and one cast: NULL where the text has another form or is no date (second 60, day 31 of April).

    Casts to ``date`` and ``timestamp_ntz`` read unpadded parts and know no time zone; missing months and days are 1.
    """
    return F.when(c.rlike(regex), c.try_cast(kind))


def parse_ts(c: ColumnOrName, pattern: str = TS_PATTERN) -> Column:
    """Text -> timestamp_ntz; malformed text (or an impossible date) -> NULL.

    The default pattern is read without regard to the session
    time zone; other patterns go through ``try_to_timestamp`` in that zone.
    """
    c = _c(c)
    if pattern != TS_PATTERN:
        return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")
    return _matched(c, _TS_RE, "timestamp_ntz")


def parse_ts_strict(c: ColumnOrName, pattern: str = TS_PATTERN) -> Column:
    """The same parser; malformed text fails the job (NULL stays NULL)."""
    c = _c(c)
    bad = F.raise_error(F.concat(F.lit("bad timestamp: "), c)).cast("timestamp_ntz")
    return F.when(c.isNull(), F.lit(None).cast("timestamp_ntz")).otherwise(F.coalesce(parse_ts(c, pattern), bad))


def parse_date(c: ColumnOrName, pattern: str = DATE_PATTERN) -> Column:
    """Text -> date; malformed text (or an impossible date) -> NULL.

    ``yyyy-M-d``, ``yyyy-M`` and ``yyyy`` are read without regard to the
    session time zone; other patterns go through ``try_to_timestamp``.
    """
    c = _c(c)
    known = {DATE_PATTERN: _DATE_RE, "yyyy-M": _MONTH_RE, "yyyy": _YEAR_RE}
    if pattern in known:
        return _matched(c, known[pattern], "date")
    return F.to_date(F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz"))


def parse_date_lenient(c: ColumnOrName) -> Column:
    """Full, year-month or year-only dates (``2020-05-17``, ``2020-05``, ``2020``) -> date."""
    return _matched(_c(c), _ANY_DATE_RE, "date")


def iso_date(c: ColumnOrName) -> Column:
    """ISO-8601 date or timestamp text (``2024-01-03T10:00:00Z``) -> the date as written."""
    return _c(c).try_cast("date")


def iso_timestamp(c: ColumnOrName) -> Column:
    """ISO-8601 timestamp text -> the date and time as written (an offset or ``Z`` is dropped); a bare date is midnight."""
    return F.regexp_replace(_c(c), r"(Z|[+-][0-9]{2}:?[0-9]{2})$", "").try_cast("timestamp_ntz")


def split_trim(c: ColumnOrName, sep: str = "|") -> Column:
    """Split on a literal separator and strip white space of every kind from every part."""
    return F.transform(F.split(_c(c), re.escape(sep)), lambda p: F.trim(p, F.lit(_WHITE)))


def url_last_segment(c: ColumnOrName) -> Column:
    """Last path segment without the query string (a ``#fragment`` stays)."""
    return F.split_part(F.split_part(_c(c), F.lit("/"), F.lit(-1)), F.lit("?"), F.lit(1))
