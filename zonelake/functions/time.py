"""Timestamp text helpers.

Ingestion timestamps are naive UTC ISO text. Parsing goes to TIMESTAMP_NTZ so
results do not depend on the session time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonelake.functions.util import as_col

# Fixed text formats of the raw zone.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
OBJECT_NAME_FORMAT = "yyyyMMdd_HHmmss_SSSSSS"


def iso_text(ts) -> Column:
    """Timestamp as ISO text that always carries six fraction digits, so
    text order equals time order."""
    return F.date_format(as_col(ts).cast("timestamp_ntz"), ISO_FORMAT)


def parse_ts(text) -> Column:
    """ISO text to TIMESTAMP_NTZ, NULL when unparsable. An offset such as
    ``Z`` is accepted and the wall-clock time kept."""
    return as_col(text).try_cast("timestamp_ntz")


def parse_date(text) -> Column:
    return F.try_to_date(as_col(text))


def hour_floor(ts) -> Column:
    """Start of the hour as TIMESTAMP_NTZ; NULL stays NULL (a time window
    would drop such rows)."""
    return F.date_trunc("HOUR", as_col(ts).cast("timestamp_ntz")).cast("timestamp_ntz")


def utc_now() -> Column:
    """Current time as naive UTC, whatever the session time zone."""
    return utc_naive(F.current_timestamp())


def utc_naive(ts) -> Column:
    """A TIMESTAMP's UTC wall-clock time as TIMESTAMP_NTZ."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), as_col(ts).cast("timestamp_ntz"))


def raw_partition_values(ts) -> list[Column]:
    """Zero-padded year, month, day strings of a timestamp."""
    t = as_col(ts).cast("timestamp_ntz")
    return [
        F.date_format(t, "yyyy").alias("year"),
        F.date_format(t, "MM").alias("month"),
        F.date_format(t, "dd").alias("day"),
    ]


# ISO 8601 forms that Python's ``datetime.fromisoformat`` accepts (3.11+):
# extended or basic date; then optionally any single separator character and
# a time of hours, minutes and seconds (colons optional) with an optional
# fraction after the seconds; then an optional offset. Week dates
# (2025-W48-2) are not recognised: documented divergence.
_ISO_PATTERN = (
    r"(?s)\A(?!0000)\d{4}(?<date>-?)(?:0[1-9]|1[0-2])\k<date>(?:0[1-9]|[12]\d|3[01])"
    r"(?:.(?:[01]\d|2[0-3])(?:(?<time>:?)[0-5]\d(?:\k<time>[0-5]\d(?:[.,]\d+)?)?)?"
    r"(?:Z|[+-](?:[01]\d|2[0-3])(?:(?<off>:?)[0-5]\d(?:\k<off>[0-5]\d(?:[.,]\d+)?)?)?)?)?\z"
)


def is_python_isoformat(text) -> Column:
    """True when ``datetime.fromisoformat(text)`` would succeed. NULL gives
    NULL.

    One regular expression checks the shape, the field ranges and that each
    part uses one kind of separator; only the length of the month is left to
    a date conversion of the first eight digits."""
    t = as_col(text)
    digits = F.replace(F.substring(t, 1, 10), F.lit("-"), F.lit(""))
    real_day = F.try_to_date(F.substring(digits, 1, 8), "yyyyMMdd").isNotNull()
    return F.when(t.isNull(), F.lit(None).cast("boolean")).otherwise(F.regexp_like(t, F.lit(_ISO_PATTERN)) & real_day)


def raw_key(source, ts) -> Column:
    """Object key of a raw record:
    ``source=<x>/year=YYYY/month=MM/day=DD/<yyyyMMdd_HHmmss_ffffff>.json``
    (zero-padded; the reference's layout without the ``source=`` prefix is
    read with ``read_raw(layout="legacy")``)."""
    t = as_col(ts).cast("timestamp_ntz")
    return F.concat(
        F.lit("source="), as_col(source),
        F.date_format(t, "'/year='yyyy'/month='MM'/day='dd'/'"),
        F.date_format(t, OBJECT_NAME_FORMAT), F.lit(".json"),
    )


def period(year: int, month: int, day: int | None = None) -> tuple[str, str]:
    """First instant of a month or day, and of the next one, as ISO text."""
    first = _dt.date(year, month, day or 1)
    after = first + _dt.timedelta(days=1) if day else _dt.date(year + month // 12, month % 12 + 1, 1)
    return f"{first} 00:00:00", f"{after} 00:00:00"
