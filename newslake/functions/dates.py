"""Date and timestamp column functions.

Raw date strings are kept as they arrive; typed values are derived next to them. All
parsing uses ``try_*`` forms so dirty values become NULL under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newslake.functions.text import as_col

ISO_DAY_PATTERN = r"\d{4}-\d{2}-\d{2}"
# Compact ISO-8601 date (optionally followed by a time part), as ``fromisoformat`` takes it.
BASIC_ISO_PATTERN = r"^\d{8}(T.*)?$"
# RFC-822 date part ("Sat, 21 Jun 2025 01:47:00 GMT" -> "21 Jun 2025").
RFC822_DAY_PATTERN = r"(\d{1,2} [A-Za-z]{3} \d{4})"
ISO_SECONDS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def extract_day(raw: Column | str, formats: str = "iso") -> Column:
    """Day string ``yyyy-MM-dd`` of a timestamp string, else NULL.

    The first ``dddd-dd-dd`` anywhere in the text wins (not calendar-checked); otherwise a
    compact ISO date ``yyyyMMdd[T...]`` is parsed. ``formats='iso+rfc822'`` additionally
    reads the date part of RFC-822 stamps, keeping the day as written (its own offset).
    """
    if formats not in ("iso", "iso+rfc822"):
        raise ValueError(f"unknown formats {formats!r}")
    r = as_col(raw)
    found = F.nullif(F.regexp_extract(r, ISO_DAY_PATTERN, 0), F.lit(""))
    basic = F.when(
        r.rlike(BASIC_ISO_PATTERN),
        F.date_format(F.try_to_date(F.substring(r, 1, 8), "yyyyMMdd"), "yyyy-MM-dd"),
    )
    parts = [found, basic]
    if formats == "iso+rfc822":
        rfc = F.nullif(F.regexp_extract(r, RFC822_DAY_PATTERN, 1), F.lit(""))
        parts.append(F.date_format(F.try_to_date(rfc, "d MMM yyyy"), "yyyy-MM-dd"))
    return F.coalesce(*parts)


def date_prefix(raw: Column | str) -> Column:
    """``raw[:10]`` when the string has at least 10 characters, else ``''``."""
    r = F.coalesce(as_col(raw), F.lit(""))
    return F.when(F.length(r) >= 10, F.substring(r, 1, 10)).otherwise(F.lit(""))


def quarter_label(d: Column | str) -> Column:
    """``YYYY_Qn`` for a date/timestamp column."""
    c = as_col(d)
    return F.concat(F.year(c).cast("string"), F.lit("_Q"), F.quarter(c).cast("string"))


def time_tuple_to_ts(arr: Column | str) -> Column:
    """``[y, m, d, H, M, S, ...]`` (a struct_time list) -> TIMESTAMP_NTZ; NULL if invalid."""
    a = as_col(arr)
    return F.try_make_timestamp_ntz(
        years=F.element_at(a, 1), months=F.element_at(a, 2), days=F.element_at(a, 3),
        hours=F.element_at(a, 4), mins=F.element_at(a, 5),
        secs=F.element_at(a, 6).cast("decimal(16,6)"),
    )


def iso_seconds(ts: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` text of a timestamp (the snapshot writer's format)."""
    return F.date_format(as_col(ts), ISO_SECONDS_FORMAT)


def parse_published(raw: Column | str) -> Column:
    """Best-effort TIMESTAMP of a published string: ISO first, then RFC-822 (UTC)."""
    r = as_col(raw)
    no_weekday = F.regexp_replace(r, r"^[A-Za-z]{3},\s*", "")
    return F.coalesce(
        F.try_to_timestamp(r),
        F.try_to_timestamp(no_weekday, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(no_weekday, F.lit("d MMM yyyy HH:mm:ss xx")),
    )
