"""Timestamp parsing and arithmetic.

All parsed values are ``timestamp_ntz``: wall-clock time without a zone, the
type of the staging columns. Parsing never raises (Spark 4 is ANSI by default,
so plain ``to_timestamp('')`` would fail the job): a shape check by regular
expression decides which format applies, and ``try_cast`` rejects impossible
dates such as February 30th.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text shapes. The ISO form with "T" takes an optional fraction of one
# to six digits; the form with a blank takes none.
_ISO_T = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"
_ISO_BLANK = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts_one_format(c) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` only; anything else (incl. '' and null) -> null."""
    c = _col(c)
    return F.when(c.rlike(_ISO_BLANK), c.try_cast("timestamp_ntz"))


def parse_ts(c) -> Column:
    """ISO with 'T' and optional fraction, or ``yyyy-MM-dd HH:mm:ss``; else null."""
    c = _col(c)
    return F.when(c.rlike(_ISO_T) | c.rlike(_ISO_BLANK), c.try_cast("timestamp_ntz"))


def to_ts(c) -> Column:
    """cast to ``timestamp_ntz`` (no zone), null on failure."""
    return _col(c).try_cast("timestamp_ntz")


def whole_days_between(later, earlier) -> Column:
    """day part of ``later - earlier``, truncated toward zero, as bigint.

    09-13 08:59 -> 09-23 00:00 is 9 (not the calendar difference 10); null if
    either side is null.
    """
    return F.extract(F.lit("DAY"), _col(later) - _col(earlier)).cast("bigint")


def add_seconds(ts, seconds) -> Column:
    return F.timestamp_add("SECOND", _col(seconds).cast("int"), _col(ts))


def add_days(ts, days) -> Column:
    return F.timestamp_add("DAY", _col(days).cast("int"), _col(ts))


def iso_text(ts, sep: str = "T", fraction: bool = False) -> Column:
    """``timestamp_ntz`` -> ``yyyy-MM-dd<sep>HH:mm:ss[.ffffff]`` without any time
    zone: built from the text cast of the value (``date_format`` would go through
    the session zone and shift wall times that fall in a daylight-saving gap)."""
    text = _col(ts).cast("timestamp_ntz").cast("string")
    base = F.concat(F.substring(text, 1, 10), F.lit(sep), F.substring(text, 12, 8))
    if not fraction:
        return base
    frac = F.rpad(F.regexp_extract(text, r"\.(\d+)$", 1), 6, "0")
    return F.concat(base, F.lit("."), frac)


def utc_iso(ts_ntz=None) -> Column:
    """ISO-8601 text with six fraction digits and a +00:00 suffix.

    With no argument the current time (converted from the session zone to UTC)
    is used; pass a ``timestamp_ntz`` column (UTC wall time) for repeatable output.
    """
    if ts_ntz is None:
        ts_ntz = F.convert_timezone(
            None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    return F.concat(iso_text(ts_ntz, "T", fraction=True), F.lit("+00:00"))


def ts_text(ts, iso_t: bool = False) -> Column:
    """Timestamp -> text as written by CSV exports (``yyyy-MM-dd HH:mm:ss``), or
    the ISO form with 'T'; zone-free."""
    return iso_text(ts, "T" if iso_t else " ")


def month_start(ts) -> Column:
    """First instant of the timestamp's month (``timestamp_ntz``), zone-free."""
    return F.trunc(F.to_date(_col(ts)), "MM").cast("timestamp_ntz")


def on_dates(ts, start, end) -> Column:
    """P5: ``ts::date BETWEEN start AND end``, written as a half-open range on the
    raw column so that Parquet row groups can be skipped by min/max statistics."""
    start = _as_date(start)
    end = _as_date(end)
    # Bounds as text -> timestamp_ntz: a Python datetime literal would be zoned.
    lo = F.lit(f"{start.isoformat()} 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{(end + _dt.timedelta(days=1)).isoformat()} 00:00:00").cast("timestamp_ntz")
    c = _col(ts)
    return (c >= lo) & (c < hi)


def _as_date(d) -> _dt.date:
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d))
