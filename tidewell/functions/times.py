"""Instants and local calendar time. Instants are TIMESTAMP_NTZ in UTC, independent of the session's zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def to_utc(local: Column, zone: Column) -> Column:
    """The instant of a local time by the zone's historical rules; of an ambiguous time the earlier one."""
    return F.convert_timezone(zone, F.lit("UTC"), local)


def to_local(ts: Column, zone: Column) -> Column:
    return F.convert_timezone(F.lit("UTC"), zone, ts)


def from_millis(ms: Column) -> Column:
    return F.timestamp_add("MILLISECOND", ms, F.lit(EPOCH).cast("timestamp_ntz"))


def from_day_first(text: Column) -> Column:
    """``d.m.yyyy H:M`` as a local time, null for anything else: rearranged to ISO, so no session zone takes part."""
    m = r"^\s*(\d{1,2})\.(\d{1,2})\.(\d{4}) +(\d{1,2}):(\d{1,2})\s*$"
    part = lambda i: F.lpad(F.regexp_extract(text, m, i), 2, "0")
    iso = F.concat(F.regexp_extract(text, m, 3), F.lit("-"), part(2), F.lit("-"), part(1), F.lit(" "), part(4), F.lit(":"), part(5), F.lit(":00"))
    return F.when(text.rlike(m), iso).try_cast("timestamp_ntz")


def from_iso(text: Column) -> Column:
    """``yyyy-mm-ddThh:mm:ss`` (fractions allowed) as a local time, null for anything else."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"), text).try_cast("timestamp_ntz")


def from_iso_utc(text: Column) -> Column:
    """ISO with ``Z`` or a zero offset, as an instant."""
    return from_iso(F.regexp_replace(text, r"(Z|[+-]00:00)$", ""))


def from_date(text: Column) -> Column:
    """``yyyy-mm-dd`` as local midnight."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text).try_cast("date").cast("timestamp_ntz")


def micros_between(early: Column, late: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", early, late)


def seconds_between(early: Column, late: Column) -> Column:
    """Whole seconds, rounded down."""
    return F.floor(micros_between(early, late) / F.lit(1_000_000)).cast("long")


def render(ts: Column) -> Column:
    """Fixed-width ISO with microseconds: its text order is time order."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
