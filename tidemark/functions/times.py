"""Lenient time parsing. Results are instants and do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Milliseconds of the first and last moment that a calendar year 1..9999 can hold.
_FIRST_MS = -62_135_596_800_000
_LAST_MS = 253_402_300_799_999
_ISO = (
    r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?))?"
    r"(?:Z|[+-]\d{2}:?\d{2})?$"
)


def event_time(event: Column, name: str, now: Column) -> Column:
    """Epoch milliseconds of an event: missing means 0, unusable means ``now``."""
    raw = F.try_variant_get(event, f"$.{name}", "variant")
    ms = F.try_variant_get(event, f"$.{name}", "double")
    usable = ms.between(_FIRST_MS, _LAST_MS)
    at = F.timestamp_micros(F.round(F.when(usable, ms) * 1000).cast("bigint"))
    return F.when(raw.isNull(), F.timestamp_micros(F.lit(0).cast("bigint"))).otherwise(
        F.coalesce(at, now)
    )


def iso_as_utc(text: Column) -> Column:
    """ISO date and time read as UTC; an offset in the text is ignored, bad text is NULL."""
    day = F.regexp_extract(text, _ISO, 1)
    clock = F.regexp_extract(text, _ISO, 2)
    full = F.when(clock == "", "00:00:00").when(F.length(clock) == 5, F.concat(clock, F.lit(":00")))
    moment = F.concat(day, F.lit("T"), F.coalesce(full, clock), F.lit("Z"))
    return moment.try_cast("timestamp")


def local_day(at: Column, zone: str) -> Column:
    """Calendar day of an instant in a time zone."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_clock(at)))


def utc_day(at: Column) -> Column:
    """Calendar day of an instant in UTC."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(at) / 86_400).cast("int"))


def as_utc(clock: Column) -> Column:
    """Instant of a wall-clock time that is meant in UTC."""
    return F.concat(clock.cast("string"), F.lit("Z")).cast("timestamp")


def utc_clock(at: Column) -> Column:
    """Wall-clock time of an instant in UTC."""
    epoch = F.lit("1970-01-01T00:00:00").cast("timestamp_ntz")
    zero = F.lit(0)
    seconds = F.unix_micros(at) / F.lit(1_000_000).cast("decimal(10,0)")
    return epoch + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))
