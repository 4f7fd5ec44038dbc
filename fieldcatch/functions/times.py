"""Dates and times. Field notes are wall-clock values, so everything is timestamp_ntz."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE_MINUTE = r"^\s*\d{1,2}/\d{1,2}/\d{4} +\d{1,2}:\d{1,2}"


def _from_us_text(c: Column, pattern: str, seconds: bool) -> Column:
    parts = F.split(F.trim(F.regexp_extract(c, pattern, 0)), "[/: ]+")

    def part(i: int) -> Column:
        return F.get(parts, F.lit(i)).try_cast("int")

    return F.try_make_timestamp_ntz(
        part(2), part(0), part(1), part(3), part(4),
        (part(5) if seconds else F.lit(0)).cast("decimal(16,6)"),
    )


def parse_minute(c: Column) -> Column:
    """month/day/year hour:minute; anything after the minute is ignored."""
    return _from_us_text(c, _DATE_MINUTE, seconds=False)


def parse_second(c: Column) -> Column:
    """month/day/year hour:minute:second; missing when the seconds are."""
    return _from_us_text(c, _DATE_MINUTE + r":\d{1,2}", seconds=True)


def parse_report_datetime(c: Column) -> Column:
    """Stage-one output writes US datetimes; ISO text is accepted as well."""
    return F.coalesce(parse_second(c), c.try_cast("timestamp_ntz"))


def trip_date(trip_id: Column) -> Column:
    """The date that follows the two-letter river code of a trip id."""
    digits = F.regexp_extract(F.substring(trip_id, 3, 8), r"^\d{8}$", 0)
    iso = F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))
    return iso.try_cast("date")


# Text is cut from the cast value: date_format would go through the session's time zone, where a
# wall-clock time may not exist.

def iso_text(ts: Column) -> Column:
    return F.substring(ts.cast("string"), 1, 19)


def iso_date(ts: Column) -> Column:
    return F.substring(ts.cast("string"), 1, 10)


def clock(ts: Column) -> Column:
    return F.substring(ts.cast("string"), 12, 5)


def us_date(d: Column) -> Column:
    iso = d.cast("string")
    return F.concat(
        F.substring(iso, 6, 2), F.lit("/"), F.substring(iso, 9, 2), F.lit("/"), F.substring(iso, 1, 4))


def us_datetime(ts: Column) -> Column:
    return F.concat(us_date(ts), F.lit(" "), F.substring(ts.cast("string"), 12, 8))


def hours_between(start: Column, end: Column) -> Column:
    return (end - start).cast("interval second").cast("bigint") / F.lit(3600.0)


def plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def plus_days(ts: Column, days: int) -> Column:
    return plus_seconds(ts, F.lit(days * 24 * 60 * 60))


def effort_seconds(minutes: Column, seconds: Column) -> Column:
    return minutes * 60 + seconds


def mmss_seconds(c: Column) -> Column:
    """`mm:ss` text as seconds; a minute or second past its clock range is missing."""
    pattern = r"^\s*(\d{1,2}):(\d{1,2})"
    minute = F.regexp_extract(c, pattern, 1).try_cast("int")
    second = F.regexp_extract(c, pattern, 2).try_cast("int")
    return F.when((minute <= 59) & (second <= 61), minute * 60 + second)


def sampling_night(ts: Column, first_night: Column) -> Column:
    """Night of the trip: work after midnight still belongs to the evening before.

    Hour 6 itself belongs to neither night and is missing.
    """
    days = F.date_diff(ts.cast("date"), first_night)
    hour = F.hour(ts)
    return F.when(hour > 6, days + 1).when(hour < 6, days)


def _edge(moment: datetime | Column) -> Column:
    return moment if isinstance(moment, Column) else F.lit(moment).cast("timestamp_ntz")


def type_by_cutoff(ts: Column, cutoff: datetime | Column, before: int, after: int) -> Column:
    """Sample type by start time; exactly at the cutoff, or without a time, it is missing."""
    edge = _edge(cutoff)
    return F.when(ts < edge, F.lit(before)).when(ts > edge, F.lit(after))


def repair_year(ts: Column, earliest: datetime | Column, days: int = 366) -> Column:
    """Times before `earliest` carry last year's date; move them forward."""
    edge = _edge(earliest)
    return F.when(ts < edge, plus_days(ts, days)).otherwise(ts)
