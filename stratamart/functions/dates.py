"""Date and time expressions."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratamart.clock import RunClock

# Date formats of the source files.
POS_DATE_FORMAT = "M-d-yyyy"
FILE_DATE_FORMAT = "yyyyMMdd"
RUN_STAMP_FORMAT = "yyyyMMddHHmmss"


def load_stamps(clock: RunClock) -> dict[str, Column]:
    """``loadts`` and ``loaddt`` columns of one run."""
    return {"loadts": clock.ts_col, "loaddt": clock.day_col}


def parse_pos_date(text: Column, strict: bool = True) -> Column:
    """``MM-dd-yyyy`` text to a date; bad text fails, or gives null when lenient."""
    return F.to_date(text, POS_DATE_FORMAT) if strict else F.try_to_date(text, POS_DATE_FORMAT)


def merge_date_time(day: Column, time_text: Column) -> Column:
    """Timestamp from a date and a time-of-day text (``HH``, ``HH:mm`` or ``HH:mm:ss``)."""
    return F.concat(day.cast("string"), F.lit(" "), time_text).cast("timestamp")


def in_year(day: Column, year: int) -> Column:
    """Year filter as a range, so that statistics and partitions can prune it."""
    return (day >= F.lit(date(year, 1, 1))) & (day < F.lit(date(year + 1, 1, 1)))


def clamp_future(day: Column, clock: RunClock) -> Column:
    """Dates after the run date become the run date; null stays null."""
    return F.when(day > clock.day_col, clock.day_col).otherwise(day)


def clamps_into_year(day: Column, year: int, clock: RunClock) -> Column:
    """Whether a date lies in ``year`` once future dates become the run date.

    Said of the date as stored, so that statistics and partitions can prune: in
    the run year every date from January on qualifies, in an earlier year the
    clamp changes nothing, and a later year is never reached.
    """
    if clock.day.year == year:
        return day >= F.lit(date(year, 1, 1))
    return in_year(day, year) if clock.day.year > year else F.lit(False)


def year_of_birth(age: Column, clock: RunClock) -> Column:
    return F.lit(clock.day.year) - age


def uri_date(uri: Column) -> Column:
    """Date from the last eight characters of a path column (``…_20250701``)."""
    return F.to_date(F.right(uri, F.lit(8)), FILE_DATE_FORMAT)


def path_date(path: Column) -> Column:
    """Date a data file's name (before its extensions), or the folder it lies in, ends with; null without one."""
    return F.try_to_date(F.regexp_extract(path, "([0-9]{8})([.][^/]*)?(/[^/]*)?$", 1), FILE_DATE_FORMAT)


def uri_day(uri: str) -> date:
    """Date that a path string ends with, before any extensions; bad text is an error."""
    return datetime.strptime(re.sub(r"[.][^/]*$", "", uri.rstrip("/"))[-8:], "%Y%m%d").date()
