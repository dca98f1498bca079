"""Dates as text, time slices and time-based keys.  All clocks are UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date patterns of the feeds, the run records and the pages.
FEED_PATTERN = "yyyyMMdd HH:mm:ss"
SHORT_PATTERN = "MMddyyyy"
OUTPUT_PATTERN = "yyyy-MM-dd HH:mm:ss"
DISPLAY_PATTERN = "M-d-yy H:mm:ss 'UTC'"
INSTANCE_PATTERN = "yyyyMMdd'T'HHmm"
FOLDER_PATTERN = "yyyyMMddHHmm"

LONG_MAX = 2**63 - 1


def as_timestamp(ts: Column) -> Column:
    """Zone-free timestamps (as Parquet files often hold) read as UTC."""
    return ts.cast("timestamp")


def reformat(text: Column, source: str, target: str, strict: bool = False) -> Column:
    """Date text from one pattern to another; unreadable text gives null, or
    raises when ``strict``."""
    parse = F.to_timestamp if strict else F.try_to_timestamp
    pattern = source if strict else F.lit(source)
    return F.date_format(parse(text, pattern), target)


def _seconds(ts: Column) -> Column:
    return F.unix_seconds(as_timestamp(ts))


def slice_start(ts: Column, minutes: int = 30) -> Column:
    """Start of the fixed slice that holds ``ts``."""
    s = _seconds(ts)
    return F.timestamp_seconds(s - F.pmod(s, F.lit(minutes * 60)))


def slice_end(ts: Column, minutes: int = 30) -> Column:
    """End of that slice; slices are named by their end."""
    s = _seconds(ts)
    return F.timestamp_seconds(s - F.pmod(s, F.lit(minutes * 60)) + minutes * 60)


def round_slice(ts: Column, round_to: int = 0, offset: int = 0) -> Column:
    """Shift by ``offset`` minutes, drop seconds, then round up (positive) or
    down (negative) to a multiple of ``round_to`` minutes within the hour."""
    step = abs(round_to)
    if step and 60 % step:
        raise ValueError(f"round_to must divide 60, not {round_to}")
    minute = F.date_trunc("minute", as_timestamp(ts) + F.make_dt_interval(mins=F.lit(offset)))
    if not step:
        return minute
    s = F.unix_seconds(minute)
    past = F.pmod(s, F.lit(step * 60))
    if round_to < 0:
        return F.timestamp_seconds(s - past)
    return F.timestamp_seconds(s + F.pmod(F.lit(step * 60) - past, F.lit(step * 60)))


def slice_folder(prefix: str, ts: Column, pattern: str = FOLDER_PATTERN) -> Column:
    """Folder name such as ``input-202401011230``."""
    return F.concat(F.lit(prefix), F.date_format(as_timestamp(ts), pattern))


def instance_id(customer: Column, activity: Column, ts: Column) -> Column:
    """``customer-activity-yyyyMMddTHHmm``, the key of a load log."""
    return F.concat_ws("-", customer, activity, F.date_format(as_timestamp(ts), INSTANCE_PATTERN))


def iso_from_millis(millis: Column) -> Column:
    """Epoch milliseconds as ISO text with seven zero digits."""
    stamp = F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(stamp, F.lit(".0000000"))


def millis_from_iso(text: Column) -> Column:
    """ISO text (up to seven fraction digits, optional Z) as epoch milliseconds."""
    return F.unix_millis(text.try_cast("timestamp"))


def display(ts: Column) -> Column:
    return F.date_format(as_timestamp(ts), DISPLAY_PATTERN)


def day_key(ts: Column) -> Column:
    return F.date_trunc("day", as_timestamp(ts))


def newest_first_key(ts: Column) -> Column:
    """Key whose ascending order is newest first."""
    return F.lit(LONG_MAX) - F.unix_millis(as_timestamp(ts))
