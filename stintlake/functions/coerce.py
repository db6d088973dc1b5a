"""Lenient coercion of text columns and calendar buckets, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_str_or_null(c: str | Column) -> Column:
    """Trimmed text; blank is null."""
    return F.nullif(F.trim(_col(c).cast("string")), F.lit(""))


def _number_text(c: str | Column) -> Column:
    text = F.trim(_col(c).cast("string"))
    return F.when(text.isin("", "NA", "N/A"), None).otherwise(text)


def to_int_or_null(c: str | Column) -> Column:
    """Whole numbers with optional sign; anything else (blank, NA, N/A, words) is null."""
    return F.when(_number_text(c).rlike(r"^[+-]?\d+$"), _number_text(c).try_cast("bigint"))


def to_float_or_null(c: str | Column) -> Column:
    """Numbers, thousands commas allowed; anything else is null."""
    return F.regexp_replace(_number_text(c), ",", "").try_cast("double")


def ms_to_timestamp(c: str | Column) -> Column:
    return F.timestamp_millis(_col(c).cast("bigint"))


def ms_to_date(c: str | Column) -> Column:
    return ms_to_timestamp(c).cast("date")


def ms_to_iso(c: str | Column) -> Column:
    """Epoch milliseconds as ISO-8601 UTC text; a fraction is only written if there is one."""
    ts = ms_to_timestamp(c)
    whole = (_col(c).cast("bigint") % 1000) == 0
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))


def week_start(date: str | Column, day: str = "tuesday") -> Column:
    """The date rolled back to the last `day` of the week (itself if it is one)."""
    start = WEEKDAYS.index(day.lower())
    return F.date_sub(_col(date), (F.weekday(_col(date)) - F.lit(start) + 7) % 7)
