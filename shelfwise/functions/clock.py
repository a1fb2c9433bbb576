"""Batch ids, crawl time strings and week labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.text import col

BATCH_FORMAT = "yyyyMMdd_HHmmss"


def batch_id(ts: Column | str) -> Column:
    """Timestamp to 'yyyyMMdd_HHmmss'."""
    return F.date_format(col(ts), BATCH_FORMAT)


def _digits_to_time(c: Column, time_from: int) -> Column:
    """'yyyyMMdd' at 1 and 'HHmmss' at ``time_from`` to a timestamp.

    Cutting the text and casting it is several times faster than parsing with a format pattern.
    """
    piece = lambda start, length: F.substring(c, start, length)
    text = F.concat(
        piece(1, 4), F.lit("-"), piece(5, 2), F.lit("-"), piece(7, 2), F.lit(" "),
        piece(time_from, 2), F.lit(":"), piece(time_from + 2, 2), F.lit(":"), piece(time_from + 4, 2),
    )
    return text.try_cast("timestamp")


def batch_time(c: Column | str, zone: str | None = None) -> Column:
    """Batch id to timestamp; both 'yyyyMMdd_HHmmss' and epoch-second ids are read.

    Dated ids are written in local time of the collecting host: ``zone`` names it (None: UTC).
    """
    epoch = F.timestamp_seconds(F.when(F.length(col(c)).between(9, 11), col(c).try_cast("bigint")))
    dated = (F.length(col(c)) == 15) & (F.substring(col(c), 9, 1) == "_")
    read = _digits_to_time(col(c), 10)
    return F.when(dated, F.to_utc_timestamp(read, zone) if zone else read).otherwise(epoch)


def batch_seconds(c: Column | str, zone: str | None = None) -> Column:
    """Batch id to epoch seconds."""
    return F.unix_timestamp(batch_time(c, zone))


def strdatetime(ts: Column | str, fraction: bool = True) -> Column:
    """'yyyyMMddHHmmss' plus four fraction digits (or '0000')."""
    if fraction:
        return F.date_format(col(ts), "yyyyMMddHHmmssSSSS")
    return F.concat(F.date_format(col(ts), "yyyyMMddHHmmss"), F.lit("0000"))


def crawl_seconds(c: Column | str) -> Column:
    """Crawl time string to epoch seconds, fraction digits dropped."""
    return F.unix_timestamp(_digits_to_time(col(c), 9))


def crawl_time(c: Column | str) -> Column:
    """Crawl time string to timestamp, fraction digits kept."""
    fraction = F.coalesce(F.concat(F.lit("0."), F.nullif(F.substring(col(c), 15, 6), F.lit(""))).try_cast("decimal(7,6)"), F.lit(0).cast("decimal(7,6)"))
    return _digits_to_time(col(c), 9) + F.make_dt_interval(secs=fraction)


def week_label(ts: Column | str) -> Column:
    """ISO week without year: 'w45'."""
    return F.concat(F.lit("w"), F.weekofyear(col(ts)).cast("string"))


def iso_year(ts: Column | str) -> Column:
    """The year the ISO week belongs to."""
    return F.extract(F.lit("YEAROFWEEK"), col(ts)).cast("int")


def date_part(c: Column | str) -> Column:
    """Date part of a 'date time' text."""
    return F.split_part(F.trim(col(c)), F.lit(" "), F.lit(1))


def short_date(c: Column | str) -> Column:
    """'2024-11-25 00:00:00' -> 'Nov 25'; unreadable text stays as it is."""
    day = F.try_to_timestamp(date_part(c), F.lit("yyyy-MM-dd"))
    return F.coalesce(F.date_format(day, "MMM dd"), col(c))
