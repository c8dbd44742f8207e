"""Time handling: logs carry text or epoch milliseconds, operators use epoch seconds or
milliseconds as long columns, and tables are partitioned by a date column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text formats of the logs.
SCAN_FORMAT = "yyyy-MM-dd HH:mm:ss"
PLAY_FORMAT = "yyyyMMddHHmmss"

DAY = 86400


def scan_seconds(text: Column, fmt: str = SCAN_FORMAT) -> Column:
    """Epoch seconds of a time text; null where the text cannot be read."""
    return F.unix_seconds(F.try_to_timestamp(text, F.lit(fmt)))


def play_millis(text: Column) -> Column:
    """Epoch milliseconds of a play time with or without its three millisecond digits."""
    seconds = F.unix_seconds(F.try_to_timestamp(F.substring(text, 1, 14), F.lit(PLAY_FORMAT)))
    millis = F.when(F.length(text) > 14, F.substring(text, 15, 3).try_cast("int")).otherwise(0)
    return seconds * 1000 + millis


def stamp_seconds(stamp: Column) -> Column:
    """Whole epoch seconds of an epoch-millisecond stamp held as number or text."""
    return F.substring(stamp.cast("string"), 1, 10).try_cast("long")


def partition_date(text: Column) -> Column:
    """Date of a partition value such as 2018_06_20, 2018-06-20 or 2018_06_20_13."""
    return F.try_to_date(F.substring(F.replace(text, F.lit("_"), F.lit("-")), 1, 10), "yyyy-MM-dd")


def seconds_text(seconds: Column, fmt: str = SCAN_FORMAT) -> Column:
    """Epoch seconds as text."""
    return F.from_unixtime(seconds, fmt)


def day_of(seconds: Column) -> Column:
    """Calendar date of epoch seconds, counted in whole days (time zone of the log)."""
    return F.date_from_unix_date(F.floor(seconds / DAY).cast("int"))


def day_start(day: Column) -> Column:
    """Epoch seconds of midnight of a date, on the clock of ``day_of``."""
    return F.unix_date(day).cast("long") * DAY


def six_oclock(day: Column) -> Column:
    """Epoch seconds of 06:00 of a date."""
    return day_start(day) + 6 * 3600


def hour_of(seconds: Column) -> Column:
    """Hour of day of epoch seconds."""
    return F.floor(F.pmod(seconds, F.lit(DAY)) / 3600).cast("int")


def trailing_days(day: Column, days: int = 7) -> Column:
    """The date and the days before it, newest first."""
    return F.sequence(day, F.date_sub(day, days - 1), F.expr("interval -1 day"))


def days_between(first: Column, last: Column) -> Column:
    """All dates from first to last, both included."""
    return F.sequence(first, last)


def previous_week(day: Column) -> tuple[Column, Column]:
    """Monday and Sunday of the ISO week before the date's own."""
    monday = F.date_trunc("week", day).cast("date")
    return F.date_sub(monday, 7), F.date_sub(monday, 1)


def previous_month(day: Column) -> tuple[Column, Column]:
    """First and last date of the month before the date's own."""
    month = F.add_months(F.date_trunc("month", day).cast("date"), -1)
    return month, F.last_day(month)


def same_day(scan_day: Column, play_day: Column, next_day: bool) -> Column:
    """Whether a play of that date, or of the date after it, may meet a scan of this one."""
    same = play_day == scan_day
    return same | (play_day == F.date_add(scan_day, 1)) if next_day else same


def date_windows(df: DataFrame, day: str = "time") -> DataFrame:
    """The windows a run on each distinct date of the table would cover."""
    days = df.select(day).distinct()
    week = previous_week(F.col(day))
    month = previous_month(F.col(day))
    return days.select(
        day,
        F.date_sub(day, 6).alias("trail_start"),
        F.size(trailing_days(F.col(day))).alias("trail_days"),
        week[0].alias("week_start"),
        week[1].alias("week_end"),
        month[0].alias("month_start"),
        month[1].alias("month_end"),
        F.size(days_between(*month)).alias("month_days"),
    )
