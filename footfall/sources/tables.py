"""Reading the logs: partition scans, snapshots, normalised columns and control tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import scalars, times


def scan_partition(table: DataFrame, day: dt.date | str | Column) -> DataFrame:
    """Rows of one date. On a table partitioned by ``time`` only that partition is read."""
    return table.where(F.col("time") == _date(day))


def scan_range(
    table: DataFrame, first, last, include_last: bool = True
) -> DataFrame:
    """Rows from the first to the last date, the last one included unless said otherwise."""
    upper = F.col("time") <= _date(last) if include_last else F.col("time") < _date(last)
    return table.where((F.col("time") >= _date(first)) & upper)


def scan_days(table: DataFrame, days: list) -> DataFrame:
    """Rows of any of the given dates."""
    return table.where(F.col("time").isin([_date(d) for d in days]))


def run_hours(now: dt.datetime) -> tuple[str, str]:
    """First hour and end (not included) of a run during the day, as yyyy_MM_dd_HH: the hours
    of today that are over, or all of yesterday in the hour after midnight."""
    midnight = now.replace(hour=0, minute=0, second=0, microsecond=0)
    first, end = (midnight - dt.timedelta(days=1), midnight) if now.hour == 0 else (midnight, now)
    return first.strftime("%Y_%m_%d_%H"), end.strftime("%Y_%m_%d_%H")


def scan_hours(table: DataFrame, first: str, end: str, hour: str = "hour") -> DataFrame:
    """Rows of a table partitioned by hour (yyyy_MM_dd_HH), from first up to before end."""
    return table.where((F.col(hour) >= first) & (F.col(hour) < end))


def latest_snapshot(table: DataFrame, day=None) -> DataFrame:
    """The newest dated snapshot of a dimension, or the one asked for."""
    newest = _date(day) if day is not None else table.agg(F.max("time")).scalar()
    return table.where(F.col("time") == newest)


def _date(day) -> Column:
    if isinstance(day, Column):
        return day
    return F.to_date(F.lit(str(day).replace("_", "-")))


def scan_listed_days(table: DataFrame, control: DataFrame) -> DataFrame:
    """Rows of the dates that a control table lists in ``time``. On a table partitioned by date
    Spark reads the control table first and prunes all other dates."""
    # a comparison on the list is what makes Spark consider pruning by it
    days = control.select("time").where(F.col("time") >= F.to_date(F.lit("0001-01-01"))).distinct()
    return table.join(F.broadcast(days), "time", "left_semi")  # no longer than the calendar


def checked_scans(raw: DataFrame) -> DataFrame:
    """``normalize_scans`` with all rows kept: ``reject_reason`` says what could not be read, and
    ``raw_row`` holds such a row as it was logged, as JSON."""
    numbers = ["sch_version", "uploadcount", "pls_index", "play_index", "signal"]
    typed = {c: F.col(c).cast("string").try_cast("int") for c in numbers if c in raw.columns}
    if dict(raw.dtypes)["scan_time"] == "string":
        typed["scan_time"] = times.scan_seconds(F.col("scan_time"))
    if dict(raw.dtypes).get("time") == "string":
        typed["time"] = times.partition_date(F.col("time"))
    typed["raw_row"] = F.to_json(F.struct(*raw.columns))
    return _checked(raw.withColumns(typed), {"scan_time": "scan_time"})


def normalize_scans(raw: DataFrame) -> DataFrame:
    """Scan log as logged (text columns) with typed columns; rows whose time cannot be read are
    dropped. Columns that are already typed pass through."""
    return _accepted(checked_scans(raw))


def _checked(rows: DataFrame, needed: dict[str, str]) -> DataFrame:
    """Add ``reject_reason``: the first of the ``needed`` columns (column -> its name in the log)
    that is null; ``raw_row`` stays where there is one."""
    missing = [F.when(F.col(c).isNull(), F.lit(f"unreadable {name}")) for c, name in needed.items()]
    return rows.withColumn("reject_reason", F.coalesce(*missing)).withColumn(
        "raw_row", F.when(F.col("reject_reason").isNotNull(), F.col("raw_row"))
    )


def _accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reject_reason").isNull()).drop("reject_reason", "raw_row")


def clip_to_day(scans: DataFrame, drop_ap: bool = True) -> DataFrame:
    """Scans that happened on their partition's date, under a real schedule version, and not
    by an access point."""
    kept = scans.where(
        (times.day_of(F.col("scan_time")) == F.col("time")) & (F.col("sch_version") != 0)
    )
    return kept.where(F.col("is_ap") == "0") if drop_ap else kept


def normalize_plays(raw: DataFrame, unversioned: bool = False) -> DataFrame:
    """Play log as logged with ``start_ms``/``end_ms`` and the packed version split up. Rows
    that cannot be read are dropped. Logs without versions get version and batch 0."""
    return _accepted(checked_plays(raw, unversioned))


def checked_plays(raw: DataFrame, unversioned: bool = False) -> DataFrame:
    """``normalize_plays`` with all rows kept, as ``checked_scans`` does."""
    version = F.lit(0) if unversioned else scalars.version_part(F.col("sv")).try_cast("int")
    batch = F.lit(0) if unversioned else scalars.batch_part(F.col("sv"))
    typed = raw.withColumns(
        {
            "raw_row": F.to_json(F.struct(*raw.columns)),
            "start_ms": times.play_millis(F.col("st")),
            "end_ms": times.play_millis(F.col("et")),
            "sch_version": version,
            "uploadcount": batch,
            "pls_index": F.col("pi").cast("string").try_cast("int"),
            "play_index": F.col("idx").cast("string").try_cast("int"),
            "plninfo": F.col("pid"),
        }
    )
    return _checked(typed, {"start_ms": "st", "end_ms": "et"})


def read_probes(spark: SparkSession, path: str) -> DataFrame:
    """Control table of moments: a CSV with probe_id, devid, date and clock time."""
    rows = spark.read.csv(path, header=True, schema="probe_id long, devid string, day string, clock string")
    day = times.partition_date(F.replace(F.col("day"), F.lit("."), F.lit("-")))
    at = F.unix_seconds(
        F.try_to_timestamp(F.concat_ws(" ", day.cast("string"), F.col("clock")), F.lit(times.SCAN_FORMAT))
    )
    return rows.select("probe_id", "devid", at.alias("at")).where(F.col("at").isNotNull())


def read_buildings(spark: SparkSession, path: str) -> DataFrame:
    """Control table of buildings: a CSV with building_name, devid and a first and last date,
    opened out to one row per date."""
    rows = spark.read.csv(
        path, header=True, schema="building_name string, devid string, first string, last string"
    )
    first, last = times.partition_date(F.col("first")), times.partition_date(F.col("last"))
    return rows.where(first <= last).select(
        "building_name", "devid", F.explode(times.days_between(first, last)).alias("time")
    )


@contextmanager
def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a reused intermediate result for the length of a with-block."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
