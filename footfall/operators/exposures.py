"""Exposures: scans of one key that lie close together count as one contact.

Every window here runs over *distinct scan seconds* of a key, so a group can never exceed
86,400 rows per day of input, however many scans one key has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The date is part of the key: a window never grows with the number of days read.
DEVICE_MAC = ["time", "devid", "mac"]


def distinct_seconds(
    scans: DataFrame, keys: list[str] = DEVICE_MAC, t: str = "scan_time"
) -> DataFrame:
    """One row per key and second, with the scans it stands for as ``n_scans``."""
    return (
        scans.where(F.col(t).isNotNull())
        .groupBy(*keys, t)
        .agg(F.count(F.lit(1)).alias("n_scans"))
    )


def scan_gaps(
    scans: DataFrame, keys: list[str] = DEVICE_MAC, t: str = "scan_time"
) -> DataFrame:
    """Distinct scan seconds with the previous one of the key (the first has itself) and the
    gap to it."""
    previous = F.lag(t).over(Window.partitionBy(*keys).orderBy(t))
    return (
        distinct_seconds(scans, keys, t)
        .withColumn("prev_time", F.coalesce(previous, F.col(t)))
        .withColumn("gap", F.col(t) - F.col("prev_time"))
    )


def _is_break(boundary: str, gap: Column, limit: int) -> Column:
    if boundary not in ("ge", "gt"):
        raise ValueError(f"boundary must be 'ge' or 'gt', not {boundary!r}")
    return gap >= limit if boundary == "ge" else gap > limit


def exposures(
    scans: DataFrame,
    gap: int,
    keys: list[str] = DEVICE_MAC,
    boundary: str = "ge",
    t: str = "scan_time",
    multi: bool = True,
    single: bool = True,
) -> DataFrame:
    """Exposures (keys, scan_time) of every key, in one pass.

    multi: a scan that follows the key's previous scan by at least ``gap`` seconds starts a
    new exposure. It is reported together with that previous scan, unless the previous scan
    closely follows the break before it, which has then been reported already.
    single: a key without any such break has one exposure, at its last scan.

    boundary='gt' asks for a gap of more than ``gap``; a key whose widest gap is exactly
    ``gap`` then has neither multi nor single exposures.
    """
    if gap <= 0:
        raise ValueError("gap must be positive")
    w = Window.partitionBy(*keys).orderBy(t)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev, last_break = F.col("prev_time"), F.col("_last_break")

    steps = scan_gaps(scans, keys, t).select(
        "*",
        _is_break(boundary, F.col("gap"), gap).alias("_break"),
        F.lead(t).over(w).isNull().alias("_is_last"),
    )
    steps = steps.select(
        "*",
        F.last(F.when(F.col("_break"), F.col(t)), ignorenulls=True)
        .over(before)
        .alias("_last_break"),
        F.max("gap").over(so_far).alias("_widest"),
    )
    apart = last_break.isNull() | (prev - last_break > gap)
    at_break = F.when(apart, F.array(prev, F.col(t))).otherwise(F.array(F.col(t)))
    alone = F.col("_is_last") & (F.col("_widest") < gap)
    times = F.when(F.col("_break") & F.lit(multi), at_break).when(
        alone & F.lit(single), F.array(F.col(t))
    )
    return steps.select(*keys, F.explode(times).alias(t))


def exposures_multi(scans: DataFrame, gap: int, **options) -> DataFrame:
    """Exposures of keys that were contacted at least twice."""
    return exposures(scans, gap, single=False, **options)


def exposures_single(scans: DataFrame, gap: int, **options) -> DataFrame:
    """Exposures of keys that were contacted once."""
    return exposures(scans, gap, multi=False, **options)


def arrivals(
    scans: DataFrame,
    gap: int,
    keys: list[str],
    boundary: str = "gt",
    t: str = "scan_time",
) -> DataFrame:
    """Arrivals per key: one, and one more for every break."""
    breaks = F.sum(_is_break(boundary, F.col("gap"), gap).cast("long"))
    return scan_gaps(scans, keys, t).groupBy(*keys).agg((1 + breaks).alias("arrivals"))
