"""Filters and key repairs applied to scan logs before anything is counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.scalars import mac_prefix, wanted
from footfall.functions.times import hour_of
from footfall.operators.spread import key_counts, lookup_join, spread_join


def known_prefixes(factory: DataFrame, ignore_case: bool = True) -> DataFrame:
    """Distinct vendor prefixes that have a vendor name, as ``_prefix``."""
    return (
        factory.where(F.col("factory_name").isNotNull())
        .select(mac_prefix(F.col("mac_index_factory"), ignore_case).alias("_prefix"))
        .distinct()
    )


def spoof_filter(
    scans: DataFrame, factory: DataFrame, ignore_case: bool = True
) -> DataFrame:
    """Keep scans whose mac belongs to a known vendor. Never multiplies rows."""
    return lookup_join(
        scans.withColumn("_prefix", mac_prefix(F.col("mac"), ignore_case)),
        known_prefixes(factory, ignore_case), ["_prefix"], "left_semi", factory,
    ).drop("_prefix")


def vendor_flag(
    df: DataFrame, factory: DataFrame, ignore_case: bool = True, name: str = "genuine"
) -> DataFrame:
    """Add a flag telling whether the mac belongs to a known vendor."""
    known = known_prefixes(factory, ignore_case).withColumn("_known", F.lit(True))
    prefixed = df.withColumn("_prefix", mac_prefix(F.col("mac"), ignore_case))
    return (
        lookup_join(prefixed, known, ["_prefix"], "left", factory)
        .withColumn(name, F.col("_known").isNotNull())
        .drop("_prefix", "_known")
    )


def active_devices(
    location: DataFrame,
    status: str | None = "已安装",
    not_status: str | None = None,
    style_prefix: str | None = None,
    styles: tuple[str, ...] = (),
    devid_length: int | None = None,
    kind: str | None = None,
    cities: tuple[str, ...] = (),
) -> DataFrame:
    """Rows of devices in service, by any mix of the usual tests."""
    rows = location.where(wanted(F.col("install_status"), status))
    rows = rows.where(wanted(F.col("devicekind"), kind))
    if not_status is not None:
        rows = rows.where(F.col("install_status") != not_status)
    if style_prefix is not None:
        rows = rows.where(
            F.substring("device_style", 1, len(style_prefix)) == style_prefix
        )
    if styles:
        rows = rows.where(styled(F.col("device_style"), styles))
    if devid_length is not None:
        rows = rows.where(F.length("devid") == devid_length)
    if cities:
        rows = rows.where(F.col("city_name").isin(*cities))
    return rows


def styled(style: Column, styles: tuple[str, ...]) -> Column:
    """Device style holding any of the given marks."""
    out = F.lit(False)
    for mark in styles:
        out = out | style.contains(mark)
    return out


def device_city(location: DataFrame) -> DataFrame:
    """One city and building name per device that has not been taken down."""
    return (
        location.where(F.col("install_status") != "已拆除")
        .groupBy("devid")
        .agg(
            F.max("city_name").alias("city_name"),
            F.max("building_name").alias("building_name"),
        )
    )


def drop_heavy(df: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """Drop all rows of keys that have more than ``limit`` rows.

    Rows per key are counted first, on the map side where they meet; the rows themselves are
    joined once with the keys that have too many.
    """
    counts = key_counts(df, keys)
    heavy = counts.where(F.col("_rows") > limit).select(*keys)
    return spread_join(df, heavy, keys, "left_anti", counts)


def mac_summaries(scans: DataFrame, t: str = "scan_time") -> DataFrame:
    """Per date, device and mac the number of scans and the hours of the day with any, as a
    24-bit mask. Summaries of parts of a log add up (``merged_summaries``), so those of past
    dates can be stored and need no scans again."""
    return scans.groupBy("time", "devid", "mac").agg(
        F.count(t).alias("scans"),
        F.bit_or(F.call_function("shiftleft", F.lit(1), hour_of(F.col(t)))).alias("hours"),
    )


def merged_summaries(parts: DataFrame) -> DataFrame:
    """One summary per date, device and mac from several."""
    return parts.groupBy("time", "devid", "mac").agg(
        F.sum("scans").alias("scans"), F.bit_or("hours").alias("hours")
    )


def roaming_in(summaries: DataFrame, max_scans: int, max_hours: int) -> DataFrame:
    """Macs that, on any day, have more than ``max_scans`` scans in all or are seen by one
    device in more than ``max_hours`` different hours, from their summaries."""
    return (
        summaries.groupBy("time", "mac")
        .agg(F.sum("scans").alias("_scans"), F.max(F.bit_count("hours")).alias("_hours"))
        .where((F.col("_scans") > max_scans) | (F.col("_hours") > max_hours))
        .select("mac")
        .distinct()
    )


def roaming_macs(
    scans: DataFrame, max_scans: int, max_hours: int, t: str = "scan_time"
) -> DataFrame:
    """``roaming_in`` of the scans themselves."""
    return roaming_in(mac_summaries(scans, t), max_scans, max_hours)


def dominant_serial(
    scans: DataFrame, keys: list[str], serial: str = "inner_sn"
) -> DataFrame:
    """Per device keep the rows of the serial number with most scans (ties: the smallest)."""
    full = [*keys, serial]
    counts = key_counts(scans.where(F.col(serial).isNotNull()), full)
    winners = counts.groupBy(*keys).agg(
        F.min_by(F.col(serial), F.struct(-F.col("_rows"), F.col(serial))).alias(serial)
    )
    return spread_join(scans, winners, full, "left_semi", counts)


def panel_filter(
    scans: DataFrame, panel: DataFrame, pairs: DataFrame, devices: DataFrame
) -> DataFrame:
    """Scans of panel members on sampled (device, mac) pairs of the given devices, with the
    member's ``id``. A member's city is the first four characters of the device.

    The three lists are joined with each other first; the scans meet the outcome once.
    """
    members = panel.select(F.lower("mac").alias("_mac"), "id", "city").distinct()
    allowed = (
        pairs.select("devid", F.lower("mac").alias("_mac")).distinct()
        .join(devices.select("devid").distinct(), "devid", "left_semi")
        .withColumn("city", F.substring("devid", 1, 4))
        .join(members, ["_mac", "city"], "inner")
        .select("devid", "_mac", "id")
    )
    return lookup_join(
        scans.withColumn("_mac", F.lower("mac")), allowed, ["devid", "_mac"], "inner", (panel, pairs)
    ).drop("_mac")


def backfill_batch(
    rows: DataFrame, schedule: DataFrame, by_day: bool = False
) -> DataFrame:
    """Replace batch 0 of versions other than 0 by the greatest batch that the schedule has
    for the city and version (and date). Rows carry citycode, sch_version, uploadcount."""
    top = schedule.groupBy(
        "citycode", F.col("buildinglist").alias("sch_version"), *_day_key(by_day)
    ).agg(F.max("uploadcount").alias("_top"))
    on = ["citycode", "sch_version"] + (["time"] if by_day else [])
    missing = (F.col("sch_version") != 0) & (F.col("uploadcount") == 0)
    return (
        lookup_join(rows, top, on, "left", schedule)
        .withColumn(
            "uploadcount",
            F.when(missing, F.coalesce("_top", "uploadcount")).otherwise(
                F.col("uploadcount")
            ),
        )
        .drop("_top")
    )


def resolve_ad(
    rows: DataFrame, ad_info: DataFrame, schedule: DataFrame, by_day: bool = False
) -> DataFrame:
    """Add ``adcontent``: by ad_content_id where there is one, else by city and plan (and
    date). Both lists are made unique first, taking the greatest name of a key."""
    by_id = (
        ad_info.where(F.col("adcontent") != "")
        .groupBy(F.col("adcontent_id").alias("ad_content_id"))
        .agg(F.max("adcontent").alias("_by_id"))
    )
    by_plan = schedule.where(F.col("adcontent") != "").groupBy(
        "citycode", F.col("plnid").alias("plninfo"), *_day_key(by_day)
    ).agg(F.max("adcontent").alias("_by_plan"))
    plan_key = ["citycode", "plninfo"] + (["time"] if by_day else [])
    no_id = F.col("ad_content_id").isNull() | (F.col("ad_content_id") == "NULL")
    named = lookup_join(rows, by_id, ["ad_content_id"], "left", ad_info)
    return (
        lookup_join(named, by_plan, plan_key, "left", schedule)
        .withColumn(
            "adcontent", F.when(no_id, F.col("_by_plan")).otherwise(F.col("_by_id"))
        )
        .drop("_by_id", "_by_plan")
    )


def schedule_rows(schedule: DataFrame) -> DataFrame:
    """Schedule without repeated rows."""
    return schedule.select(
        "buildinglist", "buildinglistdate", "citycode", "plnid", "adcontent",
        "nplseqno", "nplinnerseqno", "uploadcount", "adlength",
    ).distinct()


def latest_location(location: DataFrame) -> DataFrame:
    """Installed rows that carry their device's latest update; equal latest rows are kept."""
    w = Window.partitionBy("devid").orderBy(F.col("update_time").desc())
    return (
        location.withColumn("_rank", F.rank().over(w))
        .where((F.col("_rank") == 1) & (F.col("install_status") == "已安装"))
        .drop("_rank")
        .distinct()
    )


def drop_roaming(scans: DataFrame, macs: DataFrame) -> DataFrame:
    """Drop scans of the listed macs."""
    return spread_join(scans, macs, ["mac"], "left_anti")


def _day_key(by_day: bool) -> list[Column]:
    return [F.col("buildinglistdate").alias("time")] if by_day else []
