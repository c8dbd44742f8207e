"""Planned plays of ads and the flow of people per number of planned plays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.operators.clean import backfill_batch, resolve_ad, schedule_rows, vendor_flag
from footfall.operators.spread import lookup_join

# Plays a day when the frequency of a version is unknown.
DEFAULT_FREQUENCY = 60


def best_frequency(building_list: DataFrame, by_package: bool = False) -> DataFrame:
    """Base frequency at the greatest total ad length of each city, version and batch.

    Different frequencies at that length are all kept. With ``by_package`` the greatest
    length is taken per package and every package keeps its row.
    """
    key = ["citycode", "buildinglist", "uploadcount"]
    group = key + (["packagecode"] if by_package else [])
    # One row per frequency, at the greatest length it has: the window sees no more.
    lists = (
        building_list.where(F.col("sumadlength").isNotNull())
        .groupBy(*group, "basefrequency")
        .agg(F.max("sumadlength").alias("_longest"))
    )
    w = Window.partitionBy(*group).orderBy(F.col("_longest").desc())
    return (
        lists.withColumn("_rank", F.rank().over(w))
        .where(F.col("_rank") == 1)
        .select(*key, "basefrequency")
    )


def planned_plays(
    schedule: DataFrame, building_list: DataFrame | None = None
) -> DataFrame:
    """Planned plays a day per city, date, version, batch and ad: distinct slots times the
    base frequency. Without ``building_list`` every slot counts the default frequency."""
    slots = (
        schedule_rows(schedule)
        .groupBy("citycode", "buildinglistdate", "buildinglist", "uploadcount", "adcontent")
        .agg(F.count(F.lit(1)).alias("_slots"))
    )
    frequency = F.lit(DEFAULT_FREQUENCY)
    if building_list is not None:
        slots = slots.join(
            best_frequency(building_list),
            ["citycode", "buildinglist", "uploadcount"],
            "left",
        )
        frequency = F.coalesce(F.col("basefrequency"), frequency)
    return slots.select(
        "citycode", "buildinglistdate", "buildinglist", "uploadcount", "adcontent",
        (F.col("_slots") * frequency).alias("play_nums"),
    )


def full_flow(
    views: DataFrame,
    schedule: DataFrame,
    building_list: DataFrame,
    ad_info: DataFrame,
    factory: DataFrame,
    by_day: bool = False,
    ignore_case: bool = True,
) -> DataFrame:
    """People and person-times per city and number of planned plays of the ad they saw,
    before (nofake_*) and after (fake_*) the vendor test.

    For one day pass that day's views and schedule; for a range set ``by_day`` and each view
    is matched with the schedule of its own date. Views are first counted per mac and slot,
    and from there on only those counts are joined and summed.
    """
    attributes = ["citycode", "city_name", "mac", "sch_version", "uploadcount", "plninfo",
                  "ad_content_id"] + (["time"] if by_day else [])
    seen = (
        views.where(F.col("sch_version").isNotNull() & F.col("mac").isNotNull())
        .groupBy(*attributes)
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    seen = resolve_ad(seen, ad_info, schedule, by_day)
    seen = backfill_batch(seen, schedule, by_day)
    planned = planned_plays(schedule, building_list).withColumnsRenamed(
        {"buildinglist": "sch_version", "buildinglistdate": "time"}
    )
    on = ["citycode", "sch_version", "uploadcount", "adcontent"]
    if by_day:
        on.append("time")
    else:
        planned = planned.drop("time")
    per_mac = (
        lookup_join(seen, planned, on, "inner", (schedule, building_list))
        .groupBy("city_name", "play_nums", "mac")
        .agg(F.sum("_times").alias("_times"))
    )
    # Rows without a city have no figures after the vendor test.
    genuine = F.when(F.col("genuine") & F.col("city_name").isNotNull(), F.col("_times"))
    return (
        vendor_flag(per_mac, factory, ignore_case)
        .groupBy("city_name", "play_nums")
        .agg(
            F.count("mac").alias("nofake_nums"),
            F.sum("_times").alias("nofake_times"),
            F.nullif(F.count(genuine), F.lit(0)).alias("fake_nums"),
            F.sum(genuine).alias("fake_times"),
        )
    )
