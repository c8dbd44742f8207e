"""City, device and building figures.

Facts are reduced to the key a lookup needs before they meet it, so joins carry one row per
device, plan or mac rather than one per scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.scalars import city_alias, short_version
from footfall.operators.clean import device_city, latest_location, vendor_flag
from footfall.operators.exposures import arrivals, exposures
from footfall.operators.fullflow import best_frequency
from footfall.operators.spread import lookup_join


def with_city(rows: DataFrame, location: DataFrame) -> DataFrame:
    """Left join of rows with one (aliased) city and building per device."""
    places = device_city(location).withColumn("city_name", city_alias(F.col("city_name")))
    return lookup_join(rows, places, ["devid"], "left", location)


def with_building(scans: DataFrame, location: DataFrame) -> DataFrame:
    """Scans of devices whose latest location is in service, with its city and building."""
    places = latest_location(location).select("devid", "building_name", "city_name").distinct()
    return lookup_join(scans, places, ["devid"], "inner", location)


def city_play_totals(plays: DataFrame, location: DataFrame) -> DataFrame:
    """Plays, devices and played seconds per city."""
    per_device = plays.groupBy("devid").agg(
        F.count(F.lit(1)).alias("_plays"),
        F.sum(_whole_seconds("end_ms") - _whole_seconds("start_ms")).alias("_seconds"),
    )
    return (
        with_city(per_device, location)
        .where(F.col("city_name").isNotNull())
        .groupBy("city_name")
        .agg(
            F.sum("_plays").alias("playtimes"),
            F.count("devid").alias("devnums"),
            F.sum("_seconds").alias("allplay_length_real"),
        )
    )


def city_scan_totals(scans: DataFrame, location: DataFrame) -> DataFrame:
    """Scans and distinct macs per city; scans of unknown devices form a null city."""
    per_pair = scans.groupBy("devid", "mac").agg(F.count(F.lit(1)).alias("_n"))
    return (
        with_city(per_pair, location)
        .groupBy("city_name", "mac")
        .agg(F.sum("_n").alias("_n"))
        .groupBy("city_name")
        .agg(F.sum("_n").alias("maccount"), F.count("mac").alias("single_maccount"))
    )


def valid_schedule(schedule: DataFrame, day: Column) -> DataFrame:
    """Schedule entries whose validity span holds the day."""
    return schedule.where((F.col("start_time") <= day) & (F.col("end_time") >= day))


def plan_ads(schedule: DataFrame) -> DataFrame:
    """Ads of each plan: (plninfo, ad_content_id, ad_length)."""
    return schedule.groupBy(F.col("pln_id").alias("plninfo"), "ad_content_id").agg(
        F.max("ad_length").alias("ad_length")
    )


def slot_ads(schedule: DataFrame) -> DataFrame:
    """One ad per slot and city of today's entries for the second screen."""
    return (
        schedule.where((F.col("daybefore") == "0") & (F.col("screen") == "2"))
        .groupBy(
            "city",
            F.col("building_list").alias("sch_version"),
            F.col("npl_seqno").alias("pls_index"),
            F.col("npl_playindex").alias("play_index"),
            F.col("pln_id").alias("plninfo"),
        )
        .agg(
            F.max("ad_content_id").alias("ad_content_id"),
            F.max("ad_length").alias("ad_length"),
        )
        .where(F.col("ad_content_id").isNotNull())
        .drop("city")
    )


def city_multi_distinct(
    scans: DataFrame, location: DataFrame, schedule: DataFrame, videos: DataFrame
) -> DataFrame:
    """Per city the macs, buildings and devices seen and the customers, brands and
    creatives shown. ``schedule`` holds the entries valid on the day."""
    placed = with_city(
        scans.select("devid", "mac", "plninfo").distinct(), location
    ).where(F.col("city_name").isNotNull() & (F.col("city_name") != ""))
    people = placed.groupBy("city_name").agg(
        F.countDistinct("mac").alias("personnums"),
        F.countDistinct("building_name").alias("buildnums"),
        F.countDistinct("devid").alias("devnums"),
    )
    ads = (
        placed.select("city_name", "plninfo").distinct()
        .join(plan_ads(schedule), "plninfo", "inner")
        .join(videos.select("ad_content_id", "adcustomer", "adproduct", "adcontent").distinct(),
              "ad_content_id", "inner")
        .groupBy("city_name")
        .agg(
            F.countDistinct("adcustomer").alias("customernums"),
            F.countDistinct("adproduct").alias("brandnums"),
            F.countDistinct("adcontent").alias("createnums"),
        )
    )
    zero = {"customernums": 0, "brandnums": 0, "createnums": 0}
    return people.join(ads, "city_name", "left").fillna(zero)


def city_ad_length(
    scans: DataFrame, location: DataFrame, schedule: DataFrame
) -> DataFrame:
    """Total length of the distinct ads of a city, each at its greatest length."""
    city_plans = (
        with_city(scans.select("devid", "plninfo").distinct(), location)
        .where(F.col("city_name").isNotNull() & (F.col("city_name") != ""))
        .select("city_name", "plninfo")
        .distinct()
    )
    return (
        city_plans.join(plan_ads(schedule), "plninfo", "left")
        .groupBy("city_name", "ad_content_id")
        .agg(F.max("ad_length").alias("_len"))
        .groupBy("city_name")
        .agg(F.sum("_len").alias("total_len"))
    )


def city_plays(plays: DataFrame, location: DataFrame) -> DataFrame:
    """Distinct plays of touch-screen devices, counted per city, device and slot."""
    rows = (
        plays.where(F.col("sv") != "0")
        .select("devid", "inner_sn", "master", "pid", "start_ms", "end_ms", "sv", "pi", "idx")
        .distinct()
        .groupBy(
            "devid",
            F.col("pid").alias("plninfo"),
            short_version(F.col("sv")).alias("sch_version"),
            F.col("pi").alias("pls_index"),
            F.col("idx").alias("play_index"),
        )
        .agg(F.count(F.lit(1)).alias("_plays"))
    )
    touch = location.where(F.substring("device_style", 1, 6) == "[智能互动]")
    return with_city(rows, touch).where(
        F.col("city_name").isNotNull() & (F.col("city_name") != "")
    )


def city_ad_length_raw(
    plays: DataFrame, location: DataFrame, schedule: DataFrame
) -> DataFrame:
    """Summed ad length of all scheduled plays of a city."""
    shown = _scheduled(city_plays(plays, location), schedule)
    return shown.groupBy("city_name").agg(
        F.sum(F.col("_plays") * F.col("ad_length").cast("double")).alias("ad_totallen")
    )


def city_report(
    plays: DataFrame,
    scans: DataFrame,
    location: DataFrame,
    schedule: DataFrame,
    videos: DataFrame,
    factory: DataFrame,
    gap: int = 150,
) -> DataFrame:
    """City report: devices, buildings, ad length, customers, brands and creatives from the
    plays; people and person-times, before and after the vendor test, from the scans."""
    played = city_plays(plays, location)
    places = (
        played.select("city_name", "devid", "building_name").distinct()
        .groupBy("city_name")
        .agg(
            F.countDistinct("devid").alias("devcount"),
            F.countDistinct("building_name").alias("buildcount"),
        )
    )
    shown = (
        _scheduled(played, schedule)
        .groupBy("city_name", "ad_content_id")
        .agg(F.sum(F.col("_plays") * F.col("ad_length").cast("double")).alias("_length"))
    )
    length = shown.groupBy("city_name").agg(F.sum("_length").alias("ad_totallen"))
    ads = (
        shown.join(
            videos.select("ad_content_id", "adcustomer", "adproduct", "adcontent").distinct(),
            "ad_content_id",
            "inner",
        )
        .groupBy("city_name")
        .agg(
            F.countDistinct("adcustomer").alias("city_adcustomer_nums"),
            F.countDistinct("adproduct").alias("city_adproduct_nums"),
            F.countDistinct("adcontent").alias("city_adcontent_nums"),
        )
    )
    touch = location.where(F.substring("device_style", 1, 6) == "[智能互动]")
    return (
        places.join(length, "city_name", "left")
        .join(ads, "city_name", "left")
        .join(city_exposures(scans, touch, factory, gap), "city_name", "left")
        .select(
            "city_name", "devcount", "buildcount", "ad_totallen", "city_adcustomer_nums",
            "city_adproduct_nums", "city_adcontent_nums", "nofake_maccount",
            "nofake_mactime", "fake_maccount", "fake_mactime",
        )
    )


def scheduled_plays(plays: DataFrame, schedule: DataFrame) -> DataFrame:
    """Each play with the ad that the schedule has for its slot."""
    slot = ["sch_version", "pls_index", "play_index", "plninfo"]
    return lookup_join(plays, slot_ads(schedule), slot, "inner", schedule)


def _scheduled(plays: DataFrame, schedule: DataFrame) -> DataFrame:
    """Plays, counted per city and slot, with the ads of the slot."""
    slot = ["sch_version", "pls_index", "play_index", "plninfo"]
    counted = plays.groupBy("city_name", *slot).agg(F.sum("_plays").alias("_plays"))
    return counted.join(slot_ads(schedule), slot, "inner")


def city_exposures(
    scans: DataFrame,
    location: DataFrame,
    factory: DataFrame,
    gap: int,
    boundary: str = "ge",
    ignore_case: bool = True,
) -> DataFrame:
    """People (distinct macs) and person-times (exposures, counted by date) per city, before the
    vendor test (nofake_*) and after it (fake_*, null where no genuine mac was seen)."""
    per_pair = (
        exposures(scans, gap, boundary=boundary)
        .groupBy("devid", "mac")
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    per_mac = (
        with_city(per_pair, location)
        .where(F.col("city_name").isNotNull())
        .groupBy("city_name", "mac")
        .agg(F.sum("_times").alias("_times"))
    )
    genuine = F.when(F.col("genuine"), F.col("_times"))
    return (
        vendor_flag(per_mac, factory, ignore_case)
        .groupBy("city_name")
        .agg(
            F.count("mac").alias("nofake_maccount"),
            F.sum("_times").alias("nofake_mactime"),
            F.nullif(F.count(genuine), F.lit(0)).alias("fake_maccount"),
            F.sum(genuine).alias("fake_mactime"),
        )
    )


def city_arrivals(
    scans: DataFrame, gap: int = 300, boundary: str = "gt", by: tuple[str, ...] = ()
) -> DataFrame:
    """Arrivals per city: those of pairs that came back on a date, the pairs that came once on
    it, and their sum. Cities that lack one of the two kinds are left out. ``by`` names columns,
    such as the date, that are kept apart."""
    a = F.col("arrivals")
    keys = list(dict.fromkeys((*by, "time", "city_name", "devid", "mac")))
    return (
        arrivals(scans, gap, keys, boundary)
        .groupBy(*by, "city_name")
        .agg(
            F.sum(F.when(a > 1, a)).alias("twoexpose"),
            F.sum(F.when(a == 1, F.lit(1).cast("long"))).alias("oneexpose"),
        )
        .where(F.col("twoexpose").isNotNull() & F.col("oneexpose").isNotNull())
        .withColumn("expose_times", F.col("twoexpose") + F.col("oneexpose"))
    )


def city_screen_report(
    scans: DataFrame,
    location: DataFrame,
    schedule: DataFrame,
    videos: DataFrame,
    factory: DataFrame,
    gap: int = 300,
    ignore_case: bool = True,
) -> DataFrame:
    """City report from scans alone: ``city_multi_distinct`` with arrivals before and after
    the vendor test, people after it, and the total length of the ads seen."""
    placed = with_city(
        scans.select("time", "devid", "mac", "scan_time").distinct(), location
    ).where(F.col("city_name").isNotNull() & (F.col("city_name") != ""))
    known = vendor_flag(placed, factory, ignore_case).where("genuine")
    people = known.groupBy("city_name").agg(F.countDistinct("mac").alias("fake_maccount"))
    before = city_arrivals(placed, gap).select(
        "city_name", F.col("expose_times").alias("nofake_expose_times")
    )
    after = city_arrivals(known, gap).select(
        "city_name", F.col("expose_times").alias("fake_exposetimes")
    )
    return (
        city_multi_distinct(scans, location, schedule, videos)
        .join(before, "city_name", "left")
        .join(people, "city_name", "left")
        .join(after, "city_name", "left")
        .join(city_ad_length(scans, location, schedule), "city_name", "left")
    )


def actual_plays(
    played: DataFrame, schedule: DataFrame, building_list: DataFrame
) -> DataFrame:
    """Plays per city: slots of the version's greatest batch times its base frequency,
    summed over devices and serials. Several packages of a version all count."""
    version = ["citycode", "sch_version", "uploadcount"]
    # Devices of one version and batch are alike from here on: count them, then look up.
    devices = (
        played.where(F.col("city_name").isNotNull())
        .groupBy("citycode", "devid", "inner_sn", "city_name", "sch_version")
        .agg(F.max("uploadcount").alias("uploadcount"))
        .groupBy("city_name", *version)
        .agg(F.count(F.lit(1)).alias("_devices"))
    )
    slots = (
        schedule.select(
            "citycode", F.col("buildinglist").alias("sch_version"), "uploadcount",
            "nplseqno", "nplinnerseqno",
        )
        .distinct()
        .groupBy(*version)
        .agg(F.count(F.lit(1)).alias("_slots"))
    )
    frequency = best_frequency(building_list, by_package=True).withColumnRenamed(
        "buildinglist", "sch_version"
    )
    return (
        devices.join(slots, version, "left")
        .join(frequency, version, "left")
        .groupBy("city_name")
        .agg(
            F.sum(F.col("_devices") * F.col("_slots") * F.col("basefrequency"))
            .alias("playtimes")
        )
    )


def device_exposures(exposed: DataFrame) -> DataFrame:
    """Exposures and distinct macs per device."""
    return (
        exposed.groupBy("devid", "mac")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("devid")
        .agg(F.sum("_n").alias("exposetime"), F.count("mac").alias("macnums"))
    )


def building_type_avg(
    exposed: DataFrame, devices: DataFrame, building_type: DataFrame
) -> DataFrame:
    """Exposures and macs per device, averaged per city and building type. ``devices`` are
    the latest locations of devices in service."""
    types = devices.select("devid", "city_name", "install_name").distinct().join(
        building_type.select(
            F.col("city").alias("city_name"),
            F.col("installed").alias("install_name"),
            "big_category",
        ).distinct(),
        ["city_name", "install_name"],
        "left",
    ).select("devid", "city_name", "big_category")
    return (
        device_exposures(exposed)
        .join(types, "devid", "left")
        .groupBy("city_name", "big_category")
        .agg(
            (F.sum("exposetime") / F.countDistinct("devid")).alias("avg_exposetime"),
            (F.sum("macnums") / F.countDistinct("devid")).alias("avg_macnums"),
        )
    )


def _whole_seconds(ms: str) -> Column:
    return F.floor(F.col(ms) / 1000).cast("long")
