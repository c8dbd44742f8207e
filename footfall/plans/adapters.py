"""Views of the given tables in the shape of the logs and lists the operators read.

Numbering of the stand-ins: a device's number ``n`` gives its city n % 5, its prefix n % 7 and
its schedule version 100 + n / 3 (100000 + n / 3 in the packed form). Part p is slot (p % 60) / 10 of batch 1 + (p % 60) / 5 % 2 in
city p % 5 of version 100 + p / 60, so scans, plays and schedules meet on the same slots.
Event times run five times as fast as logged, which packs the 30 days into six.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.times import DAY, day_of
from footfall.operators.spread import source_bytes

BASE = 1704067200  # 2024-01-01 00:00:00 UTC
DAYS = 7

# Bytes of the part table's files whose schedule rows one task makes.
PART_BYTES = 512 * 1024

# Columns read from each table. Given up front, so that no job runs to infer a schema.
SCHEMAS = {
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double",
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey long, s_name string, s_nationkey int",
    "part": "p_partkey long, p_brand string, p_type string, p_size int",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_returnflag string",
}


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by))


def _devid(n: Column) -> Column:
    return F.concat(F.lpad((n % 7).cast("string"), 4, "0"), F.lpad(n.cast("string"), 8, "0"))


def _moments(spark: SparkSession, sf: str) -> DataFrame:
    """Events on the packed clock with their device number."""
    events = _read(spark, sf, "events")
    t = F.unix_seconds("ts")
    return events.select(
        "event_id", "user_id", "event_type", "value",
        (BASE + _div(t - BASE, 5)).alias("t"),
        (_div(F.col("user_id") * 2, 3) + F.col("event_id") % 3).alias("n"),
    )


def _mac() -> Column:
    head = F.when(F.col("user_id") % 2 == 0, "ab").otherwise("AB")
    vendor = F.lpad((F.col("user_id") % 16).cast("string"), 4, "0")
    return F.concat(head, vendor, F.lpad(F.col("user_id").cast("string"), 6, "0"))


def _log(spark: SparkSession, sf: str) -> DataFrame:
    """Scan log with city code, ad and device style. An event is a visit of 1 to 4 scans."""
    visits = _moments(spark, sf).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("event_id") % 4)).alias("j")
    ).withColumn("scan_time", F.col("t") + F.col("j") * 50)
    t, n, e = F.col("scan_time"), F.col("n"), F.col("event_id")
    half = _div(t, DAY // 2) % 2
    slot = _div(t, 60) % 6
    part = _div(n, 3) * 60 + n % 5 + half * 5 + slot * 10
    kind = F.col("event_type")
    return visits.select(
        day_of(t).alias("time"),
        _devid(n).alias("devid"),
        F.concat(F.lit("ic"), n.cast("string")).alias("iccid"),
        F.concat(F.lit("sn"), n.cast("string"), F.lit("_"),
                 F.when(e % 5 == 0, "b").otherwise("a")).alias("inner_sn"),
        _mac().alias("mac"),
        F.concat(F.lit("pl"), (part % 97).cast("string")).alias("plninfo"),
        F.when(e % 50 == 1, 0).otherwise(100 + _div(n, 3)).cast("int").alias("sch_version"),
        F.when(e % 10 == 0, 0).otherwise(1 + half).cast("int").alias("uploadcount"),
        (1 + slot % 3).cast("int").alias("pls_index"),
        (1 + _div(slot, 3)).cast("int").alias("play_index"),
        "scan_time",
        F.floor("value").cast("int").alias("signal"),
        F.when(kind == "error", "1").otherwise("0").alias("is_ap"),
        F.concat(F.lit("c"), (n % 5).cast("string")).alias("citycode"),
        F.when(kind == "signup", F.lit(None)).when(kind == "view", "NULL")
        .otherwise(F.concat(F.lit("a"), (part % 97).cast("string"))).alias("ad_content_id"),
        F.when(n % 4 == 0, "[智能]").when(n % 2 == 0, "[智能互动]22")
        .otherwise("[互动]19").alias("device_style"),
    )


def scan_log(spark: SparkSession, sf: str) -> DataFrame:
    return _log(spark, sf).drop("citycode", "ad_content_id", "device_style")


def view_info(spark: SparkSession, sf: str) -> DataFrame:
    """Enriched scan log. Devices whose number ends in 9 have no city name."""
    regions = _read(spark, sf, "region").select(
        F.concat(F.lit("c"), F.col("r_regionkey").cast("string")).alias("citycode"),
        F.col("r_name").alias("_name"),
    )
    return (
        _log(spark, sf)
        .join(regions, "citycode", "left")
        .withColumn("city_name", F.when(~F.col("devid").endswith("9"), F.col("_name")))
        .drop("_name")
    )


def location(spark: SparkSession, sf: str) -> DataFrame:
    """Two dated snapshots with one to three updates per device."""
    n = F.col("s_suppkey")
    regions = _read(spark, sf, "region")
    nations = _read(spark, sf, "nation")
    k = F.col("k")
    return (
        _read(spark, sf, "supplier")
        .withColumn("_city", n % 5)
        .join(regions.withColumn("_city", F.col("r_regionkey").cast("long")), "_city")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            "*", F.explode(F.sequence(F.lit(0).cast("long"), n % 3)).alias("k"),
        )
        .select("*", F.explode(F.array(F.lit(5), F.lit(6))).alias("snap"))
        .select(
            F.date_from_unix_date(F.lit(BASE // DAY) + F.col("snap") - 1).alias("time"),
            _devid(n).alias("devid"),
            F.concat(F.lit("b"), (n % 37).cast("string")).alias("building_no"),
            F.concat("n_name", F.lit("-"), (n % 4 + k).cast("string")).alias("building_name"),
            F.concat(F.lit("c"), (n % 5).cast("string")).alias("citycode"),
            F.when(n % 10 == 3, "北京索迪").when(F.col("r_name") == "ASIA", "北京")
            .otherwise(F.col("r_name")).alias("city_name"),
            F.concat(F.lit("d"), (n % 3).cast("string")).alias("district_name"),
            F.when(n % 6 == 5, F.lit("")).otherwise(F.concat(F.lit("kit"), (n % 6).cast("string")))
            .alias("suit_kind"),
            F.col("n_name").alias("install_name"),
            F.when((n % 10 == 9) | ((n % 7 == 2) & (k == 2)), "已拆除").otherwise("已安装")
            .alias("install_status"),
            F.when(n % 4 == 0, "[智能]").when(n % 2 == 0, "[智能互动]22")
            .otherwise("[互动]19").alias("device_style"),
            F.when(n % 8 == 7, "海报").otherwise("液晶").alias("devicekind"),
            (BASE - DAY * (30 - k)).alias("update_time"),
        )
    )


def mac_factory(spark: SparkSession, sf: str) -> DataFrame:
    """Vendor prefixes, several rows each; prefixes from 10 up and some others have no name."""
    n = F.col("s_suppkey")
    named = (n % 16 < 10) & (_div(n, 16) % 3 != 1)
    return _read(spark, sf, "supplier").select(
        F.concat(F.lit("ab"), F.lpad((n % 16).cast("string"), 4, "0")).alias("mac_index_factory"),
        F.when(named, F.col("s_name")).alias("factory_name"),
    )


def schedule_days(spark: SparkSession, sf: str) -> DataFrame:
    """Schedule by day: each part's slot on four to seven dates, some rows repeated. A part is few
    bytes and makes up to 14 rows, so parts are dealt to tasks by their number first."""
    p = F.col("p_partkey")
    parts = _read(spark, sf, "part").select("p_partkey", "p_size")
    tasks = source_bytes(parts) // PART_BYTES + 1
    if tasks > 1:
        parts = parts.repartition(tasks, "p_partkey")
    r = p % 60
    k = F.col("k")
    return (
        parts.select(
            "p_partkey", "p_size",
            F.explode(F.sequence(F.lit(0).cast("long"), DAYS - 1 - p % 4)).alias("d"),
        )
        .select("*", F.explode(F.sequence(F.lit(0), F.col("p_size") % 2)).alias("k"))
        .select(
            F.date_from_unix_date((F.lit(BASE // DAY) + F.col("d")).cast("int"))
            .alias("buildinglistdate"),
            (100 + _div(p, 60)).cast("int").alias("buildinglist"),
            F.concat(F.lit("c"), (r % 5).cast("string")).alias("citycode"),
            (1 + _div(r, 5) % 2).cast("int").alias("uploadcount"),
            (1 + _div(r, 10) % 3).cast("int").alias("nplseqno"),
            (1 + _div(r, 30)).cast("int").alias("nplinnerseqno"),
            F.concat(F.lit("pl"), (p % 97).cast("string")).alias("plnid"),
            F.concat(F.lit("ad"), (p % 97).cast("string"), F.lit(".avi")).alias("adcontent"),
            F.concat(F.lit("cust"), (p % 97 % 20).cast("string")).alias("adcustomer"),
            F.concat(F.lit("prod"), (p % 97 % 33).cast("string")).alias("adproduct"),
            (30 * (1 + F.col("p_size") % 3)).cast("string").alias("adlength"),
        )
    )


def building_list(spark: SparkSession, sf: str) -> DataFrame:
    """Package lists with base frequencies. City 4 is listed under a code of its own."""
    p = F.col("l_partkey")
    r = p % 60
    return _read(spark, sf, "lineitem").select(
        (100 + _div(p, 60)).cast("int").alias("buildinglist"),
        F.concat(F.lit("c"), F.when(r % 5 == 4, 9).otherwise(r % 5).cast("string")).alias("citycode"),
        F.col("l_returnflag").alias("packagecode"),
        (1 + _div(r, 5) % 2).cast("int").alias("uploadcount"),
        F.when(F.col("l_linenumber") != 7, F.floor("l_quantity").cast("int")).alias("sumadlength"),
        (F.col("l_linenumber") * 10).cast("int").alias("basefrequency"),
    )


def ad_info(spark: SparkSession, sf: str) -> DataFrame:
    """Ad ids and names; the names of ads above 90 are empty."""
    p = F.col("p_partkey") % 97
    name = F.concat(F.lit("ad"), p.cast("string"), F.lit(".avi"))
    return _read(spark, sf, "part").select(
        F.concat(F.lit("a"), p.cast("string")).alias("adcontent_id"),
        F.when(p <= 90, name).otherwise("").alias("adcontent"),
    ).distinct()


def ad_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ad names (with another extension) and ids of the play log; above 90 under other names."""
    p = F.col("p_partkey") % 97
    head = F.when(p <= 90, "ad").otherwise("old")
    return _read(spark, sf, "part").select(
        F.concat(head, p.cast("string"), F.lit(".wmv")).alias("adcontent"),
        F.concat(F.lit("a"), p.cast("string")).alias("adid"),
    ).distinct()


def play_log(spark: SparkSession, sf: str) -> DataFrame:
    """Logged plays of one to eight minutes, from order lines."""
    n, o, p, ln = (F.col(c) for c in ("l_suppkey", "l_orderkey", "l_partkey", "l_linenumber"))
    spot = (o * 7919 + p * 104729 + ln.cast("long") * 15485863) % (6 * DAY)
    lines = _read(spark, sf, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_partkey", "l_linenumber", spot.alias("spot")
    )
    slot = p % 6
    half = _div(F.col("spot"), DAY // 2) % 2
    part = _div(n, 3) * 60 + n % 5 + half * 5 + slot * 10
    start = (BASE + F.col("spot")) * 1000 + o % 1000
    return lines.select(
        day_of(BASE + F.col("spot")).alias("time"),
        _devid(n).alias("devid"),
        F.concat(F.lit("ic"), n.cast("string")).alias("iccid"),
        F.concat(F.lit("sn"), n.cast("string"), F.lit("_a")).alias("inner_sn"),
        F.when(ln % 2 == 0, "m").otherwise("s").alias("master"),
        F.concat(F.lit("pl"), (part % 97).cast("string")).alias("pid"),
        start.alias("start_ms"),
        (start + ln.cast("long") * 60000 + 60000).alias("end_ms"),
        F.when(ln == 7, "0").otherwise(
            F.concat((100_000 + _div(n, 3)).cast("string"), F.lpad((1 + half).cast("string"), 2, "0"))
        ).alias("sv"),
        (1 + slot % 3).cast("int").alias("pi"),
        (1 + _div(slot, 3)).cast("int").alias("idx"),
        F.concat(F.lit("ad"), (part % 97).cast("string"), F.lit(".mp4")).alias("vfn"),
        (100 + _div(n, 3)).cast("int").alias("sch_version"),
        (1 + half).cast("int").alias("uploadcount"),
        (1 + slot % 3).cast("int").alias("pls_index"),
        (1 + _div(slot, 3)).cast("int").alias("play_index"),
        F.concat(F.lit("pl"), (part % 97).cast("string")).alias("plninfo"),
        F.concat(F.lit("c"), (n % 5).cast("string")).alias("citycode"),
    )


def slot_schedule(spark: SparkSession, sf: str) -> DataFrame:
    """Older schedule form with a validity span per entry."""
    p = F.col("p_partkey")
    r = p % 60
    return _read(spark, sf, "part").select(
        (100_000 + _div(p, 60)).cast("string").alias("building_list"),
        (1 + _div(r, 10) % 3).cast("int").alias("npl_seqno"),
        (1 + _div(r, 30)).cast("int").alias("npl_playindex"),
        F.concat(F.lit("pl"), (p % 97).cast("string")).alias("pln_id"),
        F.when(p % 13 != 0, F.concat(F.lit("a"), (p % 97).cast("string"))).alias("ad_content_id"),
        (30 * (1 + F.col("p_size") % 3)).cast("int").alias("ad_length"),
        F.date_from_unix_date((F.lit(BASE // DAY) + p % 5 - 2).cast("int")).alias("start_time"),
        F.date_from_unix_date((F.lit(BASE // DAY) + 2 + p % 6).cast("int")).alias("end_time"),
        F.when(p % 9 == 0, "1").otherwise("0").alias("daybefore"),
        F.when(p % 4 == 0, "1").otherwise("2").alias("screen"),
        F.concat(F.lit("c"), (r % 5).cast("string")).alias("city"),
    )


def videos(spark: SparkSession, sf: str) -> DataFrame:
    """Ad ids with content, customer and product."""
    p = F.col("p_partkey")
    return _read(spark, sf, "part").select(
        F.concat(F.lit("a"), (p % 97).cast("string")).alias("ad_content_id"),
        F.concat(F.lit("ad"), (p % 97).cast("string"), F.lit(".avi")).alias("adcontent"),
        F.col("p_brand").alias("adcustomer"),
        F.col("p_type").alias("adproduct"),
    )


def ad_play_info(spark: SparkSession, sf: str) -> DataFrame:
    """Plays with the name of their device's city; devices ending in 9 have none."""
    regions = _read(spark, sf, "region").select(
        F.concat(F.lit("c"), F.col("r_regionkey").cast("string")).alias("citycode"),
        F.col("r_name").alias("city_name"),
    )
    return play_log(spark, sf).join(regions, "citycode").select(
        "time", "citycode",
        F.when(~F.col("devid").endswith("9"), F.col("city_name")).alias("city_name"),
        "devid", "inner_sn", "sch_version", "uploadcount",
    )


def face_log(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases stand for faces seen by the device."""
    return _moments(spark, sf).where(F.col("event_type") == "purchase").select(
        day_of(F.col("t")).alias("time"), F.col("event_id").alias("logid"),
        _devid(F.col("n")).alias("devid"), F.col("t").alias("starttime"),
    )


def probes(spark: SparkSession, sf: str) -> DataFrame:
    """Sign-ups stand for the moments to look at."""
    return _moments(spark, sf).where(F.col("event_type") == "signup").select(
        F.col("event_id").alias("probe_id"), _devid(F.col("n")).alias("devid"),
        (F.col("t") + 7).alias("at"),
    )


def building_control(spark: SparkSession, sf: str) -> DataFrame:
    """Buildings with their devices on every date of the newest location snapshot."""
    places = location(spark, sf).where(F.col("install_status") == "已安装")
    return places.select(
        "building_name", "devid",
        F.explode(F.sequence(F.date_sub("time", 2), F.col("time"))).alias("time"),
    ).distinct()


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """Panel members: macs that viewed, with id and the prefix of the device they viewed at."""
    return _moments(spark, sf).where(F.col("event_type") == "view").select(
        F.lower(_mac()).alias("mac"), F.col("user_id").cast("string").alias("id"),
        F.substring(_devid(F.col("n")), 1, 4).alias("city"),
    ).distinct()


def panel_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Sampled (device, mac) pairs: those with a click or a view."""
    return _moments(spark, sf).where(F.col("event_type").isin("click", "view")).select(
        _devid(F.col("n")).alias("devid"), _mac().alias("mac"),
    ).distinct()


def building_type(spark: SparkSession, sf: str) -> DataFrame:
    """Building type per city and place name."""
    regions = _read(spark, sf, "region")
    nations = _read(spark, sf, "nation")
    key = F.col("n_nationkey")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.when(F.col("r_name") == "ASIA", "北京").otherwise(F.col("r_name")).alias("city"),
        F.when(key % 3 == 0, "办公楼").when(key % 3 == 1, "公寓楼").otherwise("商场")
        .alias("big_category"),
        F.col("n_name").alias("installed"),
    )
