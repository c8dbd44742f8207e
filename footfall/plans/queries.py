"""Every operator run over the given tables: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.functions import scalars, times
from footfall.operators import (
    attribution, citystats, clean, exposures as exp, fullflow, gapfill, plays, probes, reach,
)
from footfall.operators.spread import key_counts
from footfall.plans import adapters as a, jobs
from footfall.sources import sinks, tables

DAY = "2024-01-03"
FIRST, LAST = "2024-01-02", "2024-01-04"
RUN = "2024-01-05"
GAP = 1800
APPEND = 600
FLAG = 1800
MAX_SCANS = 12
BUILDING_KEYS = ["time", "city_name", "building_name", "mac"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _texts(fn(spark, sf))

    QUERIES[fn.__name__] = run
    return fn


def _texts(df: DataFrame) -> DataFrame:
    """Dates as text."""
    return df.select(
        *[F.col(c).cast("string").alias(c) if kind == "date" else F.col(c) for c, kind in df.dtypes]
    )


def _doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Counts that may be null, as doubles."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# --- scans, sources, sinks ----------------------------------------------------------------

@query
def scan_partition(spark, sf):
    return tables.scan_partition(a.scan_log(spark, sf), DAY).select(
        "time", "devid", "mac", "scan_time", "sch_version"
    )


@query
def scan_range(spark, sf):
    return tables.scan_range(a.scan_log(spark, sf), FIRST, LAST).groupBy("time").agg(
        F.count(F.lit(1)).alias("scans"), F.countDistinct("mac").alias("macs")
    )


@query
def scan_day_and_next(spark, sf):
    """Play log of two dates, and scans clipped to their own date."""
    two = tables.scan_days(a.play_log(spark, sf), [DAY, LAST])
    seen = tables.clip_to_day(a.scan_log(spark, sf))
    return two.groupBy("devid").agg(F.count(F.lit(1)).alias("plays")).join(
        seen.groupBy("devid").agg(F.count(F.lit(1)).alias("scans")), "devid", "inner"
    )


@query
def latest_snapshot(spark, sf):
    return tables.latest_snapshot(a.location(spark, sf)).select(
        "time", "devid", "city_name", "building_name", "install_status", "update_time"
    )


@query
def write_partition_roundtrip(spark, sf):
    path = f"{sinks.shared_folder(spark)}/footfall-{uuid4().hex}"
    rows = exp.exposures(a.scan_log(spark, sf), GAP, ["time", "devid", "mac"])
    sinks.write_partitions(rows, path, files=8)
    return spark.read.schema(rows.schema).parquet(path)


def _written_csv(spark, rows) -> str:
    """The folder of a table written as CSV with a header."""
    path = f"{sinks.shared_folder(spark)}/footfall-{uuid4().hex}"
    rows.write.option("header", True).csv(path)
    return path


def _stamp(ms):
    """Epoch milliseconds as a log writes them: seventeen digits."""
    second = F.call_function("div", ms, F.lit(1000))
    text = F.date_format(F.timestamp_seconds(second), times.PLAY_FORMAT)
    return F.concat(text, F.lpad(F.pmod(ms, F.lit(1000)).cast("string"), 3, "0"))


def _raw_scan_log(spark, sf):
    """The scan log as text, some of whose times cannot be read."""
    logged = a.scan_log(spark, sf).select(
        F.replace(F.col("time").cast("string"), F.lit("-"), F.lit("_")).alias("time"),
        "devid", "mac",
        F.when(F.col("is_ap") == "1", "unknown")
        .otherwise(times.seconds_text(F.col("scan_time"))).alias("scan_time"),
        F.col("sch_version").cast("string").alias("sch_version"),
    )
    path = _written_csv(spark, logged)
    text = "time string, devid string, mac string, scan_time string, sch_version string"
    return spark.read.csv(path, header=True, schema=text)


@query
def raw_scans(spark, sf):
    """Scan log from text, without the rows whose time cannot be read."""
    return tables.normalize_scans(_raw_scan_log(spark, sf))


@query
def raw_scans_checked(spark, sf):
    """What became of the rows of a scan log in text, per date: read, and kept or rejected."""
    accepted, rejected, _ = sinks.write_checked(
        tables.checked_scans(_raw_scan_log(spark, sf)), f"{sinks.shared_folder(spark)}/footfall-{uuid4().hex}"
    )
    outcomes = accepted.select("time", F.lit("accepted").alias("outcome")).unionByName(
        rejected.select("time", F.col("reject_reason").alias("outcome"))
    )
    return outcomes.groupBy("time").agg(
        F.count(F.lit(1)).alias("read"),
        F.count_if(F.col("outcome") == "accepted").alias("accepted"),
        F.count_if(F.col("outcome") == "unreadable scan_time").alias("unreadable"),
    )


@query
def exposures_bucketed(spark, sf):
    """Exposures from scans stored by date, bucketed and sorted by device and mac."""
    stored = sinks.write_bucketed(
        clean.spoof_filter(a.scan_log(spark, sf), a.mac_factory(spark, sf)),
        f"scans_{uuid4().hex}", f"{sinks.shared_folder(spark)}/footfall-{uuid4().hex}", 8,
        ["devid", "mac"],
    )
    return exp.exposures(stored, GAP)


@query
def raw_plays(spark, sf):
    """Play log from text, with packed versions and times of seventeen digits."""
    logged = a.play_log(spark, sf).select(
        "devid", "pid", _stamp(F.col("start_ms")).alias("st"), _stamp(F.col("end_ms")).alias("et"),
        "sv", F.col("pi").cast("string").alias("pi"), F.col("idx").cast("string").alias("idx"),
    )
    path = _written_csv(spark, logged)
    text = "devid string, pid string, st string, et string, sv string, pi string, idx string"
    played = tables.normalize_plays(spark.read.csv(path, header=True, schema=text))
    return played.select(
        "devid", "start_ms", "end_ms", "sch_version", "uploadcount", "pls_index", "play_index",
        "plninfo",
    )


@query
def probe_counts_by_control(spark, sf):
    """Counts around the moments of a control table in CSV."""
    at = F.col("at")
    control = a.probes(spark, sf).select(
        "probe_id", "devid",
        F.replace(times.day_of(at).cast("string"), F.lit("-"), F.lit(".")).alias("day"),
        F.substring(times.seconds_text(at), 12, 8).alias("clock"),
    )
    listed = tables.read_probes(spark, _written_csv(spark, control))
    return probes.probe_counts(listed, a.scan_log(spark, sf), a.face_log(spark, sf), MAX_SCANS)


@query
def probe_counts_pruned(spark, sf):
    """Counts around moments on the first dates, from logs partitioned by date of which only the
    moments' dates are read."""
    moments = a.probes(spark, sf).where(times.day_of(F.col("at")) <= F.to_date(F.lit(FIRST)))
    dates = moments.select(times.day_of(F.col("at")).alias("time"))

    def stored(rows):
        path = f"{sinks.shared_folder(spark)}/footfall-{uuid4().hex}"
        sinks.write_partitions(rows, path)
        return tables.scan_listed_days(spark.read.schema(rows.schema).parquet(path), dates)

    return probes.probe_counts(
        moments, stored(a.scan_log(spark, sf)), stored(a.face_log(spark, sf)), MAX_SCANS
    )


@query
def building_day_counts_by_control(spark, sf):
    """Counts in the buildings and dates of a control table in CSV."""
    places = a.location(spark, sf).where(F.col("install_status") == "已安装")
    control = places.select(
        "building_name", "devid",
        F.date_sub("time", 2).cast("string").alias("first"), F.col("time").cast("string").alias("last"),
    )
    listed = tables.read_buildings(spark, _written_csv(spark, control))
    return probes.building_day_counts(
        listed, a.scan_log(spark, sf), a.face_log(spark, sf), a.mac_factory(spark, sf), MAX_SCANS
    )


# --- cleaning -----------------------------------------------------------------------------

@query
def spoof_filter(spark, sf):
    return clean.spoof_filter(
        a.scan_log(spark, sf), a.mac_factory(spark, sf), ignore_case=False
    ).select("devid", "mac", "scan_time")


@query
def spoof_filter_ci(spark, sf):
    return clean.spoof_filter(a.scan_log(spark, sf), a.mac_factory(spark, sf)).select(
        "devid", "mac", "scan_time"
    )


@query
def active_devices(spark, sf):
    return clean.active_devices(
        a.location(spark, sf), not_status="已拆除", style_prefix="[智能互动]", devid_length=12,
        kind="液晶", styles=("[互动]", "[智能互动]"),
        cities=("北京", "AFRICA", "AMERICA", "EUROPE", "北京索迪"),
    ).select("time", "devid", "city_name", "update_time")


@query
def split_version(spark, sf):
    sv = F.col("sv")
    return a.play_log(spark, sf).select(
        "sv",
        scalars.version_part(sv).alias("version"),
        scalars.batch_part(sv).alias("batch"),
        scalars.short_version(F.concat(sv, F.lit("00"))).alias("short"),
    ).groupBy("sv", "version", "batch", "short").agg(F.count(F.lit(1)).alias("plays"))


@query
def batch_backfill(spark, sf):
    views = a.view_info(spark, sf)
    filled = clean.backfill_batch(views, _schedule_of(spark, sf, DAY))
    return filled.groupBy("citycode", "sch_version", "uploadcount").agg(
        F.count(F.lit(1)).alias("scans")
    )


@query
def batch_backfill_by_day(spark, sf):
    views = a.view_info(spark, sf)
    filled = clean.backfill_batch(views, a.schedule_days(spark, sf), by_day=True)
    return filled.groupBy("time", "citycode", "sch_version", "uploadcount").agg(
        F.count(F.lit(1)).alias("scans")
    )


@query
def resolve_ad(spark, sf):
    return clean.resolve_ad(
        a.view_info(spark, sf), a.ad_info(spark, sf), _schedule_of(spark, sf, DAY)
    ).select("devid", "mac", "scan_time", "plninfo", "ad_content_id", "adcontent")


@query
def schedule_dedupe(spark, sf):
    return clean.schedule_rows(a.schedule_days(spark, sf))


@query
def heavy_dev_mac(spark, sf):
    return clean.drop_heavy(a.scan_log(spark, sf), ["time", "devid", "mac"], MAX_SCANS).select(
        "time", "devid", "mac", "scan_time"
    )


@query
def heavy_building_mac(spark, sf):
    return clean.drop_heavy(_building_scans(spark, sf), BUILDING_KEYS, 20).select(
        *BUILDING_KEYS, "scan_time"
    )


@query
def weekly_mac_filter(spark, sf):
    return clean.roaming_macs(a.scan_log(spark, sf), 45, 6)


@query
def dominant_sn(spark, sf):
    return clean.dominant_serial(a.scan_log(spark, sf), ["time", "devid"]).select(
        "time", "devid", "inner_sn", "mac", "scan_time"
    )


@query
def panel_filter(spark, sf):
    devices = clean.active_devices(a.location(spark, sf), kind="液晶")
    return clean.panel_filter(
        tables.clip_to_day(a.scan_log(spark, sf)), a.panel(spark, sf), a.panel_pairs(spark, sf),
        devices,
    ).select("id", "devid", "mac", "scan_time")


def _schedule_of(spark, sf, day):
    return a.schedule_days(spark, sf).where(F.col("buildinglistdate") == F.to_date(F.lit(day)))


def _building_scans(spark, sf):
    return citystats.with_building(a.scan_log(spark, sf), _newest(spark, sf))


def _newest(spark, sf):
    return tables.latest_snapshot(a.location(spark, sf))


# --- joins --------------------------------------------------------------------------------

@query
def left_join_city(spark, sf):
    return citystats.with_city(
        a.scan_log(spark, sf).select("devid", "mac", "scan_time"), _newest(spark, sf)
    )


@query
def latest_location(spark, sf):
    return clean.latest_location(_newest(spark, sf)).select(
        "devid", "building_name", "city_name", "update_time"
    )


@query
def argmax_frequency(spark, sf):
    return fullflow.best_frequency(a.building_list(spark, sf))


@query
def argmax_frequency_package(spark, sf):
    return fullflow.best_frequency(a.building_list(spark, sf), by_package=True)


@query
def probe_window(spark, sf):
    scans = a.scan_log(spark, sf).select("devid", "mac", "scan_time")
    return probes.probe_window(a.probes(spark, sf), scans, 60, "scan_time")


@query
def schedule_valid_join(spark, sf):
    """Plays of the day with the ad of their slot among the entries valid on it."""
    played = tables.scan_partition(a.play_log(spark, sf), DAY).select(
        "devid", "pid", "start_ms",
        scalars.version_part(F.col("sv")).alias("sch_version"),
        F.col("pi").alias("pls_index"), F.col("idx").alias("play_index"),
        F.col("pid").alias("plninfo"),
    )
    return citystats.scheduled_plays(played, _valid(spark, sf)).select(
        "devid", "start_ms", "sch_version", "pls_index", "play_index", "plninfo",
        "ad_content_id", "ad_length",
    )


# --- city, device and building figures ----------------------------------------------------

@query
def city_play_totals(spark, sf):
    return citystats.city_play_totals(a.play_log(spark, sf), _newest(spark, sf))


@query
def city_play_report(spark, sf):
    """The play totals as a single CSV report, read back."""
    report = citystats.city_play_totals(a.play_log(spark, sf), _newest(spark, sf))
    path = f"{sinks.shared_folder(spark)}/footfall-{uuid4().hex}"
    sinks.write_report(report, path)
    return spark.read.csv(path, header=True, schema=report.schema)


@query
def realtime_play_totals(spark, sf):
    """Play totals of a run at a quarter past three in the afternoon."""
    second = F.call_function("div", F.col("start_ms"), F.lit(1000))
    hour = F.concat(
        F.replace(times.day_of(second).cast("string"), F.lit("-"), F.lit("_")), F.lit("_"),
        F.lpad(times.hour_of(second).cast("string"), 2, "0"),
    )
    first, end = tables.run_hours(dt.datetime.fromisoformat(f"{DAY} 15:15:00"))
    logged = a.play_log(spark, sf).withColumn("hour", hour)
    return citystats.city_play_totals(tables.scan_hours(logged, first, end), _newest(spark, sf))


@query
def city_scan_totals(spark, sf):
    return citystats.city_scan_totals(a.scan_log(spark, sf), _newest(spark, sf))


def _valid(spark, sf):
    return citystats.valid_schedule(a.slot_schedule(spark, sf), F.to_date(F.lit(DAY)))


@query
def city_multi_distinct(spark, sf):
    return citystats.city_multi_distinct(
        a.scan_log(spark, sf), _newest(spark, sf), _valid(spark, sf), a.videos(spark, sf)
    )


@query
def city_report(spark, sf):
    report = citystats.city_report(
        a.play_log(spark, sf), a.scan_log(spark, sf), _newest(spark, sf),
        _valid(spark, sf), a.videos(spark, sf), a.mac_factory(spark, sf), GAP,
    )
    return _doubles(
        report, "city_adcustomer_nums", "city_adproduct_nums", "city_adcontent_nums",
        "nofake_maccount", "nofake_mactime", "fake_maccount", "fake_mactime",
    )


@query
def city_screen_report(spark, sf):
    report = citystats.city_screen_report(
        a.scan_log(spark, sf), _newest(spark, sf), _valid(spark, sf), a.videos(spark, sf),
        a.mac_factory(spark, sf), 7200,
    )
    return _doubles(
        report, "nofake_expose_times", "fake_maccount", "fake_exposetimes", "total_len"
    )


@query
def city_ad_length(spark, sf):
    return _doubles(
        citystats.city_ad_length(a.scan_log(spark, sf), _newest(spark, sf), _valid(spark, sf)),
        "total_len",
    )


@query
def city_ad_length_raw(spark, sf):
    return citystats.city_ad_length_raw(
        a.play_log(spark, sf), _newest(spark, sf), _valid(spark, sf)
    )


@query
def planned_plays(spark, sf):
    return fullflow.planned_plays(a.schedule_days(spark, sf), a.building_list(spark, sf))


@query
def planned_plays_flat(spark, sf):
    return fullflow.planned_plays(a.schedule_days(spark, sf))


@query
def full_flow_day(spark, sf):
    flow = fullflow.full_flow(
        tables.scan_partition(a.view_info(spark, sf), DAY), _schedule_of(spark, sf, DAY),
        a.building_list(spark, sf), a.ad_info(spark, sf), a.mac_factory(spark, sf),
    )
    return _doubles(flow.select(F.lit(DAY).alias("day"), "*"), "fake_nums", "fake_times")


@query
def full_flow_range(spark, sf):
    schedule = a.schedule_days(spark, sf).withColumn("time", F.col("buildinglistdate"))
    flow = fullflow.full_flow(
        tables.scan_range(a.view_info(spark, sf), FIRST, LAST),
        tables.scan_range(schedule, FIRST, LAST).drop("time"),
        a.building_list(spark, sf), a.ad_info(spark, sf), a.mac_factory(spark, sf), by_day=True,
    ).select(F.lit(FIRST).alias("start_day"), F.lit(LAST).alias("end_date"), "*")
    return _doubles(flow, "fake_nums", "fake_times")


@query
def full_flow_previous_week(spark, sf):
    """The flow of the week before a run date."""
    schedule = a.schedule_days(spark, sf)
    flow = jobs.flow_before(
        a.view_info(spark, sf), schedule, a.building_list(spark, sf), a.ad_info(spark, sf),
        a.mac_factory(spark, sf), "2024-01-10", "week",
    )
    return _doubles(flow, "fake_nums", "fake_times")


@query
def full_flow_previous_month(spark, sf):
    """The flow of the month before a run date."""
    schedule = a.schedule_days(spark, sf)
    flow = jobs.flow_before(
        a.view_info(spark, sf), schedule, a.building_list(spark, sf), a.ad_info(spark, sf),
        a.mac_factory(spark, sf), "2024-02-15", "month",
    )
    return _doubles(flow, "fake_nums", "fake_times")


@query
def full_flow_day_by_case(spark, sf):
    """The flow of a day with vendor prefixes compared as they are written."""
    flow = fullflow.full_flow(
        tables.scan_partition(a.view_info(spark, sf), DAY), _schedule_of(spark, sf, DAY),
        a.building_list(spark, sf), a.ad_info(spark, sf), a.mac_factory(spark, sf),
        ignore_case=False,
    )
    return _doubles(flow.select(F.lit(DAY).alias("day"), "*"), "fake_nums", "fake_times")


@query
def city_arrivals(spark, sf):
    placed = a.view_info(spark, sf).where(F.col("city_name").isNotNull())
    return citystats.city_arrivals(placed, 300, by=("time",))


@query
def actual_plays(spark, sf):
    return _doubles(
        citystats.actual_plays(
            tables.scan_partition(a.ad_play_info(spark, sf), DAY), _schedule_of(spark, sf, DAY),
            a.building_list(spark, sf),
        ),
        "playtimes",
    )


@query
def building_type_avg(spark, sf):
    latest = clean.latest_location(_newest(spark, sf))
    devices = clean.active_devices(latest, styles=("互动",), devid_length=12)
    exposed = exp.exposures(clean.spoof_filter(a.scan_log(spark, sf), a.mac_factory(spark, sf)), GAP)
    return citystats.building_type_avg(exposed, devices, a.building_type(spark, sf))


@query
def device_exposures(spark, sf):
    return citystats.device_exposures(exp.exposures(a.scan_log(spark, sf), GAP))


# --- exposures and reach ------------------------------------------------------------------

def _genuine(spark, sf):
    return clean.spoof_filter(a.view_info(spark, sf), a.mac_factory(spark, sf))


PAIR = ["time", "devid", "mac"]
CITY_KEYS = ["time", "city_name", "devid", "mac"]


def _city_exposures(spark, sf):
    placed = _genuine(spark, sf).where(F.col("city_name").isNotNull())
    return exp.exposures(placed, GAP, CITY_KEYS)


@query
def scan_gaps(spark, sf):
    return exp.scan_gaps(a.scan_log(spark, sf))


@query
def exposures_multi(spark, sf):
    return exp.exposures_multi(a.scan_log(spark, sf), GAP, keys=PAIR)


@query
def exposures_single(spark, sf):
    return exp.exposures_single(a.scan_log(spark, sf), GAP, keys=PAIR)


@query
def exposures(spark, sf):
    return exp.exposures(a.scan_log(spark, sf), GAP)


@query
def exposures_strict(spark, sf):
    return exp.exposures(a.scan_log(spark, sf), 50, PAIR, boundary="gt")


@query
def exposures_city(spark, sf):
    return _city_exposures(spark, sf)


@query
def exposures_building(spark, sf):
    kept = clean.drop_heavy(_building_scans(spark, sf), BUILDING_KEYS, 20)
    return exp.exposures(kept, GAP, BUILDING_KEYS)


@query
def exposures_filtered(spark, sf):
    scans = a.scan_log(spark, sf)
    macs = clean.roaming_macs(scans, 45, 6)
    kept = clean.drop_roaming(tables.clip_to_day(scans, drop_ap=False), macs)
    return exp.exposures(kept, GAP, PAIR)


@query
def exposures_trailing_week(spark, sf):
    """Exposures of a run date without the macs that roamed in the seven days up to it."""
    return jobs.trailing_exposures(a.scan_log(spark, sf), RUN, GAP, 45, 6)


@query
def exposures_trailing_week_daily(spark, sf):
    """The same by a job that runs every day: earlier dates come from stored summaries."""
    scans = a.scan_log(spark, sf)
    path = f"{sinks.shared_folder(spark)}/footfall-{uuid4().hex}"
    jobs.store_summaries(scans.where(F.col("time") < F.to_date(F.lit(RUN))), path)
    return jobs.trailing_exposures_daily(path, scans, RUN, GAP, 45, 6)


@query
def exposures_trailing_week_flow(spark, sf):
    """The same for each of the seven days."""
    return jobs.trailing_exposures(a.scan_log(spark, sf), RUN, GAP, 45, 6, each_day=True)


@query
def city_exposures(spark, sf):
    return _doubles(
        citystats.city_exposures(
            a.scan_log(spark, sf), _newest(spark, sf), a.mac_factory(spark, sf), GAP
        ),
        "fake_maccount", "fake_mactime",
    )


@query
def freq_dist(spark, sf):
    return reach.freq_dist(exp.exposures(_genuine(spark, sf), GAP, PAIR), PAIR, ["time"])


@query
def freq_dist_city(spark, sf):
    return reach.freq_dist(_city_exposures(spark, sf), CITY_KEYS, ["time", "city_name"])


@query
def reach_curve(spark, sf):
    return reach.reach_curve(freq_dist(spark, sf), ["time"])


@query
def reach_curve_city(spark, sf):
    return reach.reach_curve(freq_dist_city(spark, sf), ["time", "city_name"])


@query
def reach_curve_city_sparse(spark, sf):
    return reach.reach_curve(freq_dist_city(spark, sf), ["time", "city_name"], compat_sparse=True)


@query
def reach_curve_city_ad(spark, sf):
    return reach.reach_by_ad(_genuine(spark, sf), a.ad_info(spark, sf))


@query
def date_windows(spark, sf):
    return times.date_windows(a.scan_log(spark, sf))


@query
def probe_counts(spark, sf):
    return probes.probe_counts(
        a.probes(spark, sf), a.scan_log(spark, sf), a.face_log(spark, sf), MAX_SCANS
    )


@query
def probe_counts_all_devices(spark, sf):
    return probes.probe_counts(
        a.probes(spark, sf), a.scan_log(spark, sf), a.face_log(spark, sf), MAX_SCANS,
        by_device=False,
    )


@query
def building_day_counts(spark, sf):
    return probes.building_day_counts(
        a.building_control(spark, sf), a.scan_log(spark, sf), a.face_log(spark, sf),
        a.mac_factory(spark, sf), MAX_SCANS,
    )


# --- rebuilt play log ---------------------------------------------------------------------

def _cycle(spark, sf):
    return plays.schedule_cycle(a.schedule_days(spark, sf))


def _sessions(spark, sf):
    return plays.play_sessions(_genuine(spark, sf), _cycle(spark, sf))


@query
def schedule_cycle(spark, sf):
    return _cycle(spark, sf)


@query
def play_sessions(spark, sf):
    return _sessions(spark, sf).select(
        "time", "devid", "citycode", *plays.SLOT, "start_ms", "end_ms", "is_seed"
    )


@query
def seed_plays(spark, sf):
    return plays.seed_plays(_sessions(spark, sf)).select(
        "time", "devid", "citycode", *plays.SLOT, "start_ms", "end_ms", "is_seed"
    )


def _per_slot(filled):
    """Filled plays per device, date and slot: how many, and the sums of their times."""
    return filled.groupBy(
        "time", "devid", "sch_version", "uploadcount", "pls_index", "play_index"
    ).agg(
        F.count(F.lit(1)).alias("plays"),
        F.sum(F.col("start_ms") - a.BASE * 1000).alias("starts"),
        F.sum(F.col("end_ms") - a.BASE * 1000).alias("ends"),
        F.min("start_ms").alias("first_ms"),
    )


@query
def play_fill_forward(spark, sf):
    return _per_slot(plays.fill_plays(
        _sessions(spark, sf), _cycle(spark, sf), backward=False, keep=False,
        counts=key_counts(_genuine(spark, sf), plays.LIST),
    ))


@query
def play_fill_backward(spark, sf):
    return _per_slot(plays.fill_plays(
        _sessions(spark, sf), _cycle(spark, sf), forward=False, keep=False,
        counts=key_counts(_genuine(spark, sf), plays.LIST),
    ))


@query
def play_table_written(spark, sf):
    """Filled plays as a table partitioned by date, read back."""
    filled = plays.fill_plays(
        _sessions(spark, sf), _cycle(spark, sf), backward=False, keep=False,
        counts=key_counts(_genuine(spark, sf), plays.LIST),
    )
    path = f"{sinks.shared_folder(spark)}/footfall-{uuid4().hex}"
    sinks.write_partitions(filled, path, files=8)
    return _per_slot(spark.read.schema(filled.schema).parquet(path))


@query
def play_log_rebuilt(spark, sf):
    return _per_slot(plays.rebuild_plays(_genuine(spark, sf), a.schedule_days(spark, sf)))


# --- gap-fill and views -------------------------------------------------------------------

VIEW_COLUMNS = ["time", "devid", "mac", "iccid", "inner_sn", *plays.SLOT, "scan_time"]


def _visitor_scans(spark, sf):
    scans = clean.spoof_filter(a.scan_log(spark, sf), a.mac_factory(spark, sf))
    main = clean.dominant_serial(scans, ["time", "devid"])
    return gapfill.visitor_scans(main, MAX_SCANS).select(*VIEW_COLUMNS)


def _gapfilled(spark, sf):
    return gapfill.exposure_gapfill(
        _visitor_scans(spark, sf), a.play_log(spark, sf), APPEND, FLAG,
        gapfill.device_hot_keys(a.scan_log(spark, sf), ["time", "devid"]),
    )


@query
def exposure_gapfill(spark, sf):
    return _gapfilled(spark, sf).select(
        "time", "devid", "mac", *plays.SLOT, "scan_time", "time_diff", "inserted"
    )


@query
def view_merge(spark, sf):
    return gapfill.view_merge(_gapfilled(spark, sf), FLAG).select(
        "time", "devid", "mac", *gapfill.AD_SLOT, "start_ms", "end_ms", "time_diff"
    )


@query
def view_merge_rebuilt(spark, sf):
    """Views over the rebuilt play log, from cleaned scans to views in one plan."""
    return jobs.rebuilt_views(
        a.view_info(spark, sf), a.schedule_days(spark, sf), a.mac_factory(spark, sf),
        append=APPEND, flag=FLAG, max_scans=1000, columns=VIEW_COLUMNS,
    ).groupBy("time", "devid", "sch_version", "uploadcount", "pls_index", "play_index").agg(
        F.count(F.lit(1)).alias("views"),
        F.sum(F.col("end_ms") - F.col("start_ms")).alias("viewed_ms"),
    )


def _enriched(spark, sf, stage=False):
    return jobs.enriched_log(
        a.play_log(spark, sf).drop("citycode"), _newest(spark, sf), a.schedule_days(spark, sf),
        a.ad_ids(spark, sf), stage,
    )


def _panel_scans(spark, sf):
    return jobs.panel_scans(
        a.scan_log(spark, sf), a.panel(spark, sf), a.panel_pairs(spark, sf),
        a.play_log(spark, sf),
    ).select("id", *VIEW_COLUMNS)


@query
def max_ad_length(spark, sf):
    return attribution.max_ad_length(a.schedule_days(spark, sf))


@query
def enrich_plays(spark, sf):
    return _enriched(spark, sf).select(
        "devid", "start_ms", "end_ms", "plninfo", *attribution.AD_COLUMNS
    )


@query
def enrich_plays_unversioned(spark, sf):
    """Play log without versions, whose file names carry a three-character prefix."""
    logged = a.play_log(spark, sf).withColumns(
        {"vfn": F.concat(F.lit(" zn_"), "vfn"), "sch_version": F.lit(0), "uploadcount": F.lit(0)}
    )
    devices = clean.latest_location(_newest(spark, sf)).where(F.col("suit_kind") != "")
    return attribution.enrich_plays(
        logged.drop("citycode"), devices, attribution.max_ad_length(a.schedule_days(spark, sf)),
        a.ad_ids(spark, sf), skip=3,
    ).groupBy("devid", "adcontent", "ad_content_id", "ad_length", "sch_version").agg(
        F.count(F.lit(1)).alias("plays")
    )


@query
def enrich_described_plays(spark, sf):
    """Log that carries its ads' customer, product and place; lengths by name alone."""
    logged = _enriched(spark, sf).drop("suit_kind", "ad_length").withColumn(
        "adcontent", F.replace(F.col("adcontent"), F.lit(".mp4"), F.lit(".avi"))
    )
    devices = clean.active_devices(_newest(spark, sf)).where(F.col("suit_kind") != "")
    lengths = attribution.max_ad_length(a.schedule_days(spark, sf), ["adcontent"])
    return attribution.enrich_described_plays(logged, devices, lengths).select(
        "devid", "start_ms", "end_ms", "plninfo", "adcontent", "suit_kind", "ad_length"
    )


@query
def ad_attribution(spark, sf):
    return attribution.attribute_ads(a.scan_log(spark, sf), _enriched(spark, sf)).select(
        "time", "devid", "mac", "scan_time", "adcontent", "adcustomer", "city_name",
        "building_name",
    )


@query
def ad_attribution_same_day(spark, sf):
    return attribution.attribute_ads(
        a.scan_log(spark, sf), _enriched(spark, sf), ("adcontent", "ad_length"), next_day=False
    ).groupBy("time", "devid", "adcontent").agg(F.count(F.lit(1)).alias("scans"))


LOGGED = {"append": APPEND, "flag": FLAG, "min_plays": 100, "max_scans": MAX_SCANS}


@query
def exposure_gapfill_playlog(spark, sf):
    return jobs.logged_gapfill(
        _panel_scans(spark, sf), _enriched(spark, sf, stage=True), raw=a.scan_log(spark, sf), **LOGGED
    ).select(
        "id", "time", "devid", "mac", *plays.SLOT, "scan_time", "time_diff", "inserted",
        "adcontent", "ad_content_id",
    )


def _logged_views(spark, sf, by_content):
    return jobs.logged_views(
        _panel_scans(spark, sf), _enriched(spark, sf, stage=True), raw=a.scan_log(spark, sf),
        by_content=by_content, **LOGGED,
    ).select(
        "time", "devid", "mac", *gapfill.AD_SLOT, "start_ms", "end_ms", "time_diff", "adcontent",
    )


@query
def view_merge_adlen(spark, sf):
    return _logged_views(spark, sf, by_content=False)


@query
def view_merge_adlen_content(spark, sf):
    return _logged_views(spark, sf, by_content=True)


@query
def panel_week_views(spark, sf):
    """Views of the panel in the week up to a run date, from the raw logs."""
    return jobs.panel_week(
        a.scan_log(spark, sf), a.play_log(spark, sf).drop("citycode"), a.panel(spark, sf),
        a.panel_pairs(spark, sf), _newest(spark, sf), a.schedule_days(spark, sf),
        a.ad_ids(spark, sf), "2024-01-07", ["id", *VIEW_COLUMNS], **LOGGED,
    ).select(
        "time", "devid", "mac", *gapfill.AD_SLOT, "start_ms", "end_ms", "time_diff", "adcontent",
    )


@query
def panel_week_views_daily(spark, sf):
    """The same from a stored table of views: a first run fills it, a run one date later adds
    that date only."""
    path = f"{sinks.shared_folder(spark)}/footfall-{uuid4().hex}"

    def run(day):
        return jobs.panel_week_daily(
            path, a.scan_log(spark, sf), a.play_log(spark, sf).drop("citycode"),
            a.panel(spark, sf), a.panel_pairs(spark, sf), _newest(spark, sf),
            a.schedule_days(spark, sf), a.ad_ids(spark, sf), day, ["id", *VIEW_COLUMNS], **LOGGED,
        )

    run("2024-01-06")
    return run("2024-01-07").select(
        "time", "devid", "mac", *gapfill.AD_SLOT, "start_ms", "end_ms", "time_diff", "adcontent",
    )


# --- row functions ------------------------------------------------------------------------

@query
def scalar_kit(spark, sf):
    scans = a.scan_log(spark, sf)
    t = F.col("scan_time")
    text = F.concat(
        F.date_format(times.day_of(t), "yyyy-MM-dd"), F.lit(" "),
        F.lpad(times.hour_of(t).cast("string"), 2, "0"),
        F.lit(":"), F.lpad(F.floor(F.pmod(t, F.lit(3600)) / 60).cast("string"), 2, "0"),
        F.lit(":"), F.lpad(F.pmod(t, F.lit(60)).cast("string"), 2, "0"),
    )
    return scans.select(
        "devid", "mac", "scan_time",
        scalars.mac_prefix(F.col("mac")).alias("prefix"),
        scalars.file_stem(F.concat(F.col("plninfo"), F.lit(".mp4"))).alias("stem"),
        scalars.file_stem(F.concat(F.lit(" x1_"), F.col("plninfo"), F.lit(".mp4 ")), 3).alias("cut_stem"),
        scalars.null_if_sentinel(F.when(F.col("is_ap") == "1", "NULL").otherwise(F.col("mac")))
        .alias("kept_mac"),
        scalars.city_alias(F.when(F.col("is_ap") == "1", "北京索迪").otherwise("上海")).alias("city"),
        times.stamp_seconds(t * 1000 + 123).alias("stamp"),
        (times.scan_seconds(text) - times.scan_seconds(F.concat(F.substring(text, 1, 10), F.lit(" 00:00:00"))))
        .alias("second_of_day"),
        times.hour_of(t).alias("hour"),
        (times.six_oclock(F.col("time")) - times.day_start(F.col("time"))).alias("to_six"),
        F.try_to_number(F.col("plninfo"), F.lit("999")).isNull().alias("no_number"),
        F.split(F.concat_ws("#", "devid", "mac"), "#")[1].alias("second_part"),
    )
