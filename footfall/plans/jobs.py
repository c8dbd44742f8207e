"""Whole daily jobs over any number of dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators import attribution, clean, exposures, fullflow, gapfill, plays
from footfall.operators.spread import key_counts
from footfall.sources import sinks, tables
from footfall.sources.sinks import release, staged


def rebuilt_views(
    views: DataFrame,
    schedule: DataFrame,
    factory: DataFrame,
    append: int,
    flag: int,
    max_scans: int | None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Scans -> rebuilt play log -> gap-filled scans -> views. Plays are rebuilt where they start in
    a contact only; no other can be added to the scans. ``columns`` are kept of the scans (all if
    not given)."""
    genuine = clean.spoof_filter(views, factory)
    hot = gapfill.device_hot_keys(views, ["time", "devid"])
    shown = genuine.select(*columns) if columns else genuine
    scans = gapfill.dealt_visitors(gapfill.visitor_scans(
        clean.dominant_serial(shown, ["time", "devid"]), max_scans
    ), hot)
    played = plays.rebuild_plays(genuine, schedule, gapfill.contact_spans(scans, append, flag))
    return gapfill.view_merge(gapfill.dealt_gapfill(scans, played, append, flag, hot), flag)


def logged_gapfill(
    scans: DataFrame,
    played: DataFrame,
    append: int,
    flag: int,
    min_plays: int,
    max_scans: int | None,
    next_day: bool = True,
    raw: DataFrame | None = None,
) -> DataFrame:
    """Panel scans and enriched logged plays -> attributed and gap-filled scans. ``raw`` is
    the scan log the panel was taken from; hot devices are looked for there.

    Most plays run while nobody of the panel is in front of the screen. All plays are shuffled
    once, among the panel's contacts, which tells the others and counts them."""
    raw = scans if raw is None else raw
    panel = staged(gapfill.visitor_scans(scans, max_scans))
    near = staged(gapfill.near_plays(  # attributed from and inserted from
        played.select("time", "devid", *plays.SLOT, "start_ms", "end_ms", *attribution.AD_COLUMNS),
        gapfill.contact_spans(panel, append, flag), next_day,
    ))
    visitors = staged(attribution.on_busy_days(  # windowed and attributed to
        panel, near.where(F.col("_plays").isNotNull()), min_plays, next_day,
        key_counts(raw, ["time", "devid"]),
    ))
    release(panel)
    played = near.where("_near").drop("_near", "_plays")
    return gapfill.exposure_gapfill_playlog(
        visitors, played, append, flag, attribution.AD_COLUMNS,
        next_day, gapfill.device_hot_keys(raw, ["devid"]),
    )


def logged_views(
    scans: DataFrame,
    played: DataFrame,
    append: int,
    flag: int,
    min_plays: int,
    max_scans: int | None,
    next_day: bool = True,
    by_content: bool = False,
    raw: DataFrame | None = None,
) -> DataFrame:
    """Panel scans and enriched logged plays -> attributed, gap-filled scans -> views."""
    filled = logged_gapfill(scans, played, append, flag, min_plays, max_scans, next_day, raw)
    return gapfill.view_merge_adlen(filled, flag, by_content)


def enriched_log(
    plays: DataFrame,
    location: DataFrame,
    schedule: DataFrame,
    ad_ids: DataFrame,
    stage: bool = False,
) -> DataFrame:
    """The logged plays of screens in service with their place and ad. With ``stage`` the ads'
    lengths and ids are written first: a long schedule has few ads, and lists that are known to
    be short are broadcast, where by their source's size the plays would be shuffled to them."""
    devices = clean.active_devices(location, kind="液晶").where(F.col("suit_kind") != "")
    lengths = attribution.max_ad_length(schedule)
    if stage:
        lengths, ad_ids = staged(lengths), staged(ad_ids.select("adcontent", "adid").distinct())
    return attribution.enrich_plays(plays, clean.latest_location(devices), lengths, ad_ids)


def panel_scans(
    scans: DataFrame, panel: DataFrame, pairs: DataFrame, devices: DataFrame
) -> DataFrame:
    """Scans of panel members on their own date, on sampled pairs of the given devices."""
    return clean.panel_filter(tables.clip_to_day(scans), panel, pairs, devices)


def panel_week(
    scans: DataFrame,
    played: DataFrame,
    panel: DataFrame,
    pairs: DataFrame,
    location: DataFrame,
    schedule: DataFrame,
    ad_ids: DataFrame,
    run_date: str,
    columns: list[str],
    days: int = 7,
    **options,
) -> DataFrame:
    """Views of the panel on each of the ``days`` dates up to the run date, from the raw logs:
    panel and enrichment, gap-fill and merging in one plan over all dates. ``columns`` are kept
    of the scans; ``options`` go to ``logged_views``."""
    last = dt.date.fromisoformat(run_date)
    first = (last - dt.timedelta(days=days - 1)).isoformat()
    week = tables.scan_range(scans, first, run_date)
    logged = tables.scan_range(played, first, (last + dt.timedelta(days=1)).isoformat())
    seen = panel_scans(week, panel, pairs, logged).select(*columns)
    enriched = enriched_log(logged, location, schedule, ad_ids, stage=True)
    return logged_views(seen, enriched, raw=week, **options)


def panel_week_daily(
    path: str,
    scans: DataFrame,
    played: DataFrame,
    panel: DataFrame,
    pairs: DataFrame,
    location: DataFrame,
    schedule: DataFrame,
    ad_ids: DataFrame,
    run_date: str,
    columns: list[str],
    days: int = 7,
    **options,
) -> DataFrame:
    """``panel_week`` from a table of views partitioned by date at ``path``: a date's views depend
    on its own scans and the plays of it and the next date, so only dates that the table lacks are
    worked out, and added to it. Remove a date's folder to have it done again."""
    last = dt.date.fromisoformat(run_date)
    week = [last - dt.timedelta(days=k) for k in range(days)]
    spark = scans.sparkSession
    missing = [d for d in week if not sinks.has_partition(spark, path, d)]
    schema = None
    if missing:
        first, newest = min(missing), max(missing)
        with sinks.released_after():
            views = panel_week(
                scans, played, panel, pairs, location, schedule, ad_ids, newest.isoformat(), columns,
                (newest - first).days + 1, **options,
            ).where(F.col("time").isin(missing))
            sinks.write_partitions(views, path)
            schema = views.schema
    stored = spark.read.schema(schema) if schema is not None else spark.read
    return tables.scan_days(stored.parquet(path), week)


def trailing_exposures_daily(
    path: str,
    scans: DataFrame,
    run_date: str,
    gap: int,
    max_scans: int,
    max_hours: int,
    days: int = 7,
) -> DataFrame:
    """``trailing_exposures`` of the run date for a job that runs every day: the scans of that
    date are all it reads. Their summaries join the table at ``path``, partitioned by date, whose
    other dates were written by the runs before (``store_summaries``)."""
    today = tables.scan_partition(scans, run_date)
    schema = store_summaries(today, path)
    first = dt.date.fromisoformat(run_date) - dt.timedelta(days=days - 1)
    stored = scans.sparkSession.read.schema(schema).parquet(path)
    week = tables.scan_range(stored, first.isoformat(), run_date)
    macs = clean.roaming_in(week, max_scans, max_hours)
    return exposures.exposures(clean.drop_roaming(tables.clip_to_day(today, drop_ap=False), macs), gap)


def store_summaries(scans: DataFrame, path: str):
    """Write the mac summaries of the dates in ``scans`` to a table partitioned by date,
    replacing these dates; the table's schema."""
    summaries = clean.mac_summaries(scans)
    sinks.write_partitions(summaries, path)
    return summaries.schema


def trailing_exposures(
    scans: DataFrame,
    run_date: str,
    gap: int,
    max_scans: int,
    max_hours: int,
    each_day: bool = False,
    days: int = 7,
) -> DataFrame:
    """Exposures of the run date, or with ``each_day`` of each of the ``days`` days up to it,
    without the macs that roamed on any of these days."""
    first = dt.date.fromisoformat(run_date) - dt.timedelta(days=days - 1)
    week = tables.scan_range(scans, first.isoformat(), run_date)
    macs = clean.roaming_macs(week, max_scans, max_hours)
    shown = week if each_day else tables.scan_partition(scans, run_date)
    kept = clean.drop_roaming(tables.clip_to_day(shown, drop_ap=False), macs)
    return exposures.exposures(kept, gap)


def span_before(run_date: str, span: str) -> tuple[str, str]:
    """First and last date of the ISO week or calendar month before the run date's own."""
    day = dt.date.fromisoformat(run_date)
    if span == "week":
        last = day - dt.timedelta(days=day.isoweekday())
        first = last - dt.timedelta(days=6)
    elif span == "month":
        last = day.replace(day=1) - dt.timedelta(days=1)
        first = last.replace(day=1)
    else:
        raise ValueError("span must be 'week' or 'month'")
    return first.isoformat(), last.isoformat()


def flow_before(
    views: DataFrame,
    schedule: DataFrame,
    building_list: DataFrame,
    ad_info: DataFrame,
    factory: DataFrame,
    run_date: str,
    span: str,
) -> DataFrame:
    """Flow of the week or month before a run date, each day by its own schedule."""
    first, last = span_before(run_date, span)
    planned = tables.scan_range(
        schedule.withColumn("time", F.col("buildinglistdate")), first, last
    ).drop("time")
    flow = fullflow.full_flow(
        tables.scan_range(views, first, last), planned, building_list, ad_info, factory,
        by_day=True,
    )
    return flow.select(F.lit(first).alias("start_day"), F.lit(last).alias("end_date"), "*")
