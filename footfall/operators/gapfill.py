"""Exposure gap-fill: plays that ran while a mac stayed in front of a screen are added to its
scans, and consecutive rows of one ad are merged into views.

Windows run per date, device and mac, so a group never holds more than one date. Pairs with
very many scans, which are not visitors, can be dropped before (``visitor_scans``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.times import same_day
from footfall.operators.attribution import attribute_ads
from footfall.operators.clean import drop_heavy
from footfall.operators.plays import SLOT
from footfall.operators.spread import (
    MIN_ROWS, bucket_join, hot_keys, key_counts, salt_large, salt_small,
)
from footfall.sources.sinks import release, staged

VISITOR = ["time", "devid", "mac"]
AD_SLOT = ["sch_version", "uploadcount", "pls_index", "play_index"]


def scan_windows(scans: DataFrame, append: int, flag: int) -> DataFrame:
    """Add to each scan the end of the time it stands for (``until``) and whether the contact
    ends there (``closed``). A contact ends at a mac's last scan of the day or before a gap
    of more than ``flag`` seconds; it then lasts ``append`` seconds more, at most up to the
    next scan. Otherwise it lasts until the next scan."""
    w = Window.partitionBy(*_visitor(scans)).orderBy("scan_time", *SLOT)
    t, following = F.col("scan_time"), F.col("_next")
    closed = following.isNull() | (following - t > flag)
    return (
        scans.where(t.isNotNull())
        .withColumn("_next", F.lead("scan_time").over(w))
        .withColumn("closed", closed)
        .withColumn("until", F.when(closed, F.least(t + append, following)).otherwise(following))
        .drop("_next")
    )


def dealt_visitors(scans: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Scans dealt out by date and device, those of the devices in ``hot`` (``device_hot_keys`` by
    date) by mac over several parts (``_salt``). All that is done per visitor, and what a device's
    plays have to do with it, then goes on without a shuffle."""
    if hot is not None:
        scans = salt_large(scans, ["time", "devid"], hot, by=["mac"])
        # never null, and known not to be: a join by it puts no test before the shuffle, which
        # would keep it from being shared
        scans = scans.withColumn("_salt", F.coalesce("_salt", F.lit(0)))
    return scans.repartition(*_device(scans))


def _device(rows: DataFrame) -> list[str]:
    return [c for c in ("time", "devid", "_salt") if c in rows.columns]


def _visitor(rows: DataFrame) -> list[str]:
    """The columns of a visitor, with the part that all its rows are in, if they are dealt out."""
    return [*_device(rows), "mac"]


def contact_spans(scans: DataFrame, append: int, flag: int) -> DataFrame:
    """When any contact lasted at a device, as spans of whole seconds per date that do not touch:
    (time, devid, _from, _to). No more than one row per second and device is ever sorted.

    All columns of the scans are looked at, so that a plan that has dealt out the same scans for
    more than this (``dealt_visitors``) shares the shuffle."""
    visitor = _visitor(scans)
    w = Window.partitionBy(*visitor).orderBy("scan_time", *SLOT)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    contacts = (
        scan_windows(scans, append, flag)
        .withColumn("_begins", F.coalesce(F.lag("closed").over(w), F.lit(True)).cast("int"))
        .withColumn("_contact", F.sum("_begins").over(so_far))
        .groupBy(*visitor, "_contact")
        .agg(
            F.min("scan_time").alias("_from"), F.max("until").alias("_to"),
            F.max(F.xxhash64(*scans.columns)).alias("_all"),
        )
    )
    seconds = contacts.where(F.col("_all").isNotNull()).groupBy("time", "devid", "_from").agg(
        F.max("_to").alias("_to")
    )
    w = Window.partitionBy("time", "devid").orderBy("_from")
    before = F.max("_to").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("_from") > before, F.lit(True))
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        seconds.withColumn("_starts", starts.cast("int"))
        .withColumn("_span", F.sum("_starts").over(so_far))
        .groupBy("time", "devid", "_span")
        .agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"))
        .drop("_span")
    )


def near_plays(plays: DataFrame, spans: DataFrame, next_day: bool = True) -> DataFrame:
    """The plays that ran at some time of a contact (``contact_spans``) of their date (or the date
    before it): no other play is on screen at a scan or starts in a contact. ``_near`` marks them;
    one row of each date and device, not always a play, tells how many plays of any kind it has
    (``_plays``, null in the other rows).

    Plays are put at their end, among the spans at their beginning: the latest end of the spans
    begun by then tells whether one was still open when the play started. Plays that are already
    dealt out by date and device, as ``enrich_plays`` leaves them, are not shuffled."""
    days = F.array("time", F.date_add("time", 1)) if next_day else F.array("time")
    asked = spans.select(
        F.explode(days).alias("time"), "devid",
        (F.col("_from") * 1000).alias("_at"), (F.col("_to") * 1000).alias("_until"),
    ).repartition("time", "devid")
    device = Window.partitionBy("time", "devid")
    by_then = device.orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    is_play = F.coalesce("_play", F.lit(False))
    started = F.max("_until").over(by_then) >= F.col("start_ms")
    return (
        plays.withColumns({"_at": F.greatest("start_ms", "end_ms"), "_play": F.lit(True)})
        .unionByName(asked, allowMissingColumns=True)
        .withColumn("_near", is_play & F.coalesce(started, F.lit(False)))
        .withColumn("_first", F.row_number().over(device.orderBy("_at")) == 1)
        .withColumn("_plays", F.when(F.col("_first"), F.count("_play").over(device)))
        .where(F.col("_near") | F.col("_first"))
        .select(*plays.columns, "_near", "_plays")
    )


def visitor_scans(scans: DataFrame, max_scans: int | None) -> DataFrame:
    """Scans of pairs with no more than ``max_scans`` scans a day; None keeps all."""
    return scans if max_scans is None else drop_heavy(scans, VISITOR, max_scans)


def exposure_gapfill(
    scans: DataFrame, plays: DataFrame, append: int, flag: int, hot: DataFrame | None = None
) -> DataFrame:
    """Scans and the rebuilt plays that started while a contact lasted.

    Within a contact a play must also end before the next scan. ``time_diff`` is how long
    after the scan the play started, for plays added after the contact's last scan.
    """
    spans = _milliseconds(scan_windows(scans, append, flag))
    matched = bucket_join(
        _rebuilt(plays), spans, ["time", "devid"], "p_start", "_from", "_to",
        1000 * max(append, flag, 1), hot,
    )
    return _with_rebuilt(spans, matched, scans.columns)


def dealt_gapfill(
    scans: DataFrame, plays: DataFrame, append: int, flag: int, hot: DataFrame | None = None
) -> DataFrame:
    """``exposure_gapfill`` of scans dealt out by ``dealt_visitors`` with the same ``hot``. The rows
    stay where the scans are, and ``view_merge`` need not shuffle them.

    Each scan is compared with all plays of its device and date. Of a rebuilt log these follow each
    other on one screen, and few are left where only those that start in contacts were rebuilt; a
    log that may hold any number of plays per device belongs to ``exposure_gapfill``."""
    spans = _milliseconds(scan_windows(scans, append, flag))
    shown = _rebuilt(plays)
    if hot is not None:
        shown = salt_small(shown, ["time", "devid"], hot)
    device = _device(scans)
    inside = (F.col("p_start") >= F.col("_from")) & (F.col("p_start") < F.col("_to"))
    matched = spans.join(shown.repartition(*device), device).where(inside)
    return _with_rebuilt(spans, matched, scans.columns)


def _milliseconds(windows: DataFrame) -> DataFrame:
    return windows.withColumns(
        {"_from": F.col("scan_time") * 1000, "_to": F.col("until") * 1000}
    )


def _rebuilt(plays: DataFrame) -> DataFrame:
    return plays.select(
        "time", "devid", *[F.col(c).alias(f"p_{c}") for c in SLOT],
        F.col("start_ms").alias("p_start"), F.col("end_ms").alias("p_end"),
    )


def _with_rebuilt(spans: DataFrame, matched: DataFrame, columns: list[str]) -> DataFrame:
    """The scans, and the plays that start in their time and, unless it ends a contact, end in it."""
    fitting = matched.where(F.col("closed") | (F.col("p_end") <= F.col("_to")))
    no_plan = F.col("p_plninfo").isNull() | (F.col("p_plninfo") == "NULL")
    slot = {c: F.col(f"p_{c}") for c in AD_SLOT}
    slot["plninfo"] = F.when(no_plan, F.col("plninfo")).otherwise(F.col("p_plninfo"))
    inserted = _inserted(fitting, columns, slot, F.floor(F.col("p_start") / 1000))
    return _own(spans.select(*columns)).unionByName(inserted)


def exposure_gapfill_playlog(
    scans: DataFrame,
    plays: DataFrame,
    append: int,
    flag: int,
    carried: tuple[str, ...] = (),
    next_day: bool = True,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Scans and the logged plays that started while a contact lasted, each added one second
    after its start. ``carried`` names ad columns: an added row has those of its play, a
    scan those of the play that was running. With ``next_day`` plays logged on the following
    date count too. ``hot`` are the devices to split (``device_hot_keys``) when plays are found
    by scans."""
    windows = scan_windows(scans, append, flag)
    taken = [*SLOT, *carried]
    shown = plays.select(
        "devid", F.col("time").alias("p_time"), *[F.col(c).alias(f"p_{c}") for c in taken],
        F.col("start_ms").alias("p_start"), F.col("end_ms").alias("p_end"),
    )
    spans = windows.withColumns(
        {"_from": F.col("scan_time") * 1000 + 1, "_to": F.col("until") * 1000}
    )
    matched = bucket_join(
        shown, spans, ["devid"], "p_start", "_from", "_to", 1000 * max(append, flag, 1), hot
    ).where(same_day(F.col("time"), F.col("p_time"), next_day))
    slot = {c: F.col(f"p_{c}") for c in taken}
    own = windows.select(*scans.columns)
    if carried:
        own = attribute_ads(own, plays, carried, next_day)
    inserted = _inserted(matched, own.columns, slot, F.floor((F.col("p_start") + 1000) / 1000))
    return _own(own).unionByName(inserted)


def _inserted(matched: DataFrame, columns: list[str], slot: dict, at: Column) -> DataFrame:
    """Rows for the matched plays; ``slot`` tells what a column takes from the play."""
    diff = F.col("p_start") - F.col("scan_time") * 1000
    return matched.select(
        *[slot[c].alias(c) if c in slot else c for c in columns if c != "scan_time"],
        at.cast("long").alias("scan_time"),
        F.when(F.col("closed"), diff).otherwise(F.lit(0)).cast("long").alias("time_diff"),
        F.col("scan_time").alias("anchor"),
        F.lit(1).alias("inserted"),
        "p_start",
        "p_end",
    )


def _own(scans: DataFrame) -> DataFrame:
    """Rows for the scans themselves."""
    none = F.lit(None).cast("long")
    return scans.withColumns(
        {
            "time_diff": F.lit(0).cast("long"),
            "anchor": F.col("scan_time"),
            "inserted": F.lit(0),
            "p_start": none,
            "p_end": none,
        }
    )


def filled_order() -> list[str]:
    """Order of a visitor's rows: scans, each followed by the plays added to it."""
    return ["anchor", "inserted", "p_start", "p_end", *SLOT]


def view_merge(filled: DataFrame, flag: int) -> DataFrame:
    """Merge consecutive rows of a visitor into views: same slot and at most ``flag`` seconds
    apart. A view carries its first row; it ends at its last row's time, or one millisecond
    after its only row."""
    runs = _runs(filled, flag, AD_SLOT, F.lit(False))
    return _as_views(_first_rows(runs, filled, [*_visitor(filled), "_run"]))


def _carried(filled: DataFrame) -> list[str]:
    """The columns that a view takes from its first row."""
    left_out = (*_visitor(filled), "scan_time", "anchor", "inserted", "p_start", "p_end")
    return [c for c in filled.columns if c not in left_out]


def _first_rows(rows: DataFrame, filled: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each group with the group's times and row count."""
    first = _carried(filled)
    return rows.groupBy(*keys).agg(
        F.min_by(
            F.struct(*first), F.struct(F.struct(*filled_order()), F.struct(*first))
        ).alias("_row"),
        F.min("scan_time").alias("_from"),
        F.max("scan_time").alias("_to"),
        F.count(F.lit(1)).alias("_n"),
    )


def view_merge_adlen(filled: DataFrame, flag: int, by_content: bool = False) -> DataFrame:
    """Merge as ``view_merge``, but only while the ad's length is known and no more than that
    many seconds have passed since the view began; with ``by_content`` the ad must also be
    the same.

    The plain conditions cut a visitor's rows into runs with windows. Most runs are one view: no
    row comes too late for the run's first one; their first row takes along the run's times, and
    no other row of theirs is kept. In the others, where the view after each row begins does not
    depend on where that view began (``_next_views``), and the beginnings are those that the run's
    first row leads to (``_view_starts``).
    """
    same = [*AD_SLOT, *(["adcontent"] if by_content else [])]
    run = [*VISITOR, "_run"]
    unknown = F.col("ad_length").isNull() | (F.col("ad_length") < 0)
    # rows equal in time and slot are told apart by the rest, so that places never change
    in_run = Window.partitionBy(*run).orderBy(*filled_order(), F.struct(*_carried(filled)))
    whole = Window.partitionBy(*run)
    rows = staged(
        _runs(filled, flag, same, unknown)
        .withColumn("_place", F.row_number().over(in_run))
        # a row is too late for views that began before this
        .withColumn("_since", F.when(~unknown, F.col("scan_time") - F.col("ad_length")))
        .withColumns({
            "_from": F.min("scan_time").over(whole),
            "_to": F.max("scan_time").over(whole),
            "_n": F.count(F.lit(1)).over(whole),
            "_late": F.max("_since").over(whole),
        })
        .withColumn("_broken", F.coalesce(F.col("_late") > F.col("_from"), F.lit(False)))
        .where(F.col("_broken") | (F.col("_place") == 1))
        .drop("_starts", "_late")
    )
    broken = rows.where("_broken").drop("_from", "_to", "_n")
    starts = _view_starts(_next_views(broken.select(*run, "_place", "scan_time", "_since"), run), run)
    so_far = Window.partitionBy(*run).orderBy("_place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    cut = broken.join(starts.withColumn("_begin", F.lit(1)), [*run, "_place"], "left").withColumn(
        "_view", F.sum("_begin").over(so_far)
    )
    merged = rows.where("not _broken").select(
        *VISITOR, F.struct(*_carried(filled)).alias("_row"), "_from", "_to", "_n"
    )
    views = _first_rows(cut, filled, [*run, "_view"]).select(*merged.columns)
    return _as_views(merged.unionByName(views))


def _next_views(rows: DataFrame, run: list[str]) -> DataFrame:
    """For each row the place where the next view would begin if one began at the row
    (``_next``, null if none): the first row that is too late for it. Times never fall within a
    run, so only later rows can be too late, and the first of all that are is found by a running
    minimum over the rows in order of the beginning they are too late for."""
    late = rows.where(F.col("_since").isNotNull()).select(
        *run, F.col("_since").alias("_value"), F.lit(1).alias("_kind"), F.col("_place").alias("_late")
    )
    asked = rows.select(*run, F.col("scan_time").alias("_value"), F.lit(0).alias("_kind"), "_place")
    down = Window.partitionBy(*run).orderBy(F.col("_value").desc(), "_kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        asked.unionByName(late, allowMissingColumns=True)
        .withColumn("_next", F.min("_late").over(down))
        .where(F.col("_place").isNotNull())
        .select(*run, "_place", "_next")
    )


def _view_starts(links: DataFrame, run: list[str]) -> DataFrame:
    """The places that the first place of each run leads to by ``_next``, itself included.

    Pointer doubling: each round marks what the marked places point to and makes every pointer
    twice as long, so a run of n views takes log2(n) rounds. Only places that some place points
    to take part. Each round is a written table; the one before it is removed.
    """
    at = [*run, "_place"]
    aimed = links.where(F.col("_next").isNotNull()).select(*run, F.col("_next").alias("_place"))
    first = F.col("_place") == 1
    nodes = links.where(~first).join(aimed.distinct(), at, "left_semi").unionByName(links.where(first))
    now = staged(nodes.withColumn("_mark", F.col("_place") == 1))
    while not now.where(F.col("_mark") & F.col("_next").isNotNull()).isEmpty():
        marks = (
            now.where(F.col("_mark") & F.col("_next").isNotNull())
            .select(*run, F.col("_next").alias("_place"), F.lit(True).alias("_hit"))
        )
        ahead = now.select(*run, F.col("_place").alias("_next"), F.col("_next").alias("_after"))
        after = (
            now.join(ahead, [*run, "_next"], "left")
            .join(marks.distinct(), at, "left")
            .select(*at, F.col("_after").alias("_next"), (F.col("_mark") | F.coalesce("_hit", F.lit(False))).alias("_mark"))
        )
        now, before = staged(after), now
        release(before)
    return now.where("_mark").select(*at)


def _runs(filled: DataFrame, flag: int, same: list[str], cut: Column) -> DataFrame:
    w = Window.partitionBy(*_visitor(filled)).orderBy(*filled_order())
    state = F.struct(*same)
    keyless = F.lit(False)
    for c in same:
        keyless = keyless | F.col(c).isNull()
    starts = (
        F.lag("scan_time").over(w).isNull()
        | (F.col("scan_time") - F.lag("scan_time").over(w) > flag)
        | ~F.lag(state).over(w).eqNullSafe(state)
        | keyless
        | cut
    )
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return filled.withColumn("_starts", starts.cast("int")).withColumn(
        "_run", F.sum("_starts").over(running)
    )


def _as_views(views: DataFrame) -> DataFrame:
    end = F.when(F.col("_n") == 1, F.col("_from") * 1000 + 1).otherwise(F.col("_to") * 1000)
    return views.select(
        *VISITOR,
        "_row.*",
        (F.col("_from") * 1000).alias("start_ms"),
        end.alias("end_ms"),
    )


def device_hot_keys(rows: DataFrame, on: list[str], min_rows: int = MIN_ROWS) -> DataFrame:
    """Devices (or device-days) holding much of a log, for the range joins above."""
    return hot_keys(key_counts(rows, on), on, min_rows=min_rows)
