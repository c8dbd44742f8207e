"""Which ad was on screen at a scan, from the observed play log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.scalars import file_stem
from footfall.operators.plays import SLOT
from footfall.operators.spread import lookup_join, spread_join

AD_COLUMNS = ("adcontent", "ad_content_id", "suit_kind", "ad_length", "adproduct",
              "adcustomer", "city_name", "building_no", "building_name")


def max_ad_length(schedule: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Greatest ad length, in whole seconds, per ad (and customer and product)."""
    names = names or ["adcontent", "adcustomer", "adproduct"]
    return schedule.groupBy(*names).agg(
        F.max(F.col("adlength").try_cast("int")).alias("ad_length")
    )


def enrich_plays(
    plays: DataFrame,
    devices: DataFrame,
    lengths: DataFrame,
    ad_ids: DataFrame,
    skip: int = 0,
) -> DataFrame:
    """Plays with the device's place, the ad's length, customer and product and its id. Ads
    are matched by file name without extension; ``skip`` characters are first cut off the
    names in the play log. Plays that lack any of these are dropped."""
    by_stem = lengths.select(
        file_stem(F.col("adcontent")).alias("_stem"), "ad_length", "adcustomer", "adproduct"
    ).distinct()
    ids = ad_ids.select(
        file_stem(F.col("adcontent")).alias("_stem"), F.col("adid").alias("ad_content_id")
    ).distinct()
    places = devices.select(
        "devid", "suit_kind", "city_name", "building_no", "building_name"
    ).distinct()
    content = F.expr(f"substring(trim(vfn), {skip + 1})") if skip else F.col("vfn")
    logged = plays.where(F.col("vfn").isNotNull() & (F.col("vfn") != "")).select(
        "time", "devid", "iccid", "inner_sn", *SLOT, "start_ms", "end_ms", "vfn"
    )
    # plays of devices without a place need not be shuffled to be made distinct
    logged = lookup_join(logged, places.select("devid").distinct(), ["devid"], "left_semi", devices)
    # dealt out as what is done per date and device needs them, so that it need not shuffle them again
    logged = logged.repartition("time", "devid").distinct()
    named = logged.withColumns({"_stem": file_stem(F.col("vfn"), skip), "adcontent": content})
    placed = lookup_join(named, places, ["devid"], "inner", devices)
    measured = lookup_join(placed, by_stem, ["_stem"], "inner", lengths)
    return lookup_join(measured, ids, ["_stem"], "inner", ad_ids).drop("_stem", "vfn")


def enrich_described_plays(
    plays: DataFrame, devices: DataFrame, lengths: DataFrame
) -> DataFrame:
    """Plays of a log that already carries ad, city and building columns, with the device's
    suit and the ad's length. Ads are matched by their exact name."""
    suits = devices.select("devid", "suit_kind").distinct()
    kept = [c for c in AD_COLUMNS if c not in ("suit_kind", "ad_length")]
    logged = plays.select(
        "time", "devid", "inner_sn", *SLOT, "start_ms", "end_ms", *kept
    ).distinct()
    suited = lookup_join(logged, suits, ["devid"], "inner", devices)
    return lookup_join(suited, lengths.select("adcontent", "ad_length"), ["adcontent"], "inner", lengths)


def busy_devices(
    scans: DataFrame,
    plays: DataFrame,
    more_than: int,
    next_day: bool = True,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Scans of devices with more than ``more_than`` plays on the scan's date (and the next).

    ``counts`` may give the rows per date and device of the raw scans (``key_counts``), so
    that finding hot devices need not run the scans' own plan once more.
    """
    daily = plays.groupBy("time", "devid").agg(F.count(F.lit(1)).alias("_plays"))
    return on_busy_days(scans, daily, more_than, next_day, counts)


def on_busy_days(
    scans: DataFrame,
    daily: DataFrame,
    more_than: int,
    next_day: bool = True,
    counts: DataFrame | None = None,
) -> DataFrame:
    """``busy_devices`` from the number of plays (``_plays``) per date and device."""
    days = F.array("time", F.date_sub("time", 1)) if next_day else F.array("time")
    busy = (
        daily.select("devid", "_plays", F.explode(days).alias("time"))
        .groupBy("time", "devid")
        .agg(F.sum("_plays").alias("_plays"))
        .where(F.col("_plays") > more_than)
        .select("time", "devid")
    )
    return spread_join(scans, busy, ["time", "devid"], "left_semi", counts)


def attribute_ads(
    scans: DataFrame,
    plays: DataFrame,
    columns: tuple[str, ...] = AD_COLUMNS,
    next_day: bool = True,
) -> DataFrame:
    """Give each scan the ad columns of the play that was running, null if none was.

    Of several plays the one that started last counts, then the one that ended first, then
    the smallest plan and ad. A device's plays are swept into segments that do not overlap
    (``swept``), and its seconds with scans take the segment that began last before them. The
    answer depends only on date, device and second, so this runs over distinct ones, and scans
    pick it up by equality.

    Plays and seconds meet in one union per device and date. Backwards in time each play sees the
    next second asked for; most plays end before it, and only the others are swept, beside the
    seconds, which alone come back. Plays that run at no time between the first and the last scan
    of a date are left out before the union is shuffled.
    """
    scanned = scans.groupBy("time").agg(
        F.min("scan_time").alias("_first"), F.max("scan_time").alias("_last")
    )
    moments = scans.where(
        F.col("time").isNotNull() & F.col("devid").isNotNull() & F.col("scan_time").isNotNull()
    ).select("time", "devid", "scan_time").distinct()
    asked = moments.select("time", "devid", (F.col("scan_time") * 1000).alias("from"))
    # a second has no end, and comes before the plays that start with it
    backwards = (
        Window.partitionBy("time", "devid").orderBy(F.col("from").desc(), F.col("to").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    second = F.col("to").isNull()
    line = (
        _shown(plays, columns, next_day, scanned)
        .unionByName(asked, allowMissingColumns=True)
        .repartition("time", "devid")
        .withColumn("_next", F.min(F.when(second, F.col("from"))).over(backwards))
        .where(second | (F.col("_next") <= F.col("to")))
        .drop("_next")
    )
    found = _in_order(line).mapInArrow(_sweeper(asked=True), line.schema).select(
        "time", "devid", F.call_function("div", F.col("from"), F.lit(1000)).alias("scan_time"),
        F.col("ad").alias("_ad"),
    )
    return scans.drop(*columns).join(
        found, ["time", "devid", "scan_time"], "left"
    ).select(
        *[c for c in scans.columns if c not in columns],
        *[F.col(f"_ad.{c}").alias(c) for c in columns],
    )


def swept(
    plays: DataFrame,
    columns: tuple[str, ...],
    next_day: bool = True,
    scanned: DataFrame | None = None,
) -> DataFrame:
    """Plays as segments [from, to] in milliseconds that do not overlap, per device and date of
    the scans that they count for: (time, devid, from, to, ad).

    Where plays overlap, the one that started last has the time; when it ends, the one that
    started last of those still running goes on. Plays stream through in order of device, date
    and start, and only the device and date being read is held back; the ad columns pass by as
    they are. A play's end may lie any time ahead. ``scanned`` may give the first and last second
    asked for of each date (time, _first, _last); plays that touch neither these nor the time
    between are left out before they are shuffled, which most are of the next date's.
    """
    rows = _shown(plays, columns, next_day, scanned)
    return _in_order(rows.repartition("time", "devid")).mapInArrow(_sweeper(), rows.schema)


def _shown(
    plays: DataFrame, columns: tuple[str, ...], next_day: bool, scanned: DataFrame | None
) -> DataFrame:
    """The plays to sweep, once for each date that they count for."""
    days = F.array("time", F.date_sub("time", 1)) if next_day else F.array("time")
    rows = plays.where(
        (F.col("end_ms") >= F.col("start_ms")) & F.col("devid").isNotNull()
    ).select(
        F.explode(days).alias("time"),
        "devid",
        F.col("start_ms").alias("from"),
        F.col("end_ms").alias("to"),
        F.struct(*[F.col(c) for c in dict.fromkeys((*SLOT, *columns))]).alias("ad"),
    )
    if scanned is None:
        return rows
    return rows.join(F.broadcast(scanned), "time").where(  # a row per date
        (F.col("from") <= F.col("_last") * 1000) & (F.col("to") >= F.col("_first") * 1000)
    ).drop("_first", "_last")


def _in_order(rows: DataFrame) -> DataFrame:
    """Plays in the order they are swept in, within partitions by date and device."""
    return rows.sortWithinPartitions(
        "time", "devid", "from", F.col("to").desc(), F.col("ad").desc()
    )


def _sweeper(asked: bool = False):
    """The Arrow function, self-contained so that executors need no import for it. With ``asked``
    rows without an end are moments between the plays, and what comes back is the play of each
    moment that has one, ``from`` being the moment."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def segments(start, end):
        """Places and bounds of the segments of plays in order: the later one wins."""
        most = np.iinfo(np.int64).max
        following = np.append(start[1:], most)
        last = np.minimum(end, following - 1)
        before = np.concatenate(([np.iinfo(np.int64).min], np.maximum.accumulate(end)[:-1]))
        if not ((end < following - 1) & (before > end)).any():  # no play outlives a later one
            own = np.flatnonzero(last >= start)
            return own, start[own], last[own]
        out, running, at = [], [], 0  # running: who started last is on top, ends grow downwards
        starts, ends = start.tolist(), end.tolist()
        for k, now in enumerate([*starts, most]):
            while running and at < now:
                top = running[-1]
                to = min(ends[top], now - 1)
                if to >= at:
                    out.append((top, at, to))
                    at = to + 1
                if ends[top] < now:
                    running.pop()
            if k < len(ends):
                while running and ends[running[-1]] <= ends[k]:
                    running.pop()
                running.append(k)
                at = now
        return tuple(np.asarray(x, dtype=np.int64) for x in zip(*out, strict=True))

    def firsts(rows):
        """Where another device or date begins."""
        n = rows.num_rows
        new = np.zeros(n, dtype=bool)
        new[0] = True
        for name in ("time", "devid"):
            c = rows.column(name).combine_chunks()
            other = pc.not_equal(c.slice(1), c.slice(0, n - 1))
            new[1:] |= other.to_numpy(zero_copy_only=False)
        return np.flatnonzero(new)

    def sweep(rows):
        """The segments of whole device-days."""
        start, ends = rows.column("from").to_numpy(), rows.column("to")
        is_play = ends.is_valid().to_numpy()
        end = pc.fill_null(ends, 0).to_numpy()
        edges = [*firsts(rows).tolist(), rows.num_rows]
        places, begins, lasts = [], [], []
        for a, b in zip(edges, edges[1:]):
            own = a + np.flatnonzero(is_play[a:b])
            if not len(own) or asked and len(own) == b - a:
                continue
            place, begin, last = segments(start[own], end[own])
            place = own[place]
            if asked:
                at = start[a:b][~is_play[a:b]]
                k = np.searchsorted(begin, at, side="right") - 1
                hit = (k >= 0) & (last[k] >= at)
                place, begin, last = place[k[hit]], at[hit], last[k[hit]]
            places.append(place)
            begins.append(begin)
            lasts.append(last)
        if not places:
            return []
        out = rows.take(pa.array(np.concatenate(places)))
        for name, bounds in (("from", begins), ("to", lasts)):
            k = out.schema.get_field_index(name)
            out = out.set_column(k, name, pa.array(np.concatenate(bounds)))
        return out.combine_chunks().to_batches()

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
            cut = int(firsts(rows)[-1])
            if cut:
                yield from sweep(rows.slice(0, cut))
            held = rows.slice(cut)
        if held is not None:
            yield from sweep(held)

    return run
