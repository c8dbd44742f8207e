"""Counts around given moments and in given buildings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.times import DAY, day_of, day_start
from footfall.operators.clean import drop_heavy, spoof_filter
from footfall.operators.exposures import distinct_seconds
from footfall.operators.spread import bucket_join, hot_keys, key_counts, lookup_join


def probe_window(
    probes: DataFrame,
    events: DataFrame,
    within: int,
    t: str,
    by_device: bool = True,
    raw: DataFrame | None = None,
) -> DataFrame:
    """Events no more than ``within`` seconds before or after a probe (of the same device).
    ``raw`` may name the table the events come from, to find hot devices in."""
    on = ["devid"] if by_device else []
    hot = None
    if by_device:
        hot = hot_keys(key_counts(events if raw is None else raw, on), on)
    spans = probes.withColumns({"_from": F.col("at") - within, "_to": F.col("at") + within + 1})
    if not by_device:
        spans = spans.drop("devid")
    return bucket_join(
        events, spans, on, t, "_from", "_to", 2 * within + 1, hot, "points"
    ).drop("_from", "_to")


def probe_counts(
    probes: DataFrame,
    scans: DataFrame,
    faces: DataFrame,
    max_scans: int,
    spreads: tuple[int, ...] = (10, 15),
    by_device: bool = True,
) -> DataFrame:
    """Scans, distinct macs and faces within each spread of seconds around every probe, on the
    probe's date.

    (device, mac) pairs with more than ``max_scans`` scans on a date do not count. All
    probes and spreads come out of one pass over the scans. Without ``by_device`` the scans of
    a whole network count, and no probe meets them one by one (``network_counts``).
    """
    widest = max(spreads)
    cleaned = drop_heavy(scans, ["time", "devid", "mac"], max_scans)
    figures = [f"{kind}_{s}" for s in spreads for kind in ("scans", "macs", "faces")]
    if not by_device:
        moments = probes.select(day_of(F.col("at")).alias("time"), "at")
        counts = network_counts(moments, cleaned, faces, spreads).withColumnRenamed("time", "_day")
        return (
            probes.select("probe_id", "devid", "at", day_of(F.col("at")).alias("_day"))
            .join(counts, ["_day", "at"], "left")
            .select("probe_id", "devid", "at",
                    *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in figures])
        )
    same_day = F.col("time") == day_of(F.col("at"))
    seconds = distinct_seconds(cleaned, ["time", "devid", "mac"])
    near = probe_window(probes, seconds, widest, "scan_time", raw=scans).where(same_day)
    away = F.abs(F.col("scan_time") - F.col("at"))
    per_mac = near.groupBy("probe_id", "mac").agg(
        *[F.sum(F.when(away <= s, F.col("n_scans"))).alias(f"_{s}") for s in spreads]
    )
    scan_counts = per_mac.groupBy("probe_id").agg(
        *[F.sum(f"_{s}").alias(f"scans_{s}") for s in spreads],
        *[F.count(F.when(F.col(f"_{s}").isNotNull(), F.col("mac"))).alias(f"macs_{s}")
          for s in spreads],
    )
    looks = faces.groupBy("time", "devid", "starttime").agg(F.count(F.lit(1)).alias("_n"))
    away = F.abs(F.col("starttime") - F.col("at"))
    face_counts = (
        probe_window(probes, looks, widest, "starttime", raw=faces)
        .where(same_day)
        .groupBy("probe_id")
        .agg(*[F.sum(F.when(away <= s, F.col("_n"))).alias(f"faces_{s}") for s in spreads])
    )
    return (
        probes.select("probe_id", "devid", "at")
        .join(scan_counts, "probe_id", "left")
        .join(face_counts, "probe_id", "left")
        .select("probe_id", "devid", "at",
                *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in figures])
    )


def network_counts(
    moments: DataFrame, scans: DataFrame, faces: DataFrame, spreads: tuple[int, ...]
) -> DataFrame:
    """Scans, distinct macs and faces of all devices within each spread of seconds around the
    given moments (time, at), on the moment's date; a row per date and moment.

    Every figure is a running sum over the seconds of a date. What happens at a second enters it
    ``spread`` seconds before and leaves it one second more after. A mac is counted while any of
    its scans is in reach: it enters with a scan whose previous one is out of reach by then, and
    leaves with one whose next is. Rows are as many as scans, then as seconds of the dates,
    however many moments there are.
    """
    widest = max(spreads)
    second, first = F.col("scan_time"), day_start(F.col("time"))

    def of_its_date(t):
        return F.col(t).between(first - widest, first + DAY - 1 + widest)

    mac = Window.partitionBy("time", "mac").orderBy("scan_time")
    before, after = second - F.lag("scan_time").over(mac), F.lead("scan_time").over(mac) - second
    known = F.col("mac").isNotNull()
    per_second = (
        distinct_seconds(scans.where(of_its_date("scan_time")), ["time", "mac"])
        .withColumns({"_before": before, "_after": after})
        .groupBy("time", "scan_time")
        .agg(
            F.sum("n_scans").alias("_scans"),
            *[F.count_if(known & F.coalesce(F.col("_before") > 2 * s, F.lit(True))).alias(f"_in_{s}")
              for s in spreads],
            *[F.count_if(known & F.coalesce(F.col("_after") > 2 * s, F.lit(True))).alias(f"_out_{s}")
              for s in spreads],
        )
    )
    looks = faces.where(of_its_date("starttime")).groupBy("time", "starttime").agg(
        F.count(F.lit(1)).alias("_faces")
    )

    def steps(rows, t, kinds):
        """The seconds at which figures change: ``kinds`` names what enters and what leaves a
        kind's figures."""
        changes = []
        for s in spreads:
            for at, side in ((F.col(t) - s, 0), (F.col(t) + s + 1, 1)):
                values = {
                    f"{kind}_{o}": F.col(pair(s)[side]) * (1 - 2 * side) if o == s else F.lit(0).cast("long")
                    for kind, pair in kinds.items() for o in spreads
                }
                changes.append(F.struct(at.alias("at"), *[v.alias(c) for c, v in values.items()]))
        return rows.select("time", F.inline(F.array(*changes)))

    scan_steps = steps(per_second, "scan_time", {
        "scans": lambda s: ("_scans", "_scans"), "macs": lambda s: (f"_in_{s}", f"_out_{s}")
    })
    face_steps = steps(looks, "starttime", {"faces": lambda s: ("_faces", "_faces")})
    figures = [f"{kind}_{s}" for s in spreads for kind in ("scans", "macs", "faces")]
    so_far = Window.partitionBy("time").orderBy("at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        scan_steps.unionByName(face_steps, allowMissingColumns=True)
        .unionByName(moments.where(F.col("at").isNotNull()), allowMissingColumns=True)
        .groupBy("time", "at")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in figures])
        .select("time", "at", *[F.sum(c).over(so_far).alias(c) for c in figures])
    )


def building_day_counts(
    control: DataFrame,
    scans: DataFrame,
    faces: DataFrame,
    factory: DataFrame,
    max_scans: int,
) -> DataFrame:
    """Scans, distinct macs and faces per building and date of a control table that lists
    (building_name, devid, time). Busy pairs and unknown vendors do not count as scans."""
    listed = control.select("building_name", "devid", "time").distinct()
    cleaned = spoof_filter(drop_heavy(scans, ["time", "devid", "mac"], max_scans), factory)
    per_pair = cleaned.groupBy("time", "devid", "mac").agg(F.count(F.lit(1)).alias("_n"))
    scan_counts = (
        lookup_join(per_pair, listed, ["time", "devid"], "inner")
        .groupBy("building_name", "time", "mac")
        .agg(F.sum("_n").alias("_n"))
        .groupBy("building_name", "time")
        .agg(F.sum("_n").alias("allnums"), F.count("mac").alias("distinctnums"))
    )
    face_counts = (
        faces.groupBy("time", "devid")
        .agg(F.count(F.lit(1)).alias("_n"))
        .join(listed, ["time", "devid"], "inner")
        .groupBy("building_name", "time")
        .agg(F.sum("_n").alias("facenums"))
    )
    figures = ["allnums", "distinctnums", "facenums"]
    return (
        listed.select("building_name", "time").distinct()
        .join(scan_counts, ["building_name", "time"], "left")
        .join(face_counts, ["building_name", "time"], "left")
        .select("building_name", "time",
                *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in figures])
    )
