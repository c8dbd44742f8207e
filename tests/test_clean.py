"""Filters and key repairs on small hand-made tables."""

import datetime as dt

from conftest import rows
from footfall.functions import scalars, times
from footfall.operators import attribution, clean
from footfall.sources import tables
from pyspark.sql import functions as F


def test_spoof_filter_never_multiplies(spark):
    scans = spark.createDataFrame([("ABCDEF01",), ("abcdef02",), ("ffffff03",), ("a",)], "mac string")
    factory = spark.createDataFrame(
        [("abcdef", "x"), ("abcdef", "y"), ("ffffff", None)], "mac_index_factory string, factory_name string"
    )
    assert rows(clean.spoof_filter(scans, factory)) == [("ABCDEF01",), ("abcdef02",)]
    assert rows(clean.spoof_filter(scans, factory, ignore_case=False)) == [("abcdef02",)]
    flags = dict(rows(clean.vendor_flag(scans, factory)))
    assert flags == {"ABCDEF01": True, "abcdef02": True, "ffffff03": False, "a": False}


def test_drop_heavy_counts_copies(spark):
    data = [("d", "m", 1)] * 3 + [("d", "n", 1), ("d", "n", 2)] + [("d", "o", 5)] * 2
    df = spark.createDataFrame(data, "devid string, mac string, t int")
    out = clean.drop_heavy(df, ["devid", "mac"], 2)
    assert rows(out) == [("d", "n", 1), ("d", "n", 2), ("d", "o", 5), ("d", "o", 5)]


def test_drop_heavy_folds_a_hot_key(spark):
    hot = spark.range(100_000).selectExpr("'d' AS devid", "id % 3 AS t")
    cold = spark.createDataFrame([("e", 1), ("e", 1)], "devid string, t long")
    assert rows(clean.drop_heavy(hot.union(cold), ["devid"], 1000)) == [("e", 1), ("e", 1)]


def test_dominant_serial_tie_takes_smallest(spark):
    df = spark.createDataFrame(
        [("d", "b", 1), ("d", "a", 2), ("e", "z", 1), ("e", "z", 2), ("e", "a", 3), ("f", None, 1)],
        "devid string, inner_sn string, t int",
    )
    assert rows(clean.dominant_serial(df, ["devid"])) == [("d", "a", 2), ("e", "z", 1), ("e", "z", 2)]


def test_roaming_macs(spark):
    day = dt.date(2024, 1, 1)
    data = [(day, "d", "many", h) for h in range(6)] + [(day, "e", "many", h) for h in range(6)]
    data += [(day, "d", "hours", h * 3600) for h in range(4)]
    data += [(day, "d", "calm", h) for h in range(3)]
    df = spark.createDataFrame(data, "time date, devid string, mac string, scan_time long")
    assert rows(clean.roaming_macs(df, 11, 3)) == [("hours",), ("many",)]
    assert rows(clean.drop_roaming(df, clean.roaming_macs(df, 11, 3)).select("mac").distinct()) == [("calm",)]


def test_backfill_and_resolve(spark):
    schedule = spark.createDataFrame(
        [("c1", 7, 9, "p", "ad_p"), ("c1", 7, 10, "p", "ad_q"), ("c1", 0, 3, "r", "")],
        "citycode string, buildinglist int, uploadcount int, plnid string, adcontent string",
    )
    views = spark.createDataFrame(
        [("c1", 7, 0, "p", None), ("c1", 7, 2, "p", "NULL"), ("c1", 0, 0, "r", None),
         ("c2", 7, 0, "p", "a1"), ("c1", 7, 0, "x", "a2")],
        "citycode string, sch_version int, uploadcount int, plninfo string, ad_content_id string",
    )
    info = spark.createDataFrame([("a1", "x"), ("a1", "y"), ("a2", "")], "adcontent_id string, adcontent string")
    filled = clean.backfill_batch(views, schedule)
    assert sorted(r.uploadcount for r in filled.collect()) == [0, 0, 2, 10, 10]
    named = {(r.citycode, r.plninfo, r.ad_content_id): r.adcontent
             for r in clean.resolve_ad(views, info, schedule).collect()}
    assert named["c1", "p", None] == "ad_q" and named["c1", "p", "NULL"] == "ad_q"
    assert named["c1", "r", None] is None and named["c2", "p", "a1"] == "y"
    assert named["c1", "x", "a2"] is None


def test_latest_location_needs_latest_row_installed(spark):
    df = spark.createDataFrame(
        [("d", 1, "已安装", "x"), ("d", 2, "已安装", "y"), ("d", 2, "已安装", "z"),
         ("e", 1, "已安装", "x"), ("e", 2, "已拆除", "y")],
        "devid string, update_time long, install_status string, building_name string",
    )
    assert rows(clean.latest_location(df).select("devid", "building_name")) == [("d", "y"), ("d", "z")]


def test_panel_filter(spark):
    scans = spark.createDataFrame([("0021x", "AA", 1), ("0021x", "bb", 2), ("0755y", "aa", 3)],
                                  "devid string, mac string, scan_time long")
    panel = spark.createDataFrame([("aa", "7", "0021"), ("bb", "8", "0755")], "mac string, id string, city string")
    pairs = spark.createDataFrame([("0021x", "aA"), ("0755y", "aa")], "devid string, mac string")
    devices = scans.select("devid")
    out = clean.panel_filter(scans, panel, pairs, devices)
    assert rows(out.select("id", "devid", "mac", "scan_time")) == [("7", "0021x", "AA", 1)]


def test_version_and_name_functions(spark):
    df = spark.createDataFrame([("10302", " zn_ad1.mp4"), ("7", "x"), ("1234567", "ad.avi")], "sv string, f string")
    out = df.select(
        scalars.version_part(F.col("sv")), scalars.batch_part(F.col("sv")),
        scalars.short_version(F.col("sv")), scalars.file_stem(F.col("f")), scalars.file_stem(F.col("f"), 3),
    ).collect()
    assert tuple(out[0]) == ("103", 2, "10302", "zn_ad1", "ad1")
    assert tuple(out[1])[2:] == ("7", "", "")
    assert tuple(out[2]) == ("12345", 67, "123456", "ad", "")


def test_times(spark):
    df = spark.createDataFrame(
        [("2018_06_20", "20180620061500250", "20180620061500", "2018-06-20 06:15:00"),
         ("2018-06-20", "bad", "x", "y"), ("20180620", None, None, None)],
        "d string, ms string, s string, t string",
    )
    out = df.select(
        times.partition_date(F.replace(F.col("d"), F.lit("20180620"), F.lit("2018_06_20_13"))),
        times.play_millis(F.col("ms")), times.play_millis(F.col("s")), times.scan_seconds(F.col("t")),
    ).collect()
    day = dt.date(2018, 6, 20)
    assert tuple(out[0]) == (day, 1529475300250, 1529475300000, 1529475300)
    assert tuple(out[1]) == (day, None, None, None)
    assert out[2][0] == day


def test_date_windows(spark):
    df = spark.createDataFrame([(dt.date(2018, 6, 3),), (dt.date(2018, 6, 4),), (dt.date(2018, 3, 31),)], "time date")
    got = {r.time: r for r in times.date_windows(df).collect()}
    sunday, monday, march = (got[d] for d in (dt.date(2018, 6, 3), dt.date(2018, 6, 4), dt.date(2018, 3, 31)))
    assert (sunday.week_start, sunday.week_end) == (dt.date(2018, 5, 21), dt.date(2018, 5, 27))
    assert (monday.week_start, monday.week_end) == (dt.date(2018, 5, 28), dt.date(2018, 6, 3))
    assert (march.month_start, march.month_end, march.month_days) == (
        dt.date(2018, 2, 1), dt.date(2018, 2, 28), 28)
    assert sunday.trail_start == dt.date(2018, 5, 28) and sunday.trail_days == 7


def test_normalize_scans_and_plays(spark):
    scans = spark.createDataFrame(
        [("12", "3", "2018-06-20 00:00:01", "2018_06_20", "0"), ("x", "3", "2018-06-20 00:00:01", "2018_06_20", "0"),
         ("12", "3", "nonsense", "2018_06_20", "0"), ("12", "3", "2018-06-19 23:59:59", "2018_06_20", "0"),
         ("12", "3", "2018-06-20 00:00:02", "2018_06_20", "1"), ("0", "3", "2018-06-20 00:00:02", "2018_06_20", "0")],
        "sch_version string, uploadcount string, scan_time string, time string, is_ap string",
    )
    typed = tables.normalize_scans(scans)
    assert typed.count() == 5
    assert rows(tables.clip_to_day(typed).select("sch_version", "scan_time")) == [(12, 1529452801)]
    plays = spark.createDataFrame(
        [("d", "p", "20180620061500250", "20180620061510000", "10302", "4", "5"), ("d", "p", "?", "?", "1", "1", "1")],
        "devid string, pid string, st string, et string, sv string, pi string, idx string",
    )
    got = tables.normalize_plays(plays).select("start_ms", "end_ms", "sch_version", "uploadcount", "pls_index", "play_index")
    assert rows(got) == [(1529475300250, 1529475310000, 103, 2, 4, 5)]
    assert rows(tables.normalize_plays(plays, unversioned=True).select("sch_version", "uploadcount")) == [(0, 0)]


def test_enrich_plays_matches_stems(spark):
    plays = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "d", "i", "s", 1, 1, 1, 1, "p", 0, 9, " zn_ad1.mp4")] * 2,
        "time date, devid string, iccid string, inner_sn string, sch_version int, uploadcount int, pls_index int, "
        "play_index int, plninfo string, start_ms long, end_ms long, vfn string",
    )
    devices = spark.createDataFrame([("d", "k", "c", "b", "n")],
                                    "devid string, suit_kind string, city_name string, building_no string, building_name string")
    lengths = spark.createDataFrame([("ad1.avi", "cu", "pr", 15), ("ad1.mpg", "cu", "pr", 15)],
                                    "adcontent string, adcustomer string, adproduct string, ad_length int")
    ids = spark.createDataFrame([("ad1.wmv", "a1"), ("ad2.wmv", "a2")], "adcontent string, adid string")
    out = attribution.enrich_plays(plays, devices, lengths, ids, skip=3).collect()
    assert len(out) == 1 and (out[0].ad_content_id, out[0].ad_length) == ("a1", 15)
    assert attribution.enrich_plays(plays, devices, lengths, ids).count() == 0
