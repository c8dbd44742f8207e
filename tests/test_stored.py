"""Stored tables: what daily runs, buckets and control tables spare, and rows that cannot be read."""

import datetime as dt
import random
import re
from pathlib import Path

import pytest

from conftest import rows
from footfall.operators import clean, exposures, spread
from footfall.plans import jobs
from footfall.plans.queries import QUERIES
from footfall.sources import sinks, tables

MIDNIGHT = 1704067200
SCANS = "time date, devid string, mac string, scan_time long, sch_version int"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def scans(spark):
    rng = random.Random(3)
    data = []
    for d in range(9):
        for _ in range(400):
            t = MIDNIGHT + d * 86400 + rng.randrange(86400)
            data.append((dt.date(2024, 1, 1 + d), f"d{rng.randrange(4)}", f"m{rng.randrange(25)}", t, 1))
    return spark.createDataFrame(data, SCANS)


@pytest.fixture
def log(scans, spark, tmp_path):
    path = str(tmp_path / "log")
    sinks.write_partitions(scans, path)
    return spark.read.schema(scans.schema).parquet(path)


def test_a_daily_run_reads_one_date_of_scans(spark, scans, log, tmp_path):
    path = str(tmp_path / "summaries")
    jobs.store_summaries(tables.scan_range(log, "2024-01-01", "2024-01-07"), path)
    for run in ("2024-01-08", "2024-01-09"):
        daily = jobs.trailing_exposures_daily(path, log, run, 3600, 22, 9)
        whole = jobs.trailing_exposures(scans, run, 3600, 22, 9)
        assert rows(daily) == rows(whole) and rows(daily)
        scanned = [x for x in plan(daily).splitlines() if "FileScan" in x]
        filters = [re.search(r"PartitionFilters: \[([^\]]*)\]", x)[1] for x in scanned]
        of_scans = [f for f, x in zip(filters, scanned) if "scan_time" in x]
        assert of_scans and all(re.search(rf"\(time#\d+ = {run}\)", f) for f in of_scans)
        assert all(">=" in f for f, x in zip(filters, scanned) if "scan_time" not in x)
    assert rows(jobs.trailing_exposures_daily(path, log, "2024-01-09", 3600, 22, 9)) == rows(daily)  # run again


def test_summaries_of_parts_add_up(spark, scans):
    whole = clean.mac_summaries(scans)
    halves = [clean.mac_summaries(scans.where(f"scan_time % 2 = {k}")) for k in (0, 1)]
    assert rows(clean.merged_summaries(halves[0].unionByName(halves[1]))) == rows(whole)
    assert rows(clean.roaming_in(whole, 22, 9)) == rows(clean.roaming_macs(scans, 22, 9))


def test_bucketed_scans_need_no_shuffle(spark, scans, tmp_path):
    stored = sinks.write_bucketed(scans, "bucketed_scans", str(tmp_path / "b"), 4, ["devid", "mac"])
    try:
        for boundary in ("ge", "gt"):
            out = exposures.exposures(stored, 3600, boundary=boundary)
            assert "Exchange" not in plan(out) and "Bucketed: true" in plan(out)
            assert rows(out) == rows(exposures.exposures(scans, 3600, boundary=boundary))
        one = tables.scan_partition(stored, "2024-01-02")
        assert "Exchange" not in plan(exposures.scan_gaps(one)) and one.count() == 400
        files = list((tmp_path / "b" / "time=2024-01-02").glob("part-*.parquet"))
        assert 1 <= len(files) <= 4
    finally:
        spark.sql("DROP TABLE bucketed_scans")


def test_only_dates_of_the_control_table_are_read(spark, scans, log, tmp_path):
    path = str(tmp_path / "control")
    control = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (2, 5, 5, 31)], "time date")
    control.write.parquet(path)
    kept = tables.scan_listed_days(log, spark.read.parquet(path))
    assert "dynamicpruning" in plan(kept)
    assert kept.count() == 800 and {r.time.day for r in kept.select("time").distinct().collect()} == {2, 5}
    metrics = kept._jdf.queryExecution()
    kept.collect()
    scan = re.search(r"FileScan parquet .*?PartitionFilters: \[[^\]]*dynamicpruning", plan(kept))
    assert scan and metrics is not None


@pytest.mark.parametrize("kind", ["scans", "plays"])
def test_unreadable_rows_are_kept_apart_and_counted(spark, tmp_path, kind):
    if kind == "scans":
        raw = spark.createDataFrame(
            [("2024_01_01", "d", "2024-01-01 10:00:00"), ("2024_01_01", "d", "nonsense"), ("2024_01_02", "e", None)],
            "time string, devid string, scan_time string")
        checked, normal, reasons = tables.checked_scans(raw), tables.normalize_scans(raw), ["unreadable scan_time"] * 2
    else:
        raw = spark.createDataFrame(
            [("d", "p", "20240101100000123", "20240101100005000", "10001", "1", "2"),
             ("d", "p", "x", "20240101100005000", "10001", "1", "2"), ("d", "p", "20240101100000123", "", "1", "1", "2")],
            "devid string, pid string, st string, et string, sv string, pi string, idx string")
        checked, normal, reasons = tables.checked_plays(raw), tables.normalize_plays(raw), ["unreadable et", "unreadable st"]
    accepted, rejected, seen = sinks.write_checked(checked, str(tmp_path / "out"))
    assert seen == {"read": 3, "accepted": 1, "rejected": 2}
    assert rows(accepted.drop("reject_reason", "raw_row")) == rows(normal)
    assert sorted(r.reject_reason for r in rejected.collect()) == reasons
    assert all('"devid"' in r.raw_row for r in rejected.collect()) and accepted.first().raw_row is None
    assert set(normal.columns) >= set(raw.columns) and "raw_row" not in normal.columns


def shuffle_files(spark):
    held = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {held.apply(i).getName() for i in range(held.size()) if held.apply(i).getName().endswith(".data")}


def test_written_tables_leave_no_shuffle_files(spark, scans, tmp_path):
    """What a step shuffled is removed as soon as its table is written."""
    counts = scans.groupBy("devid", "mac").count()
    before = shuffle_files(spark)
    back = sinks.staged(counts)
    sinks.write_partitions(scans.repartition("mac"), str(tmp_path / "t"))
    assert shuffle_files(spark) <= before
    assert rows(back) == rows(counts)
    assert spark.conf.get(sinks.CLEANUP) == "false"
    sinks.release(back)


def test_a_daily_run_leaves_only_its_table(spark):
    """Tables staged on the way to the stored views are removed when these are written."""
    folder = Path(sinks.shared_folder(spark))
    before = set(folder.iterdir()) if folder.exists() else set()
    views = QUERIES["panel_week_views_daily"](spark, "/root/testdata/sf0.001")
    assert len(set(folder.iterdir()) - before) == 1
    assert views.count() > 0


def test_long_schedules_of_few_ads_are_broadcast(spark, tmp_path, monkeypatch):
    """A schedule may be long and its ads few: the plays are not shuffled to the ads' lists."""
    path = str(tmp_path / "schedule")
    spark.range(20_000).selectExpr(
        "concat('ad', id % 9, '.avi') AS adcontent", "concat('c', id % 9) AS adcustomer",
        "concat('p', id % 9) AS adproduct", "'30' AS adlength", "uuid() AS note",
    ).write.parquet(path)
    schedule = spark.read.parquet(path)
    ads = schedule.selectExpr("replace(adcontent, 'avi', 'wmv') AS adcontent", "adcustomer AS adid")
    places = spark.createDataFrame(
        [("d", "液晶", "已安装", "kit", "c", "b1", "b", 1)],
        "devid string, devicekind string, install_status string, suit_kind string, city_name string, "
        "building_no string, building_name string, update_time long")
    places = sinks.staged(places)  # a file, whose size is known
    plays = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "d", "i", "s", 1, 1, 1, 1, "p", 10 * i, 10 * i + 5, f"ad{i % 12}.mp4") for i in range(24)],
        "time date, devid string, iccid string, inner_sn string, sch_version int, uploadcount int, pls_index int, "
        "play_index int, plninfo string, start_ms long, end_ms long, vfn string")
    args = plays, places, schedule, ads
    want = rows(jobs.enriched_log(*args))
    *head, most = spread.lookup_join.__defaults__
    monkeypatch.setattr(spread.lookup_join, "__defaults__", (*head, 50_000))
    assert "_salt" in plan(jobs.enriched_log(*args))
    short = jobs.enriched_log(*args, stage=True)
    assert "_salt" not in plan(short)
    assert rows(short) == want and len(want) == 18
