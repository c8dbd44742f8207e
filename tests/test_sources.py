"""Reading and writing."""

import datetime as dt

import pytest

from conftest import rows
from footfall.sources import sinks, tables


def test_partitions_are_pruned_and_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [(dt.date(2024, 1, d), d * 10 + i) for d in (1, 2, 3) for i in range(4)]
    df = spark.createDataFrame(data, "time date, v int")
    sinks.write_partitions(df, path, files=3)
    sinks.write_partitions(spark.createDataFrame([(dt.date(2024, 1, 2), 99)], "time date, v int"), path)
    back = spark.read.parquet(path)
    assert sorted(r.v for r in back.collect()) == [10, 11, 12, 13, 30, 31, 32, 33, 99]
    one = tables.scan_partition(back, "2024_01_02")
    assert [r.v for r in one.collect()] == [99]
    assert len(one.inputFiles()) < len(back.inputFiles()) or "PartitionFilters: [isnotnull(time" in _plan(one)
    assert tables.scan_range(back, "2024-01-01", "2024-01-03", include_last=False).count() == 5
    assert tables.scan_days(back, ["2024-01-01", "2024_01_03"]).count() == 8
    assert rows(tables.latest_snapshot(back).select("v")) == [(30,), (31,), (32,), (33,)]
    assert rows(tables.latest_snapshot(back, "2024_01_02").select("v")) == [(99,)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_staged_and_report(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 3 AS k")
    assert rows(sinks.staged(df)) == rows(df)
    sinks.write_report(df, str(tmp_path / "r"))
    assert spark.read.csv(str(tmp_path / "r"), header=True).count() == 10
    assert len(list((tmp_path / "r").glob("part-*.csv"))) == 1


def test_a_cluster_must_name_its_shared_folder(spark):
    folder, master = spark.conf.get("spark.checkpoint.dir"), spark.conf.get("spark.master")

    class Session:
        def __init__(self, **conf):
            self.conf = {k.replace("_", "."): v for k, v in conf.items()}

    local = {"spark_master": master, "spark_sql_warehouse_dir": "/w"}
    home = sinks.shared_folder
    assert home(spark) == folder.rstrip("/") and home(Session(**local)).startswith("/w/")
    with pytest.raises(ValueError):
        home(Session(**local | {"spark_master": "yarn"}))


def test_jdbc_options_come_from_the_caller(spark):
    options = sinks.jdbc_options(url="jdbc:x://h/db", dbtable="t", user="u", driver=None)
    assert options == {"url": "jdbc:x://h/db", "dbtable": "t", "user": "u"}
    with pytest.raises(ValueError):
        sinks.jdbc_options(url="jdbc:x://h/db")
    with pytest.raises(ValueError):
        sinks.write_jdbc(spark.range(1), mode="replace", url="u", dbtable="t")


def test_control_tables(spark, tmp_path):
    probes = tmp_path / "p.csv"
    probes.write_text("probe_id,devid,day,clock\n1,d,2018.09.10,06:00:10\n2,d,bad,06:00:10\n")
    assert rows(tables.read_probes(spark, str(probes))) == [(1, "d", 1536559210)]
    buildings = tmp_path / "b.csv"
    buildings.write_text("building_name,devid,first,last\nx,d,2018_09_10,2018_09_12\ny,d,2018_09_12,2018_09_10\n")
    assert rows(tables.read_buildings(spark, str(buildings))) == [
        ("x", "d", dt.date(2018, 9, d)) for d in (10, 11, 12)
    ]


def test_kept_releases(spark):
    df = spark.range(5)
    with tables.kept(df) as cached:
        assert cached.storageLevel.useMemory
    assert not df.storageLevel.useMemory
