"""Lookups beyond the broadcast limit: same rows, hot keys split."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from footfall.operators import citystats, clean, spread


@pytest.fixture
def nothing_small(monkeypatch, spark):
    """Every list counts as too long to broadcast."""
    original = spread.lookup_join

    def strict(facts, dim, on, how, source=()):
        return original(facts, dim, on, how, source, 0)

    for module in (clean, citystats):
        monkeypatch.setattr(module, "lookup_join", strict)
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, -1)
    yield
    spark.conf.set(setting, before)


def scans(spark):
    key = "CASE WHEN id % 3 = 0 THEN 'd0' ELSE concat('d', id % 400) END"
    return spark.range(0, 6000, 1, 8).selectExpr(
        f"{key} AS devid", "concat(lpad(cast(id % 20 AS string), 6, '0'), id) AS mac", "id AS scan_time",
        "CASE WHEN id % 3 = 0 THEN NULL ELSE concat('a', id % 50) END AS ad_content_id",
        "'c1' AS citycode", "concat('p', id % 7) AS plninfo",
    )


def location(spark):
    return spark.range(400).selectExpr(
        "concat('d', id) AS devid", "'已安装' AS install_status", "concat('city', id % 5) AS city_name",
        "'b' AS building_name", "id AS update_time")


def test_same_rows_without_broadcast(spark, monkeypatch):
    s, places, hot_keys = scans(spark), location(spark), spread.hot_keys
    factory = spark.range(10).selectExpr("lpad(cast(id AS string), 6, '0') AS mac_index_factory", "'x' AS factory_name")
    info = spark.range(40).selectExpr("concat('a', id) AS adcontent_id", "concat('n', id) AS adcontent")
    schedule = spark.range(5).selectExpr("'c1' AS citycode", "concat('p', id) AS plnid", "concat('m', id) AS adcontent")

    def results():
        return [
            rows(citystats.with_city(s, places)),
            rows(citystats.with_building(s, places).select("devid", "scan_time", "city_name")),
            rows(clean.spoof_filter(s, factory)),
            rows(clean.vendor_flag(s, factory).select("mac", "genuine")),
            rows(clean.resolve_ad(s, info, schedule).select("scan_time", "adcontent")),
        ]

    small = results()
    monkeypatch.setattr(spread, "hot_keys", lambda c, on, p, m: hot_keys(c, on, p, 1))
    for module in (clean, citystats):
        monkeypatch.setattr(
            module, "lookup_join", lambda f, d, on, how, s=(): spread.lookup_join(f, d, on, how, s, 0)
        )
    assert results() == small


def test_long_lists_are_not_broadcast_and_hot_keys_are_salted(spark, nothing_small):
    out = citystats.with_city(scans(spark), location(spark))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [devid" in plan and "_salt" in plan
    assert "BroadcastHashJoin" in plan  # only the list of hot keys
    counts = spread.key_counts(scans(spark), ["devid"])
    assert spread.hot_keys(counts, ["devid"], min_rows=1).where(F.col("devid") == "d0").first()._parts > 300
