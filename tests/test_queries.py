"""Every query against its SQL counterpart, and the shape of a few plans."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from footfall.plans import adapters
from footfall.plans.oracles import ORACLES
from footfall.plans.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def text(value):
    if value is None:
        return ""
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([text(row[i]) for i in order] for row in data)


# Queries that write a table while they are built.
WRITING = {
    "write_partition_roundtrip", "play_table_written", "city_play_report", "raw_scans", "raw_plays",
    "probe_counts_by_control", "building_day_counts_by_control", "exposure_gapfill_playlog",
    "view_merge_adlen", "view_merge_adlen_content", "panel_week_views", "panel_week_views_daily",
    "raw_scans_checked", "exposures_bucketed", "probe_counts_pruned", "exposures_trailing_week_daily",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    spark.sparkContext.setJobGroup(f"build {name}", name)
    try:
        df = QUERIES[name](spark, SF)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    started = spark.sparkContext.statusTracker().getJobIdsForGroup(f"build {name}")
    assert name in WRITING or not started, "jobs ran while the query was built"
    got = table(df.columns, [tuple(r) for r in df.collect()])
    relation = duck.sql(ORACLES[name])
    assert got == table(relation.columns, relation.fetchall())
    assert got[1]


def test_queries_without_sql(spark):
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert entry.entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["reach_curve_city", "exposures", "full_flow_range", "play_fill_forward"])
def test_plans_stay_in_the_jvm(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for word in ("InPandas", "ArrowEval", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


@pytest.mark.parametrize("name", ["city_report", "city_screen_report", "full_flow_range", "ad_attribution", "panel_filter"])
def test_short_lists_are_broadcast(spark, name):
    """Lists made by joins count by the files they come from, not by the product of the sides."""
    text = plan(entry.queries()[name](spark, SF))
    assert "BroadcastHashJoin" in text and "_salt" not in text


def test_view_merging_gathers_no_lists(spark):
    text = plan(entry.queries()["view_merge_adlen"](spark, SF))
    assert "collect_list" not in text and "InPandas" not in text


def test_scan_reads_needed_columns_only(spark):
    text = plan(entry.queries()["exposures"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp,user_id:bigint>" in text


def test_one_sort_for_all_exposure_windows(spark):
    text = plan(entry.queries()["exposures"](spark, SF))
    assert text.count("Sort [") == 1 and text.count("Exchange hashpartitioning") == 2


def test_schedule_rows_are_made_by_many_tasks(spark, monkeypatch):
    """A part is few bytes and makes many rows: one file of parts is dealt to several tasks."""
    whole = sorted(map(tuple, adapters.schedule_days(spark, SF).collect()))
    monkeypatch.setattr(adapters, "PART_BYTES", 500)
    dealt = adapters.schedule_days(spark, SF)
    sizes = [n for n in dealt.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    assert len(sizes) > 2 and max(sizes) < len(whole) / 2
    assert sorted(map(tuple, dealt.collect())) == whole
