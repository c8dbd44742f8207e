"""Exposure logic against the documented example and a scan-by-scan loop."""

import random

import pytest

from conftest import rows
from footfall.operators import exposures as exp, reach

SCHEMA = "devid string, mac string, scan_time long"
PAIR = ["devid", "mac"]


def by_loop(times, gap, strict):
    """Exposures of one key, scan by scan."""
    times = sorted(times)
    out, last_break = [], None
    for before, now in zip(times, times[1:]):
        if now - before > gap or (not strict and now - before == gap):
            if last_break is None or before - last_break > gap:
                out.append(before)
            out.append(now)
            last_break = now
    if all(b - a < gap for a, b in zip(times, times[1:])):
        out.append(times[-1])
    return sorted(out)


def random_scans(seed, keys=200):
    rng = random.Random(seed)
    data = {}
    for k in range(keys):
        step = rng.choice([5, 40, 100])
        t, times = 1000, []
        for _ in range(rng.randint(1, 12)):
            t += rng.choice([0, 1, step, 100, 100, 101, 99, 250])
            times += [t] * rng.choice([1, 1, 1, 2, 5])
        data[f"d{k % 7}", f"m{k}"] = times
    return data


def test_documented_example(spark):
    scans = [(d, "YWEY", t) for d in ("Dev1", "Dev2") for t in (10, 170, 400, 410)]
    df = spark.createDataFrame(scans, SCHEMA)
    for boundary in ("gt", "ge"):
        out = exp.exposures(df, 150, PAIR, boundary)
        assert rows(out) == [(d, "YWEY", t) for d in ("Dev1", "Dev2") for t in (10, 170, 400)]
    curve = reach.reach_curve(reach.freq_dist(out, PAIR))
    assert [r.mactimes for r in curve.orderBy("expose_time").collect()] == [2] * 3 + [0] * 47


@pytest.mark.parametrize("boundary", ["ge", "gt"])
def test_matches_loop(spark, boundary):
    data = random_scans(1)
    df = spark.createDataFrame([(d, m, t) for (d, m), ts in data.items() for t in ts], SCHEMA)
    want = sorted(
        ((d, m, t) for (d, m), ts in data.items() for t in by_loop(ts, 100, boundary == "gt")),
        key=repr,
    )
    assert rows(exp.exposures(df, 100, PAIR, boundary)) == want


def test_multi_and_single_split_the_keys(spark):
    data = random_scans(2)
    df = spark.createDataFrame([(d, m, t) for (d, m), ts in data.items() for t in ts], SCHEMA)
    multi = {r[:2] for r in rows(exp.exposures_multi(df, 100, keys=PAIR))}
    single = {r[:2] for r in rows(exp.exposures_single(df, 100, keys=PAIR))}
    assert not multi & single
    assert multi | single == set(data)


def test_copies_of_one_key_stay_one_row_per_second(spark):
    """A key holding most rows reaches the windows as its distinct seconds only."""
    base = spark.range(200_000).selectExpr("'d' AS devid", "'m' AS mac", "id % 50 AS scan_time")
    seconds = exp.distinct_seconds(base, PAIR)
    assert seconds.count() == 50
    assert rows(exp.exposures(base, 100, PAIR)) == [("d", "m", 49)]


def test_arrivals(spark):
    df = spark.createDataFrame([("d", "m", t) for t in (0, 300, 601, 1000)], SCHEMA)
    assert rows(exp.arrivals(df, 300, PAIR)) == [("d", "m", 3)]
    assert rows(exp.arrivals(df, 300, PAIR, "ge")) == [("d", "m", 4)]


def test_dates_are_kept_apart_by_default(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "d", "m", 10), ("2024-01-02", "d", "m", 20), ("2024-01-02", "d", "m", 30)],
        "time string, devid string, mac string, scan_time long",
    )
    assert rows(exp.exposures(df, 100)) == [("2024-01-01", "d", "m", 10), ("2024-01-02", "d", "m", 30)]


def test_bad_options(spark):
    df = spark.createDataFrame([("d", "m", 1)], SCHEMA)
    with pytest.raises(ValueError):
        exp.exposures(df, 100, PAIR, "eq")
    with pytest.raises(ValueError):
        exp.exposures(df, 0, PAIR)


def test_curve_never_rises_and_sparse_form(spark):
    dist = spark.createDataFrame(
        [("a", 1, 4), ("a", 3, 2), ("b", 1, 5), ("c", 2, 7)],
        "city string, expose_time long, mac_nums long",
    )
    full = reach.reach_curve(dist, ["city"])
    curves = {}
    for r in full.orderBy("city", "expose_time").collect():
        curves.setdefault(r.city, []).append(r.mactimes)
    assert {c: v[:4] for c, v in curves.items()} == {
        "a": [6, 2, 2, 0], "b": [5, 0, 0, 0], "c": [7, 7, 0, 0]
    }
    assert all(len(v) == 50 and v == sorted(v, reverse=True) for v in curves.values())
    sparse = reach.reach_curve(dist, ["city"], compat_sparse=True)
    assert sparse.groupBy("city").count().orderBy("city").collect() == [("a", 50), ("b", 1)]
