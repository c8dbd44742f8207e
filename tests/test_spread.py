"""Skew-safe joins give the plain join's rows and do split a hot key."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from footfall.operators import spread


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 300)}", i) for i in range(4000)]
    data += [(None, -1), (None, -2)]
    return spark.createDataFrame(data, "k string, v long")


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame(
        [("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(0, 300, 2)], "k string, w int"
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_plain_join(skewed, lookup, how):
    plain = skewed.join(lookup, ["k"], how)
    out = spread.spread_join(skewed, lookup, ["k"], how, pieces=20, min_rows=1)
    assert rows(out.select(*plain.columns)) == rows(plain)


def test_hot_keys_are_few_and_split(skewed):
    hot = spread.hot_keys(spread.key_counts(skewed, ["k"]), ["k"], pieces=20, min_rows=1)
    found = {r.k: r._parts for r in hot.collect()}
    assert set(found) == {"hot"} and found["hot"] in (8, 9)
    salted = spread.salt_large(skewed, ["k"], hot)
    sizes = [r["count"] for r in salted.groupBy("k", "_salt").count().collect()]
    assert max(sizes) < 1.5 * 4002 / 20


def test_salt_is_a_function_of_the_row(skewed):
    hot = spread.hot_keys(spread.key_counts(skewed, ["k"]), ["k"], pieces=20, min_rows=1)
    once = rows(spread.salt_large(skewed, ["k"], hot))
    again = rows(spread.salt_large(skewed.repartition(5), ["k"], hot))
    assert once == again


@pytest.mark.parametrize("side", [None, "spans", "points"])
@pytest.mark.parametrize("width", [7, 60, 1000])
def test_bucket_join_is_the_range_join(spark, side, width):
    rng = random.Random(4)
    points = spark.createDataFrame(
        [(rng.choice("aaab"), rng.randint(0, 2000), i) for i in range(600)],
        "k string, t long, i int",
    )
    spans = spark.createDataFrame(
        [(rng.choice("aab"), s, s + rng.choice([0, 1, 5, 60, 400]), j)
         for j in range(200) for s in [rng.randint(0, 2000)]],
        "k string, a long, b long, j int",
    )
    hot = None
    if side:
        large = spans if side == "spans" else points
        hot = spread.hot_keys(spread.key_counts(large, ["k"]), ["k"], pieces=4, min_rows=1)
    out = spread.bucket_join(points, spans, ["k"], "t", "a", "b", width, hot, side or "spans")
    all_spans = spans.collect()
    want = sorted(
        (p.i, s.j) for p in points.collect() for s in all_spans if p.k == s.k and s.a <= p.t < s.b
    )
    assert sorted((r.i, r.j) for r in out.collect()) == want


def test_broadcast_side_is_bounded_by_construction(spark):
    """However many keys there are, no more than ``pieces`` of them can be hot."""
    df = spark.range(5000).select((F.col("id") % 10).cast("string").alias("k"))
    hot = spread.hot_keys(spread.key_counts(df, ["k"]), ["k"], pieces=10, min_rows=1)
    assert hot.count() == 10
    many = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    assert spread.hot_keys(spread.key_counts(many, ["k"]), ["k"], pieces=1000, min_rows=1).count() == 0


def test_small_keys_are_left_whole(skewed):
    assert spread.hot_keys(spread.key_counts(skewed, ["k"]), ["k"], pieces=20).count() == 0
    few = spread.hot_keys(spread.key_counts(skewed, ["k"]), ["k"], pieces=20, min_rows=500)
    assert [r._parts for r in few.collect()] == [4]
