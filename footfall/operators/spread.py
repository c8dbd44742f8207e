"""Joins that stay balanced when a few keys hold much of the data.

Salts are hashes of row content, never random or positional numbers: a task that is
run again after an executor is lost then sends every row to the same place.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds at least 1/PIECES of the rows, so at most PIECES keys are hot.
PIECES = 1000

# Keys with fewer rows than this are no burden to one task and are never split.
MIN_ROWS = 100_000

# Lists estimated to have up to this many bytes are broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024

# How much wider the buckets of very long spans are.
WIDER = 10_000

# Rows with a null key match nothing; they are only scattered over this many parts.
NULL_PARTS = 64


def key_counts(df: DataFrame, on: list[str]) -> DataFrame:
    """Rows per key, as ``_rows``."""
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))


def hot_keys(
    counts: DataFrame, on: list[str], pieces: int = PIECES, min_rows: int = MIN_ROWS
) -> DataFrame:
    """Keys with at least 1/pieces of all rows, and no less than ``min_rows``, with the parts
    to split each into.

    ``counts`` has one ``_rows`` per key. Whatever the data size, no more than
    ``pieces`` keys can qualify, which is what makes the result safe to broadcast.
    """
    total = counts.agg(F.sum("_rows")).scalar()
    rows = F.col("_rows")
    parts = F.least(rows * pieces / total, rows / F.lit(min_rows))
    return counts.where((rows * pieces >= total) & (rows >= min_rows)).select(
        *on, F.ceil(parts).cast("int").alias("_parts")
    )


def salt_large(
    df: DataFrame, on: list[str], hot: DataFrame, by: list[str] | None = None
) -> DataFrame:
    """Add ``_salt``: hot keys are scattered over their parts, other keys get 0. Rows that agree
    in ``by`` (all columns if not given) stay together."""
    spot = F.xxhash64(*(by or df.columns))
    no_key = reduce(or_, [F.col(c).isNull() for c in on])
    salt = (
        F.when(F.col("_parts").isNotNull(), F.pmod(spot, F.col("_parts")))
        .when(no_key, F.pmod(spot, F.lit(NULL_PARTS)))
        .otherwise(F.lit(0))
    )
    return (
        df.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", salt.cast("int"))
        .drop("_parts")
    )


def salt_small(df: DataFrame, on: list[str], hot: DataFrame) -> DataFrame:
    """Add ``_salt``: rows of hot keys are repeated once per part."""
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    return (
        df.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("_parts")
    )


def spread_join(
    large: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str,
    counts: DataFrame | None = None,
    pieces: int = PIECES,
    min_rows: int = MIN_ROWS,
    opened: bool = False,
) -> DataFrame:
    """Shuffle join in which no key of ``large`` puts more than 1/pieces of it (or
    ``min_rows``, if that is more) in one task.

    ``how`` is inner, left, left_semi or left_anti. ``counts`` may pass rows per key that
    the caller has already defined, so that the plan shares that aggregation.

    ``opened`` says that ``small`` was opened out of fewer rows. Spark estimates such a list by
    the files before it was opened, and once no key turns out to be hot may broadcast it by that
    estimate, if its own shuffle has not ended by then. Such a list is always shuffled.
    """
    hot = hot_keys(key_counts(large, on) if counts is None else counts, on, pieces, min_rows)
    listed = salt_small(small, on, hot)
    return (
        salt_large(large, on, hot)
        .join(listed.hint("merge") if opened else listed, [*on, "_salt"], how)
        .drop("_salt")
    )


def estimated_bytes(df: DataFrame) -> int:
    """Spark's estimate of a plan's size, from file sizes and the plan alone: no job runs. It
    errs on the large side for joins and filters."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(stats.sizeInBytes())


def source_bytes(*tables: DataFrame) -> int:
    """Bytes of the files (or local rows) that tables are made from. Unlike an estimate of a plan
    this does not multiply the sides of a join."""
    total = 0
    for df in tables:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        total += sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return total


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str,
    source: DataFrame | tuple[DataFrame, ...] = (),
    most: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join facts with a list: broadcast if the list has no more than ``most`` bytes; otherwise a
    shuffle join that splits the facts' hot keys.

    ``source`` names the tables that the list was made from by filters, groups and lookups by
    key, none of which makes rows: if their files are short enough, so is the list. Without them
    Spark's estimate of the list's own plan counts, which multiplies the sides of every join.

    Spark's own skew handling does not cover these joins: it leaves alone a join whose list
    side was just grouped by the join key.
    """
    sources = (source,) if isinstance(source, DataFrame) else source
    if (sources and source_bytes(*sources) <= most) or estimated_bytes(dim) <= most:
        return facts.join(F.broadcast(dim), on, how)
    return spread_join(facts, dim, on, how)


def bucket_join(
    points: DataFrame,
    spans: DataFrame,
    on: list[str],
    point: str,
    span_from: str,
    span_to: str,
    width: int,
    hot: DataFrame | None = None,
    hot_side: str = "spans",
    longest: int | None = None,
) -> DataFrame:
    """Inner join of points with the half-open spans [span_from, span_to) that hold them.

    Time is cut into buckets of ``width``: a point lies in one bucket and a span in every
    bucket it touches, so the join is an equi-join with a residual range test and yields
    each pair once. Choose ``width`` no smaller than the usual span. ``hot`` splits the hot
    ``on`` keys of ``hot_side`` further; the other side is repeated for those keys only.

    With ``longest``, spans of more than so many buckets are joined on buckets WIDER times as
    wide, so that a few corrupt ends do not multiply rows. No span is cut.
    """
    if longest is not None:
        far = F.col(span_to) - F.col(span_from) > longest * width
        args = (on, point, span_from, span_to)
        near = bucket_join(points, spans.where(~far), *args, width, hot, hot_side)
        wide = bucket_join(points, spans.where(far), *args, width * WIDER, hot, hot_side)
        return near.unionByName(wide)

    def bucket(value: Column) -> Column:
        return F.call_function("div", value, F.lit(width))

    p = points.withColumn("_bucket", bucket(F.col(point)))
    s = spans.where(F.col(span_to) > F.col(span_from))
    if hot is not None:
        p = salt_large(p, on, hot) if hot_side == "points" else salt_small(p, on, hot)
        s = salt_small(s, on, hot) if hot_side == "points" else salt_large(s, on, hot)
    s = s.withColumn(
        "_bucket",
        F.explode(F.sequence(bucket(F.col(span_from)), bucket(F.col(span_to) - 1))),
    )
    keys = [*on, "_bucket"] + (["_salt"] if hot is not None else [])
    inside = (F.col(point) >= F.col(span_from)) & (F.col(point) < F.col(span_to))
    return p.join(s, keys, "inner").where(inside).drop("_bucket", "_salt")
