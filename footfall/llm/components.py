"""Connected components of an edge table that grows with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators.spread import spread_join

from .common import Scratch

# Nodes with more links than this are joined in parts.
MOST_LINKS = 10_000


def split_join(
    large: DataFrame, small: DataFrame, on: str, most: int, counts: DataFrame | None = None
) -> DataFrame:
    """Inner sort-merge join by a key that is unique in ``small``. ``most`` is the number of rows
    of the largest key of ``large`` as far as it joins; if that is more than MOST_LINKS, keys
    with so many rows are split over tasks (``counts`` may give the rows, ``_rows``, of each)."""
    if most > MOST_LINKS:
        if counts is not None:
            counts = counts.select(on, "_rows")
        return spread_join(large, small, [on], "inner", counts, min_rows=max(MOST_LINKS, 1))
    return large.join(small.hint("merge"), on)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node it reaches.

    Alternates two steps until only stars are left: each node links its larger neighbours to its
    smallest one, then its smaller ones. The number of rounds grows with the logarithm of the
    longest path; every round is a written table, so a lost executor repeats one round at most.
    """
    small, large = F.least("a", "b"), F.greatest("a", "b")
    links = scratch.write(
        edges.where("a <> b").select(large.alias("v"), small.alias("u")).distinct()
    )
    while True:
        stars, degree = _shape(links)
        if stars:
            break
        before = links
        links = scratch.write(_towards_smaller(_towards_larger(links, degree), degree))
        scratch.drop(before)
    roots = links.select(F.col("u").alias("node")).distinct()
    return links.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
        roots.withColumn("root", F.col("node"))
    )


def _shape(links: DataFrame) -> tuple[bool, int]:
    """Whether every node has one link, to a node that has none (then all is settled), and the
    most links of a node."""
    one, none = F.lit(1), F.lit(0)
    ends = links.select(F.col("v").alias("node"), one.alias("up"), none.alias("down")).unionByName(
        links.select(F.col("u").alias("node"), none.alias("up"), one.alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    up, both, degree = nodes.agg(
        F.max("up"), F.max(F.least("up", "down")), F.max(F.col("up") + F.col("down"))
    ).first()
    return (up or 0) <= 1 and not both, degree or 0


def _towards_larger(links: DataFrame, degree: int) -> DataFrame:
    """Each node links its larger neighbours to the smallest node it knows. The links of nodes
    that have very many are split over tasks."""
    both = links.unionByName(links.select(F.col("u").alias("v"), F.col("v").alias("u")))
    least = both.groupBy("v").agg(F.least("v", F.min("u")).alias("m"))
    met = split_join(both, least, "v", degree)
    return met.where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()


def _towards_smaller(links: DataFrame, degree: int) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them. It has at most
    as many as it had links before (``degree``)."""
    least = links.groupBy("v").agg(F.min("u").alias("m"))
    met = split_join(links, least, "v", degree)
    moved = met.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
    return moved.unionByName(least.select("v", F.col("m").alias("u"))).distinct()
