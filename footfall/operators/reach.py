"""Frequency distribution and N+ reach of exposures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators.spread import lookup_join

LEVELS = 50


def freq_dist(
    exposures: DataFrame, keys: list[str], grain: list[str] | None = None
) -> DataFrame:
    """How many keys have each number of exposures: (grain, expose_time, mac_nums).

    ``keys`` identify a contact pair and must include the grain columns.
    """
    grain = grain or []
    return (
        exposures.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("expose_time"))
        .groupBy(*grain, "expose_time")
        .agg(F.count(F.lit(1)).alias("mac_nums"))
    )


def reach_curve(
    distribution: DataFrame,
    grain: list[str] | None = None,
    levels: int = LEVELS,
    compat_sparse: bool = False,
) -> DataFrame:
    """Keys with at least n exposures, n = 1..levels: (grain, expose_time, mactimes).

    Works on the distribution, which holds one row per grain and count. With
    ``compat_sparse`` a grain without any single exposure is left out, and one with nothing
    but single exposures has only n = 1.
    """
    grain = grain or []
    reached = F.when(F.col("expose_time") >= F.col("_n"), F.col("mac_nums")).otherwise(0)
    curve = (
        distribution.select(
            "*", F.explode(F.sequence(F.lit(1), F.lit(levels))).alias("_n")
        )
        .groupBy(*grain, F.col("_n"))
        .agg(
            F.sum(reached).alias("mactimes"),
            F.min("expose_time").alias("_fewest"),
            F.max("expose_time").alias("_most"),
        )
    )
    if compat_sparse:
        curve = curve.where(
            (F.col("_fewest") == 1) & ((F.col("_most") > 1) | (F.col("_n") == 1))
        )
    return curve.select(*grain, F.col("_n").alias("expose_time"), "mactimes")


def reach_by_ad(
    views: DataFrame, ad_info: DataFrame, levels: int = LEVELS
) -> DataFrame:
    """Reach per city and ad over plain rows, without exposure logic. Rows whose ad has no
    name in ``ad_info`` are left out."""
    names = (
        ad_info.where(F.col("adcontent") != "")
        .groupBy(F.col("adcontent_id").alias("ad_content_id"))
        .agg(F.max("adcontent").alias("ad_content"))
    )
    # Counted per ad id before the lookup; ids that share a name are added up after it.
    per_id = (
        views.where(
            F.col("ad_content_id").isNotNull()
            & F.col("city_name").isNotNull()
            & F.col("scan_time").isNotNull()
        )
        .groupBy("city_name", "devid", "mac", "ad_content_id")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    grain = ["city_name", "ad_content"]
    distribution = (
        lookup_join(per_id, names, ["ad_content_id"], "inner", ad_info)
        .groupBy(*grain, "devid", "mac")
        .agg(F.sum("_n").alias("expose_time"))
        .groupBy(*grain, "expose_time")
        .agg(F.count("mac").alias("mac_nums"))
    )
    return reach_curve(distribution, grain, levels)
