"""Report queries over the marts: benchmarks, opportunities, content strategy, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.scalars import ratio
from ..operators.joins import lookup_join
from ..operators.ranking import ranked_page
from .marts import Marts


def niche_activity(marts: Marts) -> DataFrame:
    """Mean views per video, recent uploads and views per subscriber by niche."""
    return marts.agg_channel_metrics.groupBy("niche").agg(
        F.avg("avg_views").alias("avg_views_per_video"),
        F.avg("videos_last_30d").alias("avg_uploads_last_30d"),
        F.avg("avg_views_per_sub").alias("avg_views_per_sub"),
    )


def size_mix(marts: Marts) -> DataFrame:
    """Channels per size tier and their share of the niche."""
    counts = marts.agg_channel_metrics.groupBy("niche", "size_tier").agg(
        F.count(F.lit(1)).alias("channels")
    )
    # at most one row per size tier in each window
    share = ratio(F.col("channels"), F.sum("channels").over(Window.partitionBy("niche")))
    return counts.withColumn("share", share)


def subscriber_view_map(marts: Marts) -> DataFrame:
    return marts.agg_channel_metrics.select(
        "channel_id", "channel_name", "niche", "region", "size_tier", "subscriber_count",
        "avg_views",
    )


def most_efficient(marts: Marts, limit: int = fixed.TOP_ROWS) -> DataFrame:
    """Channels with the most views per subscriber."""
    measured = marts.agg_channel_metrics.filter(F.col("avg_views_per_sub").isNotNull())
    order = [F.desc("avg_views_per_sub"), F.asc("channel_id"), F.asc("niche"), F.asc("region")]
    return ranked_page(measured, order, limit).select(
        "rank", "channel_id", "channel_name", "niche", "subscriber_count", "avg_views_per_sub"
    )


def large_underperformers(marts: Marts) -> DataFrame:
    """Large channels with fewer views per subscriber than the mean of their niche."""
    means = marts.agg_channel_metrics.groupBy("niche").agg(
        F.avg("avg_views_per_sub").alias("niche_views_per_sub")
    )
    large = marts.agg_channel_metrics.filter(F.col("size_tier").isin("mega", "large"))
    compared = lookup_join(large, means, "niche", how="inner")
    return compared.filter(F.col("avg_views_per_sub") < F.col("niche_views_per_sub")).select(
        "channel_id", "channel_name", "niche", "size_tier", "subscriber_count",
        "avg_views_per_sub", "niche_views_per_sub",
    )


def content_strategy(marts: Marts) -> DataFrame:
    """Videos and mean performance by duration, tier and live format.

    One pass groups by all three (a few dozen rows at most); the sums and counts
    are then rolled up once per dimension.
    """
    grain = marts.fct_video_performance.groupBy(
        "duration_category", "performance_tier", F.col("was_live").cast("string").alias("was_live")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("view_count").alias("views"),
        F.count("view_count").alias("n_views"),
        F.sum("engagement_rate").alias("engagement"),
        F.count("engagement_rate").alias("n_engagement"),
    )
    dimensions = F.array(
        *[
            F.struct(F.lit(name).alias("dimension"), F.col(name).alias("category"))
            for name in ("duration_category", "performance_tier", "was_live")
        ]
    )
    measures = ["n", "views", "n_views", "engagement", "n_engagement"]
    return (
        grain.select(F.inline(dimensions), *measures)
        .groupBy("dimension", "category")
        .agg(
            F.sum("n").alias("videos"),
            ratio(F.sum("views"), F.sum("n_views")).alias("avg_views"),
            ratio(F.sum("engagement"), F.sum("n_engagement")).alias("avg_engagement"),
        )
    )


def upload_activity(marts: Marts) -> DataFrame:
    return marts.agg_channel_metrics.select(
        "channel_id", "channel_name", "niche", "videos_last_30d", "avg_views"
    )


def coverage(marts: Marts) -> DataFrame:
    """Channels by niche and region with totals; the grand total has niche ``Total``."""
    cells = marts.dim_channels.cube("niche", "region").agg(
        F.count_distinct("channel_id").alias("channels"),
        F.grouping("niche").alias("all_niches"),
        F.grouping("region").alias("all_regions"),
    )
    niche = F.when(F.col("all_niches") == 1, "Total").otherwise(F.col("niche"))

    def cell(test: Column) -> Column:
        return F.coalesce(F.max(F.when(test, F.col("channels"))), F.lit(0))

    one_region = F.col("all_regions") == 0
    return cells.groupBy(niche.alias("niche"), "all_niches").agg(
        cell(one_region & (F.col("region") == "ID")).alias("indonesia"),
        cell(one_region & (F.col("region") == "GLOBAL")).alias("global"),
        cell(F.col("all_regions") == 1).alias("total"),
    ).drop("all_niches")
