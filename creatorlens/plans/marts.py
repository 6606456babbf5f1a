"""The star schema: dimension, fact and the two aggregate tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import performance_tier, ratio
from ..operators.joins import lookup_join
from ..sources.tables import Store, save
from . import metrics, staging

Day = date | Column | None


@dataclass(frozen=True)
class Marts:
    dim_channels: DataFrame
    fct_video_performance: DataFrame
    agg_channel_metrics: DataFrame
    agg_niche_overview: DataFrame


def dim_channels(stg_channels: DataFrame) -> DataFrame:
    return stg_channels.select(
        "channel_id",
        "channel_name",
        "channel_url",
        "niche",
        "region",
        "subscriber_count",
        "size_tier",
        "channel_description",
        "scraped_at",
    )


def fct_video_performance(video_metrics: DataFrame, niche_benchmarks: DataFrame) -> DataFrame:
    """Video measures against the benchmark of their niche; keyed to dim_channels."""
    benchmark = niche_benchmarks.select(
        "niche",
        F.col("avg_engagement_rate").alias("_engagement"),
        F.col("avg_views_per_video").alias("_views"),
    )
    compared = lookup_join(video_metrics, benchmark, "niche").withColumns(
        {
            "engagement_vs_benchmark": ratio(F.col("engagement_rate"), F.col("_engagement")),
            "views_vs_benchmark": ratio(F.col("view_count"), F.col("_views")),
        }
    )
    return compared.select(
        "video_id",
        "channel_id",
        "title",
        "upload_date",
        "duration_seconds",
        "duration_category",
        "upload_day_of_week",
        "upload_year",
        "upload_month",
        "tags",
        "is_live",
        "was_live",
        "niche",
        "region",
        "view_count",
        "like_count",
        "comment_count",
        "like_rate",
        "comment_rate",
        "engagement_rate",
        "views_per_subscriber",
        "views_per_day",
        "days_since_upload",
        "title_length",
        "title_word_count",
        "engagement_vs_benchmark",
        "views_vs_benchmark",
        performance_tier(F.col("views_vs_benchmark")).alias("performance_tier"),
    )


def build(
    raw_channels: DataFrame,
    raw_videos: DataFrame,
    store: Store,
    as_of: Day = None,
    *,
    cluster_fact: bool = True,
) -> Marts:
    """Write all four marts, each once, and return them as read back.

    The wide video table is scanned twice: a narrow pass for the aggregates and
    one pass for the fact. Later steps read the small tables already written, so
    nothing is computed twice and the size of every lookup is known before a join.
    ``cluster_fact`` range-partitions the fact by niche and channel (one more shuffle),
    which lets pages of one niche or channel read a few files only; hot channels are split.
    What is made of a row is made after that shuffle: its rates are never shuffled.
    """
    channels = save(staging.stg_channels(raw_channels), store, "stg_channels")
    videos = staging.stg_videos(raw_videos)
    dimension = save(dim_channels(channels), store, "dim_channels")
    summary = save(metrics.channel_summary(videos, channels, as_of), store, "agg_channel_metrics")
    niches = save(metrics.niche_benchmarks(summary), store, "agg_niche_overview")
    joined = metrics.with_channels(videos, channels)
    layout = ("niche", "channel_id", "video_id")
    if cluster_fact:
        joined = joined.repartitionByRange(*layout)
    fact = fct_video_performance(metrics.rated(joined, as_of), niches)
    if cluster_fact:
        fact = fact.sortWithinPartitions(*layout)
    return Marts(dimension, save(fact, store, "fct_video_performance"), summary, niches)


def layer_views(
    raw_channels: DataFrame, raw_videos: DataFrame, as_of: Day = None
) -> dict[str, DataFrame]:
    """Staging and intermediate models by name, lazy: publish them to query them in SQL."""
    channels, videos = staging.stg_channels(raw_channels), staging.stg_videos(raw_videos)
    summary = metrics.channel_summary(videos, channels, as_of)
    return {
        "stg_channels": channels,
        "stg_videos": videos,
        "int_video_metrics": metrics.video_metrics(videos, channels, as_of),
        "int_channel_summary": summary,
        "int_niche_benchmarks": metrics.niche_benchmarks(summary),
    }
