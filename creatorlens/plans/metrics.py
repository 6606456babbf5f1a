"""Video metrics, channel summary and niche benchmarks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import days_between, greatest_strict, has_text, ratio
from ..operators.joins import lookup_join

Day = date | Column | None

_RATES = ("engagement_rate", "like_rate", "comment_rate", "views_per_day")
PARTIAL_KEYS = ("channel_id", "channel_name", "niche", "region")
_CHANNEL_KEYS = ("channel_id", "channel_name", "niche", "region", "subscriber_count", "size_tier")


def own_metrics(as_of: Day) -> dict[str, Column]:
    """Measures that need the video alone."""
    views, likes, comments = F.col("view_count"), F.col("like_count"), F.col("comment_count")
    days = days_between(as_of, F.col("upload_date"))
    return {
        "like_rate": ratio(likes, views),
        "comment_rate": ratio(comments, views),
        "engagement_rate": ratio(likes + comments, views),
        "days_since_upload": days,
        "views_per_day": ratio(views, greatest_strict(days, F.lit(1))),
        "title_length": F.length("title"),
        "title_word_count": F.array_size(F.split("title", " ", -1)),
    }


def with_channels(stg_videos: DataFrame, stg_channels: DataFrame) -> DataFrame:
    """Every video, and what its channel adds to it; videos without a channel row stay."""
    channels = stg_channels.select(
        "channel_id",
        F.col("channel_name").alias("_channel_name"),
        "subscriber_count",
        "size_tier",
    )
    return lookup_join(stg_videos, channels, "channel_id")


def video_metrics(stg_videos: DataFrame, stg_channels: DataFrame, as_of: Day = None) -> DataFrame:
    """Every video with its rates; the channel adds name, subscribers and size tier.

    Niche and region are the video's own; videos without a channel row stay.
    """
    return rated(with_channels(stg_videos, stg_channels), as_of)


def rated(joined: DataFrame, as_of: Day = None) -> DataFrame:
    """The video metrics of rows from ``with_channels``, made row by row."""
    own = own_metrics(as_of)
    return joined.select(
        "video_id",
        "title",
        "channel_id",
        F.coalesce("_channel_name", "channel_name").alias("channel_name"),
        "upload_date",
        "duration_seconds",
        "duration_category",
        "view_count",
        "like_count",
        "comment_count",
        "niche",
        "region",
        "upload_day_of_week",
        "upload_year",
        "upload_month",
        "tags",
        "is_live",
        "was_live",
        "subscriber_count",
        "size_tier",
        own["like_rate"].alias("like_rate"),
        own["comment_rate"].alias("comment_rate"),
        own["engagement_rate"].alias("engagement_rate"),
        ratio(F.col("view_count"), F.col("subscriber_count")).alias("views_per_subscriber"),
        own["days_since_upload"].alias("days_since_upload"),
        own["views_per_day"].alias("views_per_day"),
        own["title_length"].alias("title_length"),
        own["title_word_count"].alias("title_word_count"),
    )


def measures(own: dict[str, Column]) -> dict[str, Column]:
    """Measures of a video whose sums and counts make up the means of its channel."""
    return {
        "view_count": F.col("view_count"),
        "duration": F.col("duration_seconds"),
        "title_length": own["title_length"],
        **{rate: own[rate] for rate in _RATES},
    }


def additive(measured: dict[str, Column]) -> list[Column]:
    """What a group of videos adds to its channel, whatever the reporting day."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.max("view_count").alias("max_views"),
        F.min("view_count").alias("min_views"),
        F.min("upload_date").alias("earliest_video"),
        F.max("upload_date").alias("latest_video"),
        F.count_if(F.col("is_live") | F.col("was_live")).alias("n_live"),
        *[F.sum(column).alias(f"sum_{name}") for name, column in measured.items()],
        *[F.count(column).alias(f"n_{name}") for name, column in measured.items()],
    ]


def channel_summary(stg_videos: DataFrame, stg_channels: DataFrame, as_of: Day = None) -> DataFrame:
    """Statistics per channel (and niche and region, which come from the videos).

    Videos are summed up per channel id before they meet the channel table: only
    one partial row per channel and task is shuffled and joined, however many
    videos a channel has. Sums and counts are kept so that means stay exact.
    """
    own = own_metrics(as_of)
    days = own["days_since_upload"]
    partial = stg_videos.groupBy(*PARTIAL_KEYS).agg(
        F.count_if(days <= 30).alias("n_30d"),
        F.count_if(days <= 7).alias("n_7d"),
        *additive(measures(own)),
    )
    return summary_of(partial, stg_channels)


def summary_of(partial: DataFrame, stg_channels: DataFrame) -> DataFrame:
    """The channel summary from partial sums by ``PARTIAL_KEYS``."""
    channels = stg_channels.select(
        "channel_id",
        F.col("channel_name").alias("_channel_name"),
        "subscriber_count",
        "size_tier",
    )
    named = (
        partial.join(channels, "channel_id", "left")
        .withColumn("channel_name", F.coalesce("_channel_name", "channel_name"))
        .filter(has_text(F.col("channel_name")))
    )

    def mean(name: str) -> Column:
        return ratio(F.sum(f"sum_{name}"), F.sum(f"n_{name}"))

    views_per_sub = ratio(
        ratio(F.sum("sum_view_count"), F.col("subscriber_count")), F.sum("n_view_count")
    )
    return named.groupBy(*_CHANNEL_KEYS).agg(
        F.sum("n").alias("total_videos"),
        F.sum("n_30d").alias("videos_last_30d"),
        F.sum("n_7d").alias("videos_last_7d"),
        F.sum("sum_view_count").alias("total_views"),
        mean("view_count").alias("avg_views"),
        F.max("max_views").alias("max_views"),
        F.min("min_views").alias("min_views"),
        mean("engagement_rate").alias("avg_engagement_rate"),
        mean("like_rate").alias("avg_like_rate"),
        mean("comment_rate").alias("avg_comment_rate"),
        views_per_sub.alias("avg_views_per_sub"),
        mean("views_per_day").alias("avg_views_per_day"),
        mean("duration").alias("avg_duration_seconds"),
        mean("title_length").alias("avg_title_length"),
        F.min("earliest_video").alias("earliest_video"),
        F.max("latest_video").alias("latest_video"),
        F.sum("n_live").alias("live_video_count"),
    )


def niche_benchmarks(summary: DataFrame) -> DataFrame:
    """Means over the channels of a niche (means of channel means, not of videos)."""
    return summary.groupBy("niche").agg(
        F.count(F.lit(1)).alias("total_channels"),
        F.count_if(F.col("region") == "ID").alias("id_channels"),
        F.count_if(F.col("region") == "GLOBAL").alias("global_channels"),
        F.avg("subscriber_count").alias("avg_subscribers"),
        F.percentile_approx("subscriber_count", 0.5).alias("median_subscribers"),
        F.avg("avg_views").alias("avg_views_per_video"),
        F.avg("total_views").alias("avg_total_views"),
        F.avg("avg_engagement_rate").alias("avg_engagement_rate"),
        F.avg("avg_like_rate").alias("avg_like_rate"),
        F.avg("avg_comment_rate").alias("avg_comment_rate"),
        F.avg("avg_duration_seconds").alias("avg_duration"),
        F.avg("total_videos").alias("avg_videos_per_channel"),
        F.avg("avg_title_length").alias("avg_title_length"),
        F.avg("videos_last_30d").alias("avg_uploads_last_30d"),
    )
