"""Cleaned views over the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import duration_category, size_tier
from ..operators.ranking import first_per_key

# the newest snapshot first; the rest only settles ties
_NEWEST = (
    "scraped_at",
    "subscriber_count",
    "channel_name",
    "config_name",
    "niche",
    "region",
    "channel_url",
    "description",
)


def newest_first() -> list[Column]:
    """The order of a channel's snapshots; no two different ones are equal in it."""
    return [F.col(name).desc_nulls_last() for name in _NEWEST]


def stg_channels(raw_channels: DataFrame) -> DataFrame:
    """Latest snapshot of every channel that has an id and a name."""
    keyed = raw_channels.filter(F.col("channel_id").isNotNull())
    latest = first_per_key(keyed, ["channel_id"], newest_first())
    name = F.coalesce("channel_name", "config_name")
    return latest.filter(F.coalesce(name, F.lit("")) != "").select(
        "channel_id",
        name.alias("channel_name"),
        "channel_url",
        "subscriber_count",
        F.col("description").alias("channel_description"),
        "niche",
        "region",
        "config_name",
        F.col("scraped_at").cast("timestamp").alias("scraped_at"),
        size_tier(F.col("subscriber_count")).alias("size_tier"),
    )


def stg_videos(raw_videos: DataFrame, *, dedupe: bool = False) -> DataFrame:
    """Typed videos with an id. ``dedupe`` keeps the latest scrape of each video."""
    keyed = raw_videos.filter(F.col("video_id").isNotNull())
    if dedupe:
        order = [F.col("scraped_at").desc_nulls_last(), F.xxhash64(*raw_videos.columns)]
        keyed = first_per_key(keyed, ["video_id"], order)
    uploaded = F.col("upload_date").cast("date")
    return keyed.select(
        "video_id",
        "title",
        "description",
        "channel_name",
        "channel_id",
        "channel_url",
        uploaded.alias("upload_date"),
        "duration_seconds",
        "view_count",
        "like_count",
        "comment_count",
        "tags",
        "categories",
        "thumbnail_url",
        "language",
        "is_live",
        "was_live",
        "niche",
        "region",
        F.col("scraped_at").cast("timestamp").alias("scraped_at"),
        duration_category(F.col("duration_seconds")).alias("duration_category"),
        F.dayofweek(uploaded).alias("upload_day_of_week"),
        F.year(uploaded).alias("upload_year"),
        F.month(uploaded).alias("upload_month"),
    )
