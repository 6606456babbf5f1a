"""Pivots and unpivots of small grouped results, always with explicit pivot values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import display
from ..functions import fixed_values as fixed


def literal_rows(spark: SparkSession, **columns: Sequence) -> DataFrame:
    """A fixed list of rows, given column by column, with a ``place`` to order by."""
    rows = [
        F.struct(*[F.lit(value).alias(name) for name, value in zip(columns, values)])
        for values in zip(*columns.values())
    ]
    return spark.range(1).select(F.posexplode(F.array(*rows)).alias("place", "row")).select(
        "place", "row.*"
    )


def niche_radar(niche_overview: DataFrame, niches: Sequence[str] = fixed.NICHES) -> DataFrame:
    """Measures of every niche as a share (0-100) of the largest; one row per measure."""
    measures = [
        F.struct(
            F.lit(place).alias("place"),
            F.lit(label).alias("metric"),
            F.coalesce(F.col(name), F.lit(0.0)).alias("value"),
            F.lit(least).alias("least"),
        )
        for place, (label, name, least) in enumerate(fixed.RADAR_MEASURES)
    ]
    long = niche_overview.select("niche", F.inline(F.array(*measures)))
    largest = long.groupBy("metric").agg(
        F.greatest(F.max("value"), F.max("least")).alias("largest")
    )
    # one row per measure
    scaled = long.join(F.broadcast(largest), "metric")
    score = display.round_half_up(F.col("value") / F.col("largest") * 100)
    shaped = (
        scaled.withColumn("score", score)
        .groupBy("place", "metric")
        .pivot("niche", list(niches))
        .agg(F.first("score"))
    )
    return shaped.orderBy("place").drop("place")


def _shape(
    grouped: DataFrame, key: str, rows: DataFrame, value: str, niches: Sequence[str]
) -> DataFrame:
    """Grouped values as niche columns under a fixed list of rows, all present."""
    wide = grouped.groupBy(key).pivot("niche", list(niches)).agg(F.first(value))
    return rows.join(wide, key, "left").orderBy("place")


def duration_pivot(duration_analysis: DataFrame, niches: Sequence[str] = fixed.NICHES) -> DataFrame:
    categories = [category for category, _ in fixed.DURATION_LABELS]
    rows = literal_rows(duration_analysis.sparkSession, duration_category=categories)
    shaped = _shape(duration_analysis, "duration_category", rows, "avg_views", niches)
    label = display.duration_label(F.col("duration_category"))
    return shaped.select(label.alias("duration"), *niches)


def upload_day_pivot(upload_days: DataFrame, niches: Sequence[str] = fixed.NICHES) -> DataFrame:
    rows = literal_rows(
        upload_days.sparkSession,
        upload_day_of_week=list(range(1, len(fixed.DAY_NAMES) + 1)),
    )
    shaped = _shape(upload_days, "upload_day_of_week", rows, "count", niches)
    return shaped.select(display.day_label(F.col("upload_day_of_week")).alias("day"), *niches)


def id_vs_global(niche_region: DataFrame) -> DataFrame:
    wide = niche_region.groupBy("niche").pivot("region", list(fixed.REGIONS))
    means = wide.agg(F.first("avg_views"))

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0))

    return means.select("niche", or_zero("ID").alias("Indonesia"), or_zero("GLOBAL").alias("Global"))


def niche_cards(niche_overview: DataFrame) -> DataFrame:
    """One card of formatted benchmark values per niche."""
    regions = F.concat(
        F.col("id_channels").cast("string"), F.lit(" / "), F.col("global_channels").cast("string")
    )
    uploads = F.coalesce("avg_uploads_last_30d", F.lit(0.0))
    return niche_overview.select(
        "niche",
        "total_channels",
        regions.alias("indonesia_global"),
        display.compact_number(F.col("avg_subscribers")).alias("avg_subscribers"),
        display.compact_number(F.col("avg_views_per_video")).alias("avg_views_per_video"),
        display.percent(F.col("avg_engagement_rate")).alias("engagement_rate"),
        display.percent(F.col("avg_like_rate")).alias("like_rate"),
        display.minutes_text(F.col("avg_duration")).alias("avg_duration"),
        display.fixed_point(uploads, 1).alias("uploads_30d"),
    )
