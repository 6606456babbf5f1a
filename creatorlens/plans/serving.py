"""Dashboard queries over the marts. All take and return DataFrames.

Sort arguments are allow-listed and filters are column predicates; no text is
interpolated into SQL. Every ordered result ends in a key, so ties are stable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import display
from ..functions import fixed_values as fixed
from ..functions.scalars import ratio
from ..operators.joins import top_with_lookup
from ..operators.ranking import ranked, ranked_page, top
from ..sources.workspace import materialize
from .marts import Marts


def _matching(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Rows equal to every given value; empty or missing values do not filter."""
    for name, value in wanted.items():
        if value:
            df = df.filter(F.col(name) == value)
    return df


def _descending(sort: str, allowed: Sequence[str], *ties: str) -> list[Column]:
    if sort not in allowed:
        raise ValueError(f"sort must be one of {', '.join(allowed)}")
    return [F.desc_nulls_last(sort), *[F.asc_nulls_first(name) for name in ties]]


# One pass over the fact gives sums and counts per channel and a few small
# dimensions; page queries add them up. A hot channel is summed up before any
# shuffle, and pages that show several of these results read the fact once.


def _sums(*means: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        *[F.sum(name).alias(f"sum_{name}") for name in means],
        *[F.count(name).alias(f"n_{name}") for name in means],
    ]


def _mean(name: str) -> Column:
    return ratio(F.sum(f"sum_{name}"), F.sum(f"n_{name}"))


def channel_rollup(marts: Marts) -> DataFrame:
    """Sums of the fact by niche, region, performance tier and channel."""
    keys = ("niche", "region", "performance_tier", "channel_id")
    measures = ("view_count", "like_count", "comment_count", "engagement_rate", "like_rate")
    return marts.fct_video_performance.groupBy(*keys).agg(*_sums(*measures))


def content_rollup(marts: Marts) -> DataFrame:
    """Sums of the fact by niche, duration category and weekday."""
    keys = ("niche", "duration_category", "upload_day_of_week")
    return marts.fct_video_performance.groupBy(*keys).agg(*_sums("view_count", "engagement_rate"))


def _totals(*, views: bool = False, likes: bool = False) -> list[Column]:
    columns = [
        F.count_distinct("channel_id").alias("channels"),
        F.sum("n").alias("videos"),
        F.sum("sum_view_count").alias("total_views"),
        _mean("engagement_rate").alias("avg_engagement"),
    ]
    if views:
        columns.append(_mean("view_count").alias("avg_views"))
    if likes:
        columns.append(_mean("like_rate").alias("avg_like_rate"))
    return columns


# overview


def overview_kpis(rollup: DataFrame) -> DataFrame:
    return rollup.agg(
        F.count_distinct("channel_id").alias("total_channels"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_videos"),
        F.sum("sum_view_count").alias("total_views"),
        F.sum("sum_like_count").alias("total_likes"),
        F.sum("sum_comment_count").alias("total_comments"),
        _mean("engagement_rate").alias("avg_engagement_rate"),
    )


def overview_by_niche(rollup: DataFrame) -> DataFrame:
    by_niche = rollup.groupBy("niche").agg(*_totals(views=True))
    return by_niche.orderBy(F.desc_nulls_last("total_views"), "niche")


def overview_by_region(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("region").agg(*_totals())


def overview_tiers(marts: Marts) -> DataFrame:
    tiers = marts.fct_video_performance.groupBy("performance_tier")
    return tiers.agg(F.count(F.lit(1)).alias("count"))


def overview_cards(kpis: DataFrame) -> DataFrame:
    """The KPI row as shown; these number formats have no zero guard."""
    return kpis.select(
        "total_channels",
        display.compact_number(F.col("total_videos"), guarded=False).alias("total_videos"),
        display.compact_number(F.col("total_views"), guarded=False).alias("total_views"),
        display.compact_number(F.col("total_likes"), guarded=False).alias("total_likes"),
        display.percent(F.col("avg_engagement_rate"), guarded=False).alias("avg_engagement"),
    )


def overview_page(marts: Marts) -> dict[str, DataFrame]:
    """Everything the overview shows; the fact is read once for all totals."""
    rollup = materialize(channel_rollup(marts), "overview")
    tiers = rollup.groupBy("performance_tier").agg(F.sum("n").alias("count"))
    return {
        "kpis": overview_kpis(rollup),
        "by_niche": overview_by_niche(rollup),
        "top_videos": overview_top_videos(marts),
        "by_region": overview_by_region(rollup),
        "tiers": tiers,
    }


def overview_top_videos(marts: Marts, limit: int = fixed.TOP_ROWS) -> DataFrame:
    names = marts.dim_channels.select("channel_id", "channel_name")
    fact = marts.fct_video_performance.select(
        "channel_id", "video_id", "title", "niche", "region", "view_count", "like_count",
        "engagement_rate", "performance_tier", "upload_date",
    )
    order = _descending("view_count", fixed.VIDEO_SORTS, "video_id")
    return top_with_lookup(fact, names, "channel_id", order, limit).drop("channel_id")


# channels


def channel_leaderboard(
    marts: Marts,
    niche: str | None = None,
    region: str | None = None,
    sort: str = "subscriber_count",
    limit: int = fixed.DEFAULT_LIMIT,
) -> DataFrame:
    ties = ("channel_id", "niche", "region", "channel_name")
    order = _descending(sort, fixed.CHANNEL_SORTS, *ties)
    described = marts.dim_channels.select("channel_id", "channel_url", "channel_description")
    metrics = _matching(marts.agg_channel_metrics, niche=niche, region=region)
    return top_with_lookup(metrics, described, "channel_id", order, limit)


def leaderboard_chart(leaderboard: DataFrame, sort: str = "subscriber_count") -> DataFrame:
    """The first bars of a leaderboard: short name, selected measure, niche.

    An unknown measure shows subscribers; a missing value is 0.
    """
    measure = sort if sort in fixed.CHANNEL_SORTS else "subscriber_count"
    ties = ("channel_id", "niche", "region", "channel_name")
    order = _descending(measure, fixed.CHANNEL_SORTS, *ties)
    return ranked_page(leaderboard, order, fixed.CHART_ROWS).select(
        "rank",
        display.ellipsize(F.col("channel_name"), 18).alias("name"),
        F.coalesce(F.col(measure).cast("double"), F.lit(0.0)).alias("value"),
        "niche",
    )


def leaderboard_table(
    leaderboard: DataFrame, sort: str = "subscriber_count", limit: int = fixed.PAGE_LIMIT
) -> DataFrame:
    """A leaderboard as shown: rank, labels and formatted numbers."""
    ties = ("channel_id", "niche", "region", "channel_name")
    order = _descending(sort, fixed.CHANNEL_SORTS, *ties)
    return ranked_page(leaderboard, order, limit).select(
        "rank",
        "channel_id",
        "channel_name",
        "niche",
        display.region_label(F.col("region")).alias("region"),
        "size_tier",
        display.compact_number(F.col("subscriber_count")).alias("subscribers"),
        display.compact_number(F.col("total_views")).alias("total_views"),
        display.compact_number(F.col("avg_views")).alias("avg_views"),
        display.percent(F.col("avg_engagement_rate")).alias("engagement"),
        "videos_last_30d",
    )


# one channel


def channel_info(marts: Marts, channel_id: str) -> DataFrame:
    """The dimension row; empty when the channel is unknown."""
    return marts.dim_channels.filter(F.col("channel_id") == channel_id)


def channel_metrics(marts: Marts, channel_id: str) -> DataFrame:
    """The aggregate row of a channel (its first niche and region), or no row."""
    rows = marts.agg_channel_metrics.filter(F.col("channel_id") == channel_id)
    order = ["niche", "region", "channel_name"]
    return top(rows, [F.asc_nulls_first(name) for name in order], 1)


_CHANNEL_VIDEO_COLUMNS = (
    "video_id", "title", "upload_date", "view_count", "like_count", "comment_count",
    "duration_seconds", "duration_category", "engagement_rate", "views_per_day",
    "performance_tier", "views_vs_benchmark",
)
_MOST_VIEWED = ("view_count", fixed.VIDEO_SORTS, "video_id")


def _videos_of(marts: Marts, channel_id: str) -> DataFrame:
    rows = marts.fct_video_performance.filter(F.col("channel_id") == channel_id)
    return rows.select(*_CHANNEL_VIDEO_COLUMNS)


def channel_videos(marts: Marts, channel_id: str) -> DataFrame:
    """All videos of a channel, most viewed first."""
    return _videos_of(marts, channel_id).orderBy(*_descending(*_MOST_VIEWED))


def channel_videos_table(marts: Marts, channel_id: str) -> DataFrame:
    """All videos of a channel as shown, with their place; any number of videos."""
    rows = ranked(_videos_of(marts, channel_id), _descending(*_MOST_VIEWED))
    return rows.select(
        "rank",
        "video_id",
        display.ellipsize(F.col("title"), 55).alias("title"),
        display.watch_link(F.col("video_id")).alias("link"),
        display.compact_number(F.col("view_count")).alias("views"),
        display.compact_number(F.col("like_count")).alias("likes"),
        display.percent(F.col("engagement_rate")).alias("engagement"),
        display.compact_number(F.col("views_per_day")).alias("views_per_day"),
        display.duration_text(F.col("duration_seconds")).alias("duration"),
        "performance_tier",
        display.day_text(F.col("upload_date")).alias("date"),
    ).orderBy("rank")


def _niche_of(marts: Marts, channel_id: str) -> DataFrame:
    return channel_info(marts, channel_id).select("niche").limit(1)


def channel_benchmark(marts: Marts, channel_id: str) -> DataFrame:
    """Benchmark row of the channel's niche, or no row."""
    niche = F.broadcast(_niche_of(marts, channel_id))  # one row
    return marts.agg_niche_overview.join(niche, "niche", "left_semi")


def channel_peers(marts: Marts, channel_id: str, limit: int = fixed.TOP_ROWS) -> DataFrame:
    """Largest channels of the same niche, with their place and a self flag."""
    own = channel_info(marts, channel_id).limit(1)
    own = own.select("niche", F.col("channel_name").alias("_own_name"))
    peers = marts.agg_channel_metrics.join(F.broadcast(own), "niche")  # one row
    ties = ("channel_id", "region", "channel_name")
    order = _descending("subscriber_count", fixed.CHANNEL_SORTS, *ties)
    return ranked_page(peers, order, limit).select(
        "rank",
        "channel_name",
        "subscriber_count",
        "avg_views",
        "avg_engagement_rate",
        (F.col("channel_name") == F.col("_own_name")).alias("is_self"),
    )


def channel_peers_table(peers: DataFrame) -> DataFrame:
    return peers.select(
        "rank",
        F.when(F.col("is_self"), F.concat("channel_name", F.lit(" ← You")))
        .otherwise(F.col("channel_name"))
        .alias("channel"),
        display.compact_number(F.col("subscriber_count")).alias("subscribers"),
        display.compact_number(F.col("avg_views")).alias("avg_views"),
        display.percent(F.col("avg_engagement_rate")).alias("engagement"),
    )


def channel_cards(marts: Marts, channel_id: str) -> DataFrame:
    """KPI row of one channel as shown; empty when it has no aggregate row."""
    info = channel_info(marts, channel_id).limit(1)
    subscribers = display.compact_number(F.col("subscriber_count"))
    shown = info.select("channel_id", "channel_name", subscribers.alias("subscribers"))
    metrics = channel_metrics(marts, channel_id).drop("channel_name")
    return shown.join(metrics, "channel_id").select(
        "channel_name",
        "subscribers",
        display.compact_number(F.col("total_views")).alias("total_views"),
        display.compact_number(F.col("avg_views")).alias("avg_views"),
        display.percent(F.col("avg_engagement_rate")).alias("engagement"),
        "total_videos",
    )


def channel_vs_benchmark(marts: Marts, channel_id: str) -> DataFrame:
    """Channel measures over niche measures: one row per measure.

    The ratio is 0 where the benchmark is not above 0; empty without both rows.
    """
    niche = channel_info(marts, channel_id).select("channel_id", F.col("niche").alias("_niche"))
    own_row = channel_metrics(marts, channel_id).drop("niche").join(niche.limit(1), "channel_id")
    benchmark = channel_benchmark(marts, channel_id).select(
        F.col("niche").alias("_niche"), F.struct("*").alias("b")
    )
    pairs = [
        F.struct(
            F.lit(label).alias("metric"),
            F.col(own).cast("double").alias("channel"),
            F.col("b")[other].cast("double").alias("niche"),
        )
        for label, own, other in fixed.COMPARED_MEASURES
    ]
    rows = own_row.join(benchmark, "_niche").select(F.inline(F.array(*pairs)))
    quotient = F.when(F.col("niche") > 0, F.col("channel") / F.col("niche"))
    quotient = F.coalesce(quotient, F.lit(0.0))
    return rows.select(
        "metric",
        "channel",
        "niche",
        quotient.alias("ratio"),
        F.concat(display.fixed_point(quotient, 1), F.lit("×")).alias("ratio_text"),
        F.when(quotient >= 1, "above").otherwise("below").alias("position"),
    )


def _distribution(marts: Marts, channel_id: str, category: str) -> DataFrame:
    rows = marts.fct_video_performance.filter(F.col("channel_id") == channel_id)
    known = F.coalesce(F.nullif(F.col(category), F.lit("")), F.lit("unknown"))
    return rows.groupBy(known.alias(category)).agg(F.count(F.lit(1)).alias("value"))


def channel_tier_distribution(marts: Marts, channel_id: str) -> DataFrame:
    counts = _distribution(marts, channel_id, "performance_tier")
    name = display.spaced(F.col("performance_tier"))
    return counts.select(name.alias("name"), "value", F.col("performance_tier").alias("tier"))


def channel_duration_distribution(marts: Marts, channel_id: str) -> DataFrame:
    counts = _distribution(marts, channel_id, "duration_category")
    category = F.col("duration_category")
    return counts.select(category.alias("name"), "value", category.alias("category"))


def channel_detail(marts: Marts, channel_id: str) -> dict[str, DataFrame]:
    """Everything one channel page shows, each part its own lazy DataFrame."""
    return {
        "channel": channel_info(marts, channel_id),
        "metrics": channel_metrics(marts, channel_id),
        "videos": channel_videos(marts, channel_id),
        "benchmark": channel_benchmark(marts, channel_id),
        "peers": channel_peers(marts, channel_id),
    }


# videos


def video_explorer(
    marts: Marts,
    niche: str | None = None,
    region: str | None = None,
    tier: str | None = None,
    kind: str | None = None,
    sort: str = "view_count",
    limit: int = fixed.DEFAULT_LIMIT,
) -> DataFrame:
    """Filtered videos with their channel. ``kind`` is ``live``, ``regular`` or anything else for all."""
    order = _descending(sort, fixed.VIDEO_SORTS, "video_id")
    rows = _matching(
        marts.fct_video_performance, niche=niche, region=region, performance_tier=tier
    )
    if kind in ("live", "regular"):
        rows = rows.filter(F.col("was_live") == F.lit(kind == "live"))
    channels = marts.dim_channels.select(
        "channel_id", "channel_name", "subscriber_count", "size_tier"
    )
    selected = rows.select(
        "video_id", "title", "channel_id", "niche", "region", "upload_date", "view_count",
        "like_count", "comment_count", "duration_seconds", "duration_category",
        "engagement_rate", "like_rate", "comment_rate", "views_per_subscriber",
        "views_per_day", "performance_tier", "engagement_vs_benchmark", "views_vs_benchmark",
    )
    return top_with_lookup(selected, channels, "channel_id", order, limit)


def video_page_summary(page: DataFrame) -> DataFrame:
    """Cards above an explorer page: a missing rate counts as 0 but still as a video."""
    shown = F.count(F.lit(1))

    def mean(name: str) -> Column:
        total = F.coalesce(F.sum(F.coalesce(name, F.lit(0))), F.lit(0)).cast("double")
        return total / F.greatest(shown, F.lit(1))

    return page.agg(
        shown.alias("videos_shown"),
        mean("view_count").alias("avg_views"),
        mean("engagement_rate").alias("avg_engagement"),
        F.count_if(F.col("performance_tier") == "viral").alias("viral_videos"),
    )


def video_page_summary_text(summary: DataFrame) -> DataFrame:
    return summary.select(
        "videos_shown",
        display.compact_number(F.col("avg_views")).alias("avg_views"),
        display.percent(F.col("avg_engagement")).alias("avg_engagement"),
        "viral_videos",
    )


def video_table(page: DataFrame, sort: str = "view_count", limit: int = fixed.PAGE_LIMIT) -> DataFrame:
    """An explorer page as shown: rank, short title, formatted numbers, labels."""
    order = _descending(sort, fixed.VIDEO_SORTS, "video_id")
    return ranked_page(page, order, limit).select(
        "rank",
        "video_id",
        display.ellipsize(F.col("title"), 55).alias("title"),
        display.watch_link(F.col("video_id")).alias("link"),
        "channel_name",
        "niche",
        display.compact_number(F.col("view_count")).alias("views"),
        display.compact_number(F.col("like_count")).alias("likes"),
        display.percent(F.col("engagement_rate")).alias("engagement"),
        display.compact_number(F.col("views_per_day")).alias("views_per_day"),
        display.duration_text(F.col("duration_seconds")).alias("duration"),
        display.tier_label(F.col("performance_tier")).alias("tier"),
        display.day_text(F.col("upload_date")).alias("date"),
    )


def top_videos_table(top_videos: DataFrame, limit: int = fixed.TOP_ROWS) -> DataFrame:
    """The overview's top list as shown; its number formats have no zero guard."""
    order = _descending("view_count", fixed.VIDEO_SORTS, "video_id")
    return ranked_page(top_videos, order, limit).select(
        "rank",
        display.ellipsize(F.col("title"), 60).alias("title"),
        display.watch_link(F.col("video_id")).alias("link"),
        "channel_name",
        "niche",
        display.compact_number(F.col("view_count"), guarded=False).alias("views"),
        display.percent(F.col("engagement_rate"), guarded=False).alias("engagement"),
        "performance_tier",
    )


# niches


def niche_overview(marts: Marts) -> DataFrame:
    return marts.agg_niche_overview


def niche_region(rollup: DataFrame) -> DataFrame:
    groups = rollup.groupBy("niche", "region")
    return groups.agg(*_totals(views=True, likes=True)).orderBy("niche", "region")


def niche_region_table(breakdown: DataFrame) -> DataFrame:
    """The niche and region breakdown as shown."""
    return breakdown.select(
        "niche",
        display.region_label(F.col("region")).alias("region"),
        "channels",
        "videos",
        display.compact_number(F.col("total_views")).alias("total_views"),
        display.compact_number(F.col("avg_views")).alias("avg_views"),
        display.percent(F.col("avg_engagement")).alias("engagement"),
        display.percent(F.col("avg_like_rate")).alias("like_rate"),
    )


def duration_analysis(content: DataFrame) -> DataFrame:
    groups = content.groupBy("niche", "duration_category")
    return groups.agg(
        F.sum("n").alias("count"),
        _mean("view_count").alias("avg_views"),
        _mean("engagement_rate").alias("avg_engagement"),
    ).orderBy("niche", "duration_category")


def upload_day_analysis(content: DataFrame) -> DataFrame:
    groups = content.groupBy("niche", "upload_day_of_week")
    return groups.agg(F.sum("n").alias("count"), _mean("view_count").alias("avg_views")).orderBy(
        "niche", "upload_day_of_week"
    )


def niche_page(marts: Marts) -> dict[str, DataFrame]:
    """Everything the niche page shows; the content results share one pass."""
    content = materialize(content_rollup(marts), "content")
    return {
        "overview": niche_overview(marts),
        "niche_region": niche_region(channel_rollup(marts)),
        "duration_analysis": duration_analysis(content),
        "upload_days": upload_day_analysis(content),
    }
