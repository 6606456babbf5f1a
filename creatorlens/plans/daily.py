"""Sums per channel and upload day, from which the summary of any reporting day is made.

The 30- and 7-day counts and the views per day depend on the reporting day. Kept per upload
day they don't: a channel has one row a day at most per name, niche and region, however many
videos it has, and a new load only adds its own sums. No summary reads the videos again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import days_between, greatest_strict, ratio
from ..sources.manifest import Conflict, ManifestTable, due, swapped
from . import metrics
from .metrics import PARTIAL_KEYS, Day

KEYS = (*PARTIAL_KEYS, "upload_date")
#: Days before the reporting day that still count as recent.
RECENT_DAYS = (30, 7)
#: Folders of one size that are merged into one.
MERGED = 8

_LEAST, _GREATEST = ("min_views", "earliest_video"), ("max_views", "latest_video")


def daily_sums(stg_videos: DataFrame) -> DataFrame:
    """Partial sums by channel, name, niche, region and upload day; NULL is a value of each."""
    measured = metrics.measures(metrics.own_metrics(None))
    del measured["views_per_day"]  # depends on the reporting day
    return stg_videos.groupBy(*KEYS).agg(*metrics.additive(measured))


def added_up(sums: DataFrame, *keys: str) -> DataFrame:
    """Partial sums of the same or fewer keys."""
    columns = []
    for name in sums.columns:
        if name not in KEYS:
            add = F.min if name in _LEAST else F.max if name in _GREATEST else F.sum
            columns.append(add(name).alias(name))
    return sums.groupBy(*keys).agg(*columns)


def channel_summary(sums: DataFrame, stg_channels: DataFrame, as_of: Day = None) -> DataFrame:
    """``metrics.channel_summary`` of any reporting day from daily sums (of any number of loads).

    As there, videos uploaded after the reporting day count as recent.
    """
    days = days_between(as_of, F.col("upload_date"))
    own = {
        "sum_views_per_day": ratio(F.col("sum_view_count"), greatest_strict(days, F.lit(1))),
        "n_views_per_day": F.when(days.isNotNull(), F.col("n_view_count")),
        **{f"n_{recent}d": F.when(days <= recent, F.col("n")).otherwise(0) for recent in RECENT_DAYS},
    }
    return metrics.summary_of(added_up(sums.withColumns(own), *PARTIAL_KEYS), stg_channels)


def rolling_uploads(sums: DataFrame) -> DataFrame:
    """For every day a channel uploaded on: its videos so far and those of the last 30 and 7 days.

    The counts are those a summary of that day gave at the time. A window holds one channel's
    days, so its size is bounded by the calendar, not by the videos. Videos without a day or a
    channel are left out.
    """
    dated = added_up(sums.filter(F.col("upload_date").isNotNull() & F.col("channel_id").isNotNull()), "channel_id", "upload_date")
    day = F.unix_date("upload_date")
    by_day = Window.partitionBy("channel_id").orderBy(day)
    recent = {f"videos_last_{width}d": F.sum("n").over(by_day.rangeBetween(-width, 0)) for width in RECENT_DAYS}
    so_far = F.sum("n").over(by_day.rangeBetween(Window.unboundedPreceding, 0))
    return dated.select(
        "channel_id", "upload_date", F.col("n").alias("videos"), so_far.alias("total_videos"),
        *[column.alias(name) for name, column in recent.items()],
    )


class DailySums:
    """Daily sums as a table that loads of new videos are added to."""

    def __init__(self, spark: SparkSession, root: str, stg_schema):
        empty = spark.createDataFrame([], stg_schema)
        self.table = ManifestTable(spark, root, daily_sums(empty).schema)

    def read(self) -> DataFrame:
        """Sums of all loads; the same keys may occur once per folder."""
        return self.table.read()

    def loads(self) -> int:
        """Number of the last load that was added; 0 before the first."""
        return max((p.labels["load"] for p in self.table.version().parts), default=0)

    def add(self, stg_videos: DataFrame, load: int) -> bool:
        """Add the videos of a load, numbered upward from 1; False if it was added before.

        A video belongs to one load. A run that fails before its commit has added nothing; a
        load that is given again after its commit is left out.
        """
        if load <= self.loads():
            return False
        made = self.table.write(daily_sums(stg_videos), load=load, tier=0)

        def appended(parts: list) -> list:
            if any(p.labels["load"] >= load for p in parts):
                raise Conflict(f"load {load} or a later one is there")
            return [*parts, made]

        try:
            self.table.commit(appended)
        except Conflict:
            return False
        self._compact()
        return True

    def _compact(self) -> None:
        for group in due(self.table.version().parts, MERGED):
            tier = 1 + group[0].labels.get("tier", 0)
            last = max(p.labels["load"] for p in group)
            made = self.table.write(added_up(self.table.read(group), *KEYS), load=last, tier=tier)
            try:
                self.table.commit(swapped(group, [made]))
            except Conflict:  # another writer merged them
                return
        self.table.sweep()
