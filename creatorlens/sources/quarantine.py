"""Dump lines sorted into rows to load and lines set aside with a reason, in one pass."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dumps import REASONS, judged_videos
from .workspace import fresh_folder, read_parquet

PARSED = "parsed"


class Sorted(NamedTuple):
    rows: DataFrame
    set_aside: DataFrame
    counts: dict[str, int]


def sort_videos(lines: DataFrame, scraped_at: Column | str) -> Sorted:
    """Video lines as raw rows, those that can't be loaded, and how many there are of each.

    Lines are parsed once and written once, good ones and others in folders of their own.
    ``rows`` has the columns of ``dumps.parse_videos``; ``set_aside`` those of ``lines``
    (``value`` is the line as it came), ``reason`` and ``scraped_at``, so that lines can be
    mended and sorted again. ``counts`` is by reason and ``parsed``, read from what was
    written: its sum is the number of lines, also when tasks were repeated. No line is
    dropped. Columns of ``lines`` named ``video``, ``reason`` or ``scraped_at`` give way to those.
    """
    spark = lines.sparkSession
    stamp = scraped_at if isinstance(scraped_at, Column) else F.lit(scraped_at)
    own = [c for c in lines.columns if c not in ("video", "reason", "scraped_at")]
    judged = judged_videos(lines, scraped_at)
    bad = F.col("reason").isNotNull()
    line = F.when(bad, F.struct(*own, "reason", stamp.cast("string").alias("scraped_at")))
    written = judged.select(
        bad.alias("set_aside"), F.when(~bad, F.col("video")).alias("video"), line.alias("line")
    )
    path = fresh_folder(spark, "sorted-lines")
    written.write.partitionBy("set_aside").parquet(path)
    stored = read_parquet(spark, path, written.schema)
    rows = stored.filter(~F.col("set_aside")).select("video.*")
    aside = stored.filter("set_aside").select("line.*")
    found = {r["reason"]: r["count"] for r in aside.groupBy("reason").count().collect()}
    counts = {PARSED: rows.count()} | {reason: found.get(reason, 0) for reason in REASONS}
    return Sorted(rows, aside, counts)
