"""JSON-line dumps of listings, videos, channels and searches as typed rows.

Every parser takes the raw lines in column ``value`` (as ``spark.read.text`` or
``spark.readStream.text`` gives them), so batch, stream and tests share it.
Lines that are not JSON objects are skipped; no other line is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.display import absolute_url
from ..functions.scalars import clip, first_filled, iso_day
from ..operators.joins import dealt
from ..operators.ranking import first_per_key

_RECORD = "_record"
_VIDEO_FIELDS = (
    "id", "title", "description", "channel", "channel_id", "channel_url", "upload_date", "duration", "view_count",
    "like_count", "comment_count", "tags", "categories", "thumbnail", "language", "is_live", "was_live",
)
_LISTED_FIELDS = ("channel", "uploader", "channel_id", "channel_url", "description", "url", "webpage_url")
_EXTRACT_FIELDS = ("channel", "channel_id", "channel_url", "channel_description", "channel_follower_count")
#: Session setting with which a variant keeps the last value of a repeated key, as JSON parsers do.
_REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


def _parse(lines: DataFrame, names: Sequence[str], *, all_lines: bool = False) -> DataFrame:
    """Adds the parsed line, a struct of variants of the fields ``names``; other lines are gone.

    With ``all_lines`` they stay, with NULL for the struct.

    Each line is parsed once and field by field: a value of another type than expected
    costs that field only. A field is NULL where its key is absent; an explicit null is a
    variant. The struct leaves a generator that yields nothing for a line that is no JSON
    object: a filter on fields would be pushed below and parse again. A field of a struct is
    found by its place; in a map every use of it would go through the keys.
    Of a repeated key the last value stays; the session keeps the setting for that, as a
    stream plans its batches later.
    """
    lines.sparkSession.conf.set(_REPEATED_KEYS, "true")
    fields = ",".join(f"{name}:variant" for name in names)
    record = F.try_variant_get(F.try_parse_json("value"), "$", f"struct<{fields}>")
    held = F.array(record) if all_lines else F.filter(F.array(record), lambda r: r.isNotNull())
    return lines.select("*", F.explode(held).alias(_RECORD))


def _variant(name: str) -> Column:
    return F.col(_RECORD)[name]


def _text(name: str) -> Column:
    """The field as text; NULL where it is absent, null or nested."""
    return F.try_variant_get(_variant(name), "$", "string")


def _whole(name: str) -> Column:
    """The field as a whole number, also from ``61.0`` or ``"61"``; NULL for anything else."""
    wide = F.try_variant_get(_variant(name), "$", "double")
    return F.when(wide == F.floor(wide), F.try_variant_get(_variant(name), "$", "bigint"))


def _flag(name: str) -> Column:
    """The field as a flag; text and numbers that name no flag count by being there."""
    named = F.try_variant_get(_variant(name), "$", "boolean")
    return F.coalesce(named, F.nullif(_text(name), F.lit("")).isNotNull())


def _json_list(name: str) -> Column:
    """The field as compact JSON, whatever it holds; empty, zero and false as ``[]``."""
    written = F.to_json(_variant(name))
    empty = written.isin("null", "[]", "{}", '""', "false", "0", "0.0")
    return F.when(written.isNotNull() & ~empty, written).otherwise("[]")


def _value_or(name: str, value: Column, default) -> Column:
    """The value, or ``default`` when its key is absent; an explicit null stays NULL."""
    return F.when(_variant(name).isNotNull(), value).otherwise(F.lit(default))


def _stamp(scraped_at: Column | str) -> Column:
    column = scraped_at if isinstance(scraped_at, Column) else F.lit(scraped_at)
    return column.alias("scraped_at")


def parse_listing(lines: DataFrame) -> DataFrame:
    """Listing lines as ``video_id`` next to the other columns of ``lines``."""
    return (
        _parse(lines, ("id", "url"))
        .withColumn("video_id", first_filled(_text("id"), _text("url")))
        .drop(_RECORD, "value")
        .filter(F.col("video_id").isNotNull())
    )


def parse_listing_drops(lines: DataFrame) -> DataFrame:
    """Self-describing listing lines: (config_url, tab, position, video_id)."""
    return (
        _parse(lines, ("config_url", "tab", "position", "id", "url"))
        .select(
            _text("config_url").alias("config_url"),
            _text("tab").alias("tab"),
            _whole("position").alias("position"),
            first_filled(_text("id"), _text("url")).alias("video_id"),
        )
        .filter(F.col("video_id").isNotNull())
    )


def parse_videos(lines: DataFrame, scraped_at: Column | str) -> DataFrame:
    """Video dump lines as raw video rows, still without niche and region.

    The key of a video is the id it was asked for, in column ``requested_id`` if the
    lines have it; the dump's own id may be another.
    """
    return _parse(lines, _VIDEO_FIELDS).select(*_video_columns(lines, scraped_at))


def _video_columns(lines: DataFrame, scraped_at: Column | str) -> list[Column]:
    requested = [F.col("requested_id")] if "requested_id" in lines.columns else []
    return [
        F.coalesce(*requested, _text("id")).alias("video_id"),
        _value_or("title", _text("title"), "").alias("title"),
        clip(_text("description"), fixed.VIDEO_TEXT_LIMIT).alias("description"),
        _value_or("channel", _text("channel"), "").alias("channel_name"),
        _value_or("channel_id", _text("channel_id"), "").alias("channel_id"),
        _value_or("channel_url", _text("channel_url"), "").alias("channel_url"),
        iso_day(_text("upload_date")).alias("upload_date"),
        _whole("duration").alias("duration_seconds"),
        _value_or("view_count", _whole("view_count"), 0).alias("view_count"),
        _value_or("like_count", _whole("like_count"), 0).alias("like_count"),
        _value_or("comment_count", _whole("comment_count"), 0).alias("comment_count"),
        _json_list("tags").alias("tags"),
        _json_list("categories").alias("categories"),
        _value_or("thumbnail", _text("thumbnail"), "").alias("thumbnail_url"),
        _text("language").alias("language"),
        _flag("is_live").alias("is_live"),
        _flag("was_live").alias("was_live"),
        _stamp(scraped_at),
    ]


#: Why a video line can't be loaded; of several reasons the first one counts.
EMPTY_LINE, NO_JSON, NO_OBJECT, NO_ID, NO_DAY = "empty line", "no JSON", "no JSON object", "no id", "no upload day"
REASONS = (EMPTY_LINE, NO_JSON, NO_OBJECT, NO_ID, NO_DAY)


def judged_videos(lines: DataFrame, scraped_at: Column | str) -> DataFrame:
    """Every line: columns of ``lines``, ``reason`` and ``video``, the raw video row.

    ``reason`` says why the line can't be loaded and is NULL for a good one; ``video`` is
    NULL where the line is no JSON object. A day that no date can be made of is a reason,
    because the models would fail on it; no day at all is none.
    """
    value = F.coalesce("value", F.lit(""))
    video = F.when(F.col(_RECORD).isNotNull(), F.struct(*_video_columns(lines, scraped_at)))
    day = F.col("video.upload_date")
    reason = (
        F.when(F.trim(value) == "", EMPTY_LINE)
        .when(F.col("video").isNull() & F.try_parse_json(value).isNull(), NO_JSON)
        .when(F.col("video").isNull(), NO_OBJECT)
        .when(F.col("video.video_id").isNull(), NO_ID)
        .when(day.isNotNull() & day.try_cast("date").isNull(), NO_DAY)
    )
    columns = [c for c in lines.columns if c not in ("video", "reason")]
    return _parse(lines.select(*columns), _VIDEO_FIELDS, all_lines=True).select(*columns, video.alias("video")).withColumn("reason", reason)


def parse_channels(listing: DataFrame, extracts: DataFrame, scraped_at: Column | str) -> DataFrame:
    """Channel rows from a listing line and, where there is one, a full video extract.

    Both inputs hold ``config_url`` (the registry URL, one line each) and ``value``.
    Fields of the extract come first; its description replaces the listing's even
    when empty. Without an extract an absent channel id is empty text; with one, an id
    that neither record has is NULL.

    Texts are cut before the join, and its tasks follow the number of lines. Dealt out first,
    they are joined by their true size: from that of compressed files Spark would take a
    side for small and hold all of it in each task.
    """
    rows = listing.count()
    listed = _parse(listing, _LISTED_FIELDS).select(
        "config_url",
        F.struct(
            _text("channel").alias("channel"),
            _value_or("uploader", _text("uploader"), "").alias("uploader"),
            _text("channel_id").alias("channel_id"),
            _value_or("channel_id", _text("channel_id"), "").alias("id_or_empty"),
            _text("channel_url").alias("channel_url"),
            clip(_text("description"), fixed.CHANNEL_TEXT_LIMIT).alias("description"),
            first_filled(_text("url"), _text("webpage_url")).alias("address"),
        ).alias("listed"),
    )
    extracted = _parse(extracts, _EXTRACT_FIELDS).select(
        "config_url",
        F.struct(
            _text("channel").alias("channel"),
            F.nullif(_text("channel_id"), F.lit("")).alias("channel_id"),
            _text("channel_url").alias("channel_url"),
            clip(_text("channel_description"), fixed.CHANNEL_TEXT_LIMIT).alias("description"),
            _whole("channel_follower_count").alias("subscribers"),
        ).alias("extract"),
    )
    joined = dealt(listed, rows, "config_url").join(dealt(extracted, rows, "config_url"), "config_url", "left")
    line = F.col("listed")
    full = F.when(line["address"].isNotNull(), F.col("extract"))
    extended = full.isNotNull()
    return joined.select(
        "config_url",
        F.when(extended, F.coalesce(full["channel_id"], line["channel_id"]))
        .otherwise(line["id_or_empty"])
        .alias("channel_id"),
        F.coalesce(first_filled(full["channel"], line["channel"]), line["uploader"]).alias(
            "channel_name"
        ),
        first_filled(full["channel_url"], line["channel_url"], F.col("config_url")).alias(
            "channel_url"
        ),
        full["subscribers"].alias("subscriber_count"),
        F.when(extended, full["description"]).otherwise(line["description"]).alias("description"),
        _stamp(scraped_at),
    )


def channel_probe_urls(listing: DataFrame) -> DataFrame:
    """Address of the video to extract for each listed channel."""
    address = first_filled(_text("url"), _text("webpage_url"))
    return (
        _parse(listing, ("url", "webpage_url"))
        .select("config_url", absolute_url(address).alias("video_url"))
        .filter(F.col("video_url").isNotNull())
    )


def first_hits(lines: DataFrame) -> DataFrame:
    """First search hit with a channel URL per (name, niche), in ``position`` order."""
    hits = (
        _parse(lines, ("channel", "uploader", "channel_id", "channel_url"))
        .select(
            "name",
            "niche",
            "position",
            first_filled(_text("channel"), _text("uploader")).alias("channel"),
            _text("channel_id").alias("channel_id"),
            F.nullif(_text("channel_url"), F.lit("")).alias("channel_url"),
        )
        .filter(F.col("channel_url").isNotNull())
    )
    return first_per_key(hits, ["name", "niche"], [F.col("position")]).drop("position")


def observed_channels(lines: DataFrame) -> DataFrame:
    """What a working registry URL (column ``url``) answered."""
    return _parse(lines, ("channel", "channel_id", "channel_url")).select(
        "url",
        _text("channel").alias("channel"),
        _text("channel_id").alias("channel_id"),
        _text("channel_url").alias("channel_url"),
    )


def utc_now() -> Column:
    """The time of the run as ISO text with a UTC offset."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
