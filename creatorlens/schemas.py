"""Explicit schemas of every input and raw table; nothing is inferred."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_TEXT, _WHOLE, _FLAG = StringType(), LongType(), BooleanType()

REGISTRY_ENTRY = _struct(name=_TEXT, url=_TEXT, channel_id=_TEXT, region=_TEXT)
REGISTRY_DOCUMENT = MapType(_TEXT, ArrayType(REGISTRY_ENTRY))

RAW_CHANNELS = _struct(
    channel_id=_TEXT,
    channel_name=_TEXT,
    channel_url=_TEXT,
    subscriber_count=_WHOLE,
    description=_TEXT,
    scraped_at=_TEXT,
    niche=_TEXT,
    region=_TEXT,
    config_name=_TEXT,
)
RAW_VIDEOS = _struct(
    video_id=_TEXT,
    title=_TEXT,
    description=_TEXT,
    channel_name=_TEXT,
    channel_id=_TEXT,
    channel_url=_TEXT,
    upload_date=_TEXT,
    duration_seconds=_WHOLE,
    view_count=_WHOLE,
    like_count=_WHOLE,
    comment_count=_WHOLE,
    tags=_TEXT,
    categories=_TEXT,
    thumbnail_url=_TEXT,
    language=_TEXT,
    is_live=_FLAG,
    was_live=_FLAG,
    scraped_at=_TEXT,
    niche=_TEXT,
    region=_TEXT,
)
# small typed table used to prove that a store accepts writes
PROBE_TABLE = StructType(
    [
        StructField("video_id", StringType(), nullable=False),
        StructField("title", StringType()),
        StructField("views", LongType()),
        StructField("upload_date", DateType()),
    ]
)
