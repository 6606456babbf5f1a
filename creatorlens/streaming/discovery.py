"""Incremental discovery of videos as a stream of listing drops.

Each micro-batch keeps the ids no earlier batch or load has stored and writes
them to the sink. Ids are compared with the whole sink, not within a watermark:
a video may be listed again at any later time.
"""

from __future__ import annotations

import hashlib

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions import fixed_values as fixed
from ..operators.joins import unseen
from ..operators.ranking import first_per_key
from ..sources.dumps import parse_listing_drops
from ..sources.manifest import Conflict, ManifestTable, Part, due, swapped

SINK_SCHEMA = StructType(
    [
        StructField("config_url", StringType()),
        StructField("tab", StringType()),
        StructField("position", LongType()),
        StructField("video_id", StringType()),
    ]
)
#: Folders of one size that are merged into one, and rows of a file of the merged one at least.
MERGED, FILE_ROWS = 10, 2_000_000
_SOURCE = StructField("stream", StringType())
_BATCH = StructField("batch", LongType())


def _table(spark: SparkSession, sink: str) -> ManifestTable:
    return ManifestTable(spark, sink, StructType([*SINK_SCHEMA.fields, _SOURCE, _BATCH]))


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    """Everything discovered so far, with the stream and batch that wrote it."""
    return _table(spark, sink).read()


def store_batch(batch: DataFrame, batch_id: int, sink: str, stream: str, *, fan: int = MERGED) -> None:
    """Write the unseen ids of one batch and commit them to the sink.

    A repeated batch takes the place of its first try and is compared with all others, so a
    batch that failed half-way leaves neither gaps nor duplicates. Only the last batch of a
    stream is ever repeated; one older than that is refused.
    """
    spark = batch.sparkSession
    table = _table(spark, sink)
    order = [F.array_position(F.lit(list(fixed.TAB_ORDER)), F.col("tab")), F.col("position")]
    once = first_per_key(batch, ["video_id"], [*order, F.col("config_url")])
    once = once.persist(StorageLevel.MEMORY_AND_DISK)
    while True:
        parts = table.version().parts
        own = [p for p in parts if p.labels.get("stream") == stream]
        if any(p.labels["batch"] > batch_id for p in own):
            raise ValueError(f"batch {batch_id} is older than stored ones: give a new checkpoint")
        before = [p for p in own if p.labels["batch"] == batch_id]
        others = [p for p in parts if p not in before]
        new = unseen(once, table.read(others), "video_id").select(*SINK_SCHEMA.names)
        stamped = new.withColumns({"stream": F.lit(stream), "batch": F.lit(batch_id).cast("bigint")})
        written = table.write(stamped, stream=stream, batch=batch_id, tier=0)
        try:
            table.commit(_if_only(before, others, [written]))
            break
        except Conflict:  # another stream stored ids meanwhile
            continue
    once.unpersist()
    compact(spark, sink, fan=fan)


def _if_only(old: list[Part], others: list[Part], new: list[Part]):
    """Put ``new`` in the place of ``old`` unless the other parts got more meanwhile."""

    def change(parts: list[Part]) -> list[Part]:
        if {p.folder for p in parts} != {p.folder for p in [*old, *others]}:
            raise Conflict("the sink has changed")
        return others + new

    return change


def compact(spark: SparkSession, sink: str, *, fan: int = MERGED) -> None:
    """Merge folders of one size into one of the next size once there are ``fan`` of them.

    The sink has less than ``fan`` folders of each size and the last one of each stream, and
    a row is written again as often as there are sizes: the logarithm of the batches. The
    last batch of a stream stays by itself, because it may be repeated. A merge that fails
    before its commit changes nothing.
    """
    table = _table(spark, sink)
    parts = table.version().parts
    last = {s: max(p.labels["batch"] for p in parts if p.labels.get("stream") == s) for s in {p.labels.get("stream") for p in parts} - {None}}
    settled = [p for p in parts if p.labels.get("stream") is None or p.labels["batch"] < last[p.labels["stream"]]]
    for group in due(settled, fan):
        files = max(1, -(-sum(p.rows for p in group) // FILE_ROWS))
        merged = table.write(table.read(group).coalesce(files), tier=group[0].labels["tier"] + 1)
        try:
            table.commit(swapped(group, [merged]))
        except Conflict:  # merged by another stream
            continue
    table.sweep()


def discover(
    spark: SparkSession,
    drops: str,
    sink: str,
    checkpoint: str,
    *,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Process all drop files not processed yet, then stop.

    Batches are known by the checkpoint's path too, because batch numbers start again with a
    new one; so give a path that no other stream into this sink had.
    """
    lines = spark.readStream
    if files_per_batch:
        lines = lines.option("maxFilesPerTrigger", files_per_batch)
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    listed = parse_listing_drops(lines.text(drops))
    return (
        listed.writeStream.foreachBatch(
            lambda batch, batch_id: store_batch(batch, batch_id, sink, stream)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
