"""The newest snapshot of every channel as a table that loads are merged into.

Building the staging model from it reads one row per channel instead of all history. A load
reads and writes only the buckets its channels fall into.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.ranking import first_per_key
from ..sources.manifest import Conflict, ManifestTable, swapped
from ..sources.tables import coerce
from .staging import newest_first

#: Buckets of channels. More of them make a load of few channels cheaper.
BUCKETS = 64


class CurrentChannels:
    def __init__(self, spark: SparkSession, root: str, *, buckets: int = BUCKETS):
        """``buckets`` is a property of the stored table: give the number it was made with."""
        self.buckets = buckets
        self.table = ManifestTable(spark, root, schemas.RAW_CHANNELS)

    def read(self) -> DataFrame:
        """One raw row per channel id: what ``staging.stg_channels`` makes of all history, it makes of this."""
        return self.table.read()

    def merge(self, snapshots: DataFrame) -> list[int]:
        """Take in raw snapshots in any order, late and repeated ones too; the buckets written.

        Rows without a channel id are nobody's newest and are left out. A merge that fails
        before its commit changes nothing and may be repeated; so may one that succeeded.
        """
        bucket = F.pmod(F.xxhash64("channel_id"), F.lit(self.buckets)).cast("int")
        rows = coerce(snapshots, schemas.RAW_CHANNELS).filter(F.col("channel_id").isNotNull())
        newest = first_per_key(rows, ["channel_id"], newest_first())
        touched = sorted(r["bucket"] for r in rows.select(bucket.alias("bucket")).distinct().collect())  # at most ``buckets``
        while touched:
            parts = self.table.version().parts
            old = [p for p in parts if p.labels["bucket"] in touched]
            both = self.table.read(old).unionByName(newest)
            merged = first_per_key(both, ["channel_id"], newest_first()).withColumn("bucket", bucket)
            made = self.table.write_by(merged.repartition(self.buckets, "bucket"), "bucket")
            try:
                self.table.commit(_same_buckets(old, made, touched))
            except Conflict:  # another load of the same buckets was first
                continue
            self.table.sweep()
            break
        return touched


def _same_buckets(old: list, made: list, touched: list[int]):
    change = swapped(old, made)

    def checked(parts: list) -> list:
        if sum(p.labels["bucket"] in touched for p in parts) != len(old):
            raise Conflict("buckets have changed")
        return change(parts)

    return checked
