"""Which ids were loaded before, kept in hash buckets beside a table.

A batch of ids is compared with the buckets its ids fall into and no others. Ids travel to
the scan of those buckets, never the other way, so loaded ids are neither shuffled nor sent.
Only for a batch too large to send are both sides shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.joins import BROADCAST_BYTES, measured_bytes, never_sent
from .manifest import Conflict, ManifestTable, Part, due, swapped

#: Buckets, folders of one size per bucket that are merged, and ids of a batch up to which
#: their values themselves reach the scan, for Bloom filters and file statistics.
BUCKETS, MERGED, FEW_IDS = 64, 8, 1_000


class IdIndex:
    def __init__(self, spark: SparkSession, root: str, key: str, *, buckets: int = BUCKETS):
        """``buckets`` is a property of the stored index: give the number it was made with."""
        self.key, self.buckets = key, buckets
        self.table = ManifestTable(spark, root, StructType([StructField(key, StringType())]))
        self._options = {f"parquet.bloom.filter.enabled#{key}": "true"}

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def covered(self) -> int:
        """Rows of the table that the index was told of."""
        return sum(p.labels.get("covered", 0) for p in self.table.version().parts)

    def known(self, batch: DataFrame, *, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """Distinct ids of ``batch`` that the index has. NULL is no id.

        Beyond ``broadcast_bytes`` the batch is not sent to the scan: its ids and those of its
        buckets are shuffled. Every bucket is read once in either case.
        """
        ids = batch.select(self.key).filter(F.col(self.key).isNotNull()).distinct()
        sizes = ids.groupBy(self._bucket().alias("_bucket")).count().collect()  # at most a row per bucket
        wanted = {r["_bucket"] for r in sizes}
        scan = self.table.read([p for p in self.table.version().parts if p.labels.get("_bucket") in wanted])
        if measured_bytes(ids) > broadcast_bytes:
            return ids.join(never_sent(scan), self.key, "left_semi")
        if sum(r["count"] for r in sizes) <= FEW_IDS:
            scan = scan.filter(F.col(self.key).isin([r[self.key] for r in ids.collect()]))
        return scan.join(F.broadcast(ids), self.key, "left_semi").distinct()

    def add(self, ids: DataFrame, covered: int) -> None:
        """Store ids that the index may have or not; ``covered``: rows of the table they stand for."""
        bucketed = ids.select(self.key).filter(F.col(self.key).isNotNull()).distinct().withColumn("_bucket", self._bucket())
        dealt = bucketed.repartition(self.buckets, "_bucket").sortWithinPartitions("_bucket", self.key)
        made = self.table.write_by(dealt, "_bucket", options=self._options, tier=0)
        note = self.table.write(self.table.spark.createDataFrame([], self.table.schema), covered=covered)
        self.table.commit(lambda parts: [*parts, *made, note])
        self._compact()

    def reset(self) -> None:
        """Forget all ids, as before a table is replaced."""
        self.table.commit(lambda parts: [])

    def _compact(self) -> None:
        """Merge the folders of a bucket tier by tier, all buckets that are due in one job."""
        parts = self.table.version().parts
        notes = [p for p in parts if "covered" in p.labels]
        groups: list[Part] = [p for b in range(self.buckets) for g in due([p for p in parts if p.labels.get("_bucket") == b], MERGED) for p in g]
        if not groups and len(notes) < MERGED:
            return
        made: list[Part] = []
        if groups:
            tier = 1 + max(p.labels["tier"] for p in groups)
            rows = self.table.read(groups).distinct().withColumn("_bucket", self._bucket())
            dealt = rows.repartition(self.buckets, "_bucket").sortWithinPartitions("_bucket", self.key)
            made = self.table.write_by(dealt, "_bucket", options=self._options, tier=tier)
        if notes:
            made.append(notes[0]._replace(labels={"covered": sum(p.labels["covered"] for p in notes)}))
        try:
            self.table.commit(swapped([*groups, *notes], made))
        except Conflict:  # another writer merged them
            return
        self.table.sweep()
