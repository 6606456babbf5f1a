"""Raw rows in a folder per day of scraping, whole days of which expire.

Expiry reads and rewrites no row: it commits a version that no longer names the folders of
old days, so readers see all of a day or nothing of it. Their files go with the versions
that named them.
"""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions import fixed_values as fixed
from .manifest import KEPT_VERSIONS, ManifestTable
from .tables import coerce

#: The column of folders: the UTC day as a number such as 20010731.
DAY = StructField("scraped_day", IntegerType())
#: Day of rows whose time is missing or none. Such rows don't expire.
NO_DAY = 0


def day_number(when: date) -> int:
    return when.year * 10_000 + when.month * 100 + when.day


def utc_day(stamp: str) -> Column:
    """The UTC day of ISO text, as a number; ``NO_DAY`` where it is no time."""
    moment = F.to_utc_timestamp(F.col(stamp).try_cast("timestamp"), F.current_timezone())
    return F.coalesce(F.date_format(moment, "yyyyMMdd").cast("int"), F.lit(NO_DAY))


class DayTable:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, *, stamp: str = "scraped_at"):
        self.stamp = stamp
        self.table = ManifestTable(spark, root, schema)

    def append(self, rows: DataFrame) -> int:
        """Add rows, each to its day; how many. Nothing is there before all of them are."""
        dated = coerce(rows, self.table.schema).withColumn(DAY.name, utc_day(self.stamp))
        made = self.table.write_by(dated, DAY.name)
        if made:
            self.table.commit(lambda parts: [*parts, *made])
        return sum(p.rows for p in made)

    def read(self) -> DataFrame:
        """All rows and ``scraped_day``; filters on that column leave out folders."""
        return self.table.read_by(DAY)

    def retained(self, as_of: date, days: int = fixed.RETENTION_DAYS) -> DataFrame:
        """What ``tables.within_retention`` keeps, from the folders of its days alone."""
        oldest = day_number(as_of - timedelta(days=days))
        return self.read().filter(F.col(DAY.name) >= oldest).drop(DAY.name)

    def expire(
        self, as_of: date | None = None, days: int = fixed.RETENTION_DAYS, *, kept: int = KEPT_VERSIONS
    ) -> int:
        """Leave out days before the last ``days``; how many rows went.

        The last ``kept`` versions, and the folders they name, stay for readers under way.
        """
        oldest = day_number((as_of or datetime.now(UTC).date()) - timedelta(days=days))
        gone = 0

        def current(parts: list) -> list:
            nonlocal gone
            stay = [p for p in parts if not NO_DAY < p.labels[DAY.name] < oldest]
            gone = sum(p.rows for p in parts) - sum(p.rows for p in stay)
            return stay

        if len(current(self.table.version().parts)) < len(self.table.version().parts):
            self.table.commit(current)
        self.table.sweep(kept=kept)
        return gone
