"""Table stores: append, overwrite, create-once, typed tables, layers, retention."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import fixed_values as fixed
from ..functions.scalars import day
from .workspace import path_exists, read_parquet, remove_folder, replace_folder

APPEND = "append"
OVERWRITE = "overwrite"
CREATE = "errorifexists"

LAYERS = {
    "raw_channels": "raw",
    "raw_videos": "raw",
    "stg_channels": "staging",
    "stg_videos": "staging",
    "int_video_metrics": "intermediate",
    "int_channel_summary": "intermediate",
    "int_niche_benchmarks": "intermediate",
    "dim_channels": "marts",
    "fct_video_performance": "marts",
    "agg_channel_metrics": "marts",
    "agg_niche_overview": "marts",
}
# point lookups by channel skip row groups that do not hold the channel; videos compress well and
# take long per byte, so their files are made of many row groups that tasks can share evenly
_WRITE_OPTIONS = {
    "raw_videos": {"parquet.block.size": str(4 * 1024 * 1024)},
    "fct_video_performance": {"parquet.bloom.filter.enabled#channel_id": "true"},
}


class FolderStore:
    """Parquet tables below one shared folder, a sub-folder per layer."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def locate(self, name: str) -> str:
        return f"{self.root}/{LAYERS.get(name, 'raw')}/{name}"

    def exists(self, name: str) -> bool:
        return path_exists(self.spark, self.locate(name))

    def read(self, name: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.locate(name))

    def write(self, df: DataFrame, name: str, mode: str) -> None:
        options = _WRITE_OPTIONS.get(name, {})
        df.write.mode(mode).options(**options).parquet(self.locate(name))

    def staged(self, df: DataFrame, name: str) -> tuple[str, int]:
        """A complete copy beside the table, and its number of rows."""
        path = f"{self.root}/_staged/{name}-{uuid.uuid4().hex}"
        df.write.options(**_WRITE_OPTIONS.get(name, {})).parquet(path)
        return path, read_parquet(self.spark, path, df.schema).count()  # from the footers

    def publish(self, staged: str, name: str) -> None:
        """Put a staged copy in the table's place: renames, nothing is written again."""
        replace_folder(self.spark, staged, self.locate(name))

    def drop_staged(self, staged: str) -> None:
        remove_folder(self.spark, staged)


class CatalogStore:
    """Managed tables, one database per layer: ``<prefix>_<layer>``."""

    def __init__(self, spark: SparkSession, prefix: str):
        self.spark = spark
        self.prefix = prefix

    def locate(self, name: str) -> str:
        return f"{self.prefix}_{LAYERS.get(name, 'raw')}.{name}"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.locate(name))

    def read(self, name: str, schema: StructType | None = None) -> DataFrame:
        return self.spark.table(self.locate(name))

    def write(self, df: DataFrame, name: str, mode: str) -> None:
        ensure_namespace(self.spark, self.locate(name).split(".")[0])
        options = _WRITE_OPTIONS.get(name, {})
        df.write.mode(mode).options(**options).format("parquet").saveAsTable(self.locate(name))

    def staged(self, df: DataFrame, name: str) -> tuple[str, int]:
        table = f"{self.locate(name)}_staged_{uuid.uuid4().hex}"
        ensure_namespace(self.spark, table.split(".")[0])
        options = _WRITE_OPTIONS.get(name, {})
        df.write.options(**options).format("parquet").saveAsTable(table)
        return table, self.spark.table(table).count()

    def publish(self, staged: str, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.locate(name)}")
        self.spark.sql(f"ALTER TABLE {staged} RENAME TO {self.locate(name)}")

    def drop_staged(self, staged: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {staged}")


class VersionedCatalogStore(CatalogStore):
    """Every state of a table is a managed table of its own, behind a view of the table's name.

    Replacing a table changes one catalog entry, the view, and nothing else: whatever fails
    before or after that, the name shows all rows of one version. The last ``kept`` versions
    stay, so a query planned before a replacement still finds its files. A writer that
    ``kept`` others overtake fails without harm and may be repeated. A plain table of the
    name is refused, not replaced.
    """

    def __init__(self, spark: SparkSession, prefix: str, *, kept: int = 2):
        super().__init__(spark, prefix)
        self.kept = kept

    def live(self, name: str) -> str | None:
        """The version that the view shows; None before the first."""
        if not self.exists(name):
            return None
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.locate(name)}")
        text = described.filter("col_name = 'View Text'").first()
        if text is None:
            raise ValueError(f"not a view: {self.locate(name)}")
        return text["data_type"].rsplit(" ", 1)[-1]

    def versions(self, name: str) -> dict[str, int]:
        """Numbers of all versions there are, published or not, by table."""
        space, table = self.locate(name).split(".")
        if not self.spark.catalog.databaseExists(space):
            return {}
        names = [r["tableName"] for r in self.spark.sql(f"SHOW TABLES IN {space} LIKE '{table}_v*'").collect()]
        found = {n: re.fullmatch(rf"{re.escape(table)}_v(\d+)_[0-9a-f]{{32}}", n) for n in names}
        return {f"{space}.{n}": int(match[1]) for n, match in found.items() if match}

    def _number(self, name: str) -> int:
        live = self.live(name)
        return 0 if live is None else self.versions(name)[live]

    def write(self, df: DataFrame, name: str, mode: str) -> None:
        live = self.live(name)
        if mode == APPEND and live is not None:
            df.write.mode(APPEND).options(**_WRITE_OPTIONS.get(name, {})).format("parquet").saveAsTable(live)
        elif mode == CREATE and live is not None:
            raise ValueError(f"table already exists: {self.locate(name)}")
        else:
            self.publish(self.staged(df, name)[0], name)

    def staged(self, df: DataFrame, name: str) -> tuple[str, int]:
        table = f"{self.locate(name)}_v{self._number(name) + 1:06d}_{uuid.uuid4().hex}"
        ensure_namespace(self.spark, table.split(".")[0])
        df.write.options(**_WRITE_OPTIONS.get(name, {})).format("parquet").saveAsTable(table)
        return table, self.spark.table(table).count()

    def publish(self, staged: str, name: str) -> None:
        view, text = self.locate(name), f"SELECT * FROM {staged}"
        self.spark.sql(f"CREATE VIEW IF NOT EXISTS {view} AS {text}")
        if self.live(name) != staged:
            self.spark.sql(f"ALTER VIEW {view} AS {text}")
        self._expire(name)

    def _expire(self, name: str) -> None:
        oldest = self._number(name) - self.kept + 1
        for table, number in self.versions(name).items():
            if number < oldest:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")

    def drop(self, name: str) -> None:
        """The view first, so that no reader finds a name without rows; then all versions."""
        self.spark.sql(f"DROP VIEW IF EXISTS {self.locate(name)}")
        for table in self.versions(name):
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")


Store = FolderStore | CatalogStore


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    if location is None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    else:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")


def load(df: DataFrame, store: Store, name: str, mode: str = APPEND) -> int:
    """Write ``df`` and return how many rows were written; an empty input writes nothing.

    Rows for a new or a replaced table are written once, beside it; the table is not
    touched before they are complete and known not to be empty, and then takes them
    over by renaming. Rows appended to an existing table are written directly and
    counted on the way.
    """
    if mode == APPEND and store.exists(name):
        seen = Observation()
        store.write(df.observe(seen, F.count(F.lit(1)).alias("rows")), name, mode)
        return seen.get["rows"]
    if mode == CREATE and store.exists(name):
        raise ValueError(f"table already exists: {store.locate(name)}")
    staged, rows = store.staged(df, name)
    if rows:
        store.publish(staged, name)
    else:
        store.drop_staged(staged)
    return rows


def save(df: DataFrame, store: Store, name: str) -> DataFrame:
    """Replace table ``name`` with ``df``, also when empty, and read it back."""
    staged, _ = store.staged(df, name)
    store.publish(staged, name)
    return store.read(name, df.schema)


def loaded_keys(store: Store, name: str, schema: StructType, key: str) -> DataFrame:
    """Distinct keys of a table; none when the table does not exist yet."""
    if store.exists(name):
        return store.read(name, schema).select(key).distinct()
    return store.spark.createDataFrame([], StructType([schema[key]]))


def query(spark: SparkSession, text: str, tables: Mapping[str, DataFrame] | None = None, **args) -> DataFrame:
    """Run SQL text with bound parameters over named DataFrames.

    The names hold for this text alone: temporary views of the session that have one of them
    are back afterwards, and no others stay.
    """
    with _borrowed(spark, tables or {}):
        return spark.sql(text, args=args)


@contextmanager
def _borrowed(spark: SparkSession, tables: Mapping[str, DataFrame]) -> Iterator[None]:
    own = {r["viewName"] for r in spark.sql("SHOW VIEWS").filter("isTemporary").collect()} if tables else set()
    before = {name: spark.table(name) for name in tables if name.lower() in own}
    try:
        publish_views(tables)
        yield
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
        publish_views(before)


def publish_views(tables: Mapping[str, DataFrame]) -> None:
    """Make DataFrames available to SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def coerce(df: DataFrame, schema: StructType) -> DataFrame:
    """Raw-table types: counts as nullable bigint, flags as boolean with NULL as false."""
    columns = []
    for field in schema:
        if field.name not in df.columns:
            continue
        column = F.col(field.name).cast(field.dataType)
        if field.dataType.typeName() == "boolean":
            column = F.coalesce(column, F.lit(False))
        columns.append(column.alias(field.name))
    return df.select(*columns)


def required(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to ``schema``; a NULL in a required column fails the write."""
    columns = []
    for field in schema:
        column = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            failure = F.raise_error(F.lit(f"required column {field.name} is NULL"))
            column = F.coalesce(column, failure.cast(field.dataType))
        columns.append(column.alias(field.name))
    return df.select(*columns)


def within_retention(
    snapshots: DataFrame,
    as_of: date | Column | None = None,
    days: int = fixed.RETENTION_DAYS,
) -> DataFrame:
    """Rows scraped in the last ``days`` days, counted from midnight UTC.

    ``scraped_at`` is ISO text in UTC. For a fixed day a coarse comparison of the
    text itself reaches the Parquet scan; the exact one is on timestamps.
    """
    midnight = F.date_format(F.date_sub(day(as_of), days), "yyyy-MM-dd'T00:00:00Z'")
    oldest = midnight.cast("timestamp")
    kept = snapshots.filter(F.col("scraped_at").cast("timestamp") >= oldest)
    if isinstance(as_of, date):
        coarse = (as_of - timedelta(days=days + 1)).isoformat()
        kept = kept.filter(F.col("scraped_at") >= coarse)
    return kept
