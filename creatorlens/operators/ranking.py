"""Row-number operators: keep-first, first-n, ranked pages and full rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import materialize

_PLACE_BITS = 33


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows of each key in ``order``.

    The filter on the row number lets Spark cut every key to ``n`` rows before the
    shuffle as well as after it, so a hot key sends at most ``n`` rows per task.
    Spark does so up to a threshold; beyond it each key is cut in slices first.
    """
    spark = df.sparkSession
    if n > int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
        slice_of = F.pmod(F.xxhash64(*df.columns), F.lit(slices))
        df = _cut(df.withColumn("_slice", slice_of), [*keys, "_slice"], order, n).drop("_slice")
    return _cut(df, keys, order, n)


def _cut(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_place", F.row_number().over(window))
        .filter(F.col("_place") <= n)
        .drop("_place")
    )


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def ranked_page(df: DataFrame, order: Sequence[Column], n: int, name: str = "rank") -> DataFrame:
    """The first ``n`` rows in order with their place; only those ``n`` rows are numbered.

    ``n`` is the length of a page. ``ranked`` numbers any number of rows.
    """
    window = Window.orderBy(*order)
    return top(df, order, n).withColumn(name, F.row_number().over(window).cast("bigint"))


def ranked(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Place of every row in a total order, without gathering the rows in one task.

    The sorted rows are written once together with their sort task and their place
    inside it; adding the sizes of the earlier tasks gives the place overall. The
    table of task sizes has one row per sort task, which bounds its broadcast.
    """
    slot = F.monotonically_increasing_id()
    written = materialize(df.orderBy(*order).withColumn("_slot", slot), "ranked")
    task = F.shiftright("_slot", _PLACE_BITS)
    before = F.sum("_rows").over(
        Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        written.groupBy(task.alias("_task"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_task", F.coalesce(before, F.lit(0)).alias("_before"))
    )
    place = F.col("_slot").bitwiseAND(F.lit(2**_PLACE_BITS - 1))
    return (
        written.withColumn("_task", task)
        .join(F.broadcast(offsets), "_task")
        .withColumn(name, F.col("_before") + place + 1)
        .drop("_task", "_before", "_slot")
    )
