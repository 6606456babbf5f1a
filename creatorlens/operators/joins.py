"""Equi-joins that hold when one key carries a large share of the rows.

A lookup is broadcast only after its size was measured. Beyond the bound the
rows of hot keys are spread over many tasks: both sides get a salt, and only the
few hot rows of the lookup are copied.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from ..sources.workspace import materialize

#: The driver needs up to about four times as much for a moment.
BROADCAST_BYTES = 128 * 1024 * 1024
#: Wide rows that one task of a join sorts.
TASK_ROWS = 50_000
_ROW_OVERHEAD = 48
_SALT = "_salt"
_TASKS = "_tasks"


def measured_bytes(lookup: DataFrame) -> int:
    """Approximate in-memory size: one pass over the lookup, one row to the driver.

    Text and binary values count by their length, nested ones by that of their JSON.
    """
    width: Column = F.lit(_ROW_OVERHEAD)
    for field in lookup.schema:
        width = width + 8
        if isinstance(field.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
            width = width + F.octet_length(F.to_json(F.struct(field.name)))
    return lookup.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def never_sent(side: DataFrame) -> DataFrame:
    """``side`` for a join that shuffles it and is not planned by its estimated size.

    Spark estimates a side by its files and by the width of its columns: ids out of parsed lines
    count as little beside the record they were in, and so would be sent through the driver.
    """
    return side.hint("merge")


def dealt(df: DataFrame, rows: int, key: str) -> DataFrame:
    """``df`` by its key in as many tasks as ``rows`` rows need, each of about ``TASK_ROWS``.

    The number of tasks is not cut down to their compressed bytes. Two sides of a join dealt
    by the same ``rows`` are joined as they lie, and broadcast only if one measured small.
    """
    tasks = max(-(-rows // TASK_ROWS), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, key)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    *,
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot: Sequence[tuple] | None = None,
) -> DataFrame:
    """Join many facts to a lookup with one row per key.

    Give a written (or otherwise cheap) lookup holding only the columns needed:
    it is measured first. ``hot`` as for ``spread_join``.
    """
    if measured_bytes(lookup) <= broadcast_bytes:
        return facts.join(F.broadcast(lookup), key, how)
    return spread_join(facts, lookup, key, how=how, hot=hot)


def hot_keys(facts: DataFrame, key: str, slots: int) -> list[tuple]:
    """Keys with too many rows for one of ``slots`` tasks, and how many tasks they need.

    A key is hot with more than ``1/slots`` of all rows, so there are fewer than
    ``slots``, and all of them together need no more than about ``2 * slots`` tasks.
    """
    seen = Observation()
    counted = facts.observe(seen, F.count(F.lit(1)).alias("rows"))
    counts = counted.filter(F.col(key).isNotNull()).groupBy(key).count()
    largest = counts.orderBy(F.desc("count")).limit(slots).collect()
    if not largest:
        return []
    total = seen.get["rows"]
    return [
        (row[key], math.ceil(2 * slots * row["count"] / total))
        for row in largest
        if row["count"] * slots > total
    ]


def hot_counts(counts: DataFrame, key: str, rows: str) -> list[tuple]:
    """As ``hot_keys`` for facts whose ``rows`` per key are counted already."""
    slots = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum(rows)).first()[0] or 0
    hot = counts.filter(F.col(rows) * slots > total).select(key, rows).collect()  # fewer than slots
    return [(row[key], math.ceil(2 * slots * row[rows] / total)) for row in hot]


def spread_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    *,
    how: str = "left",
    hot: Sequence[tuple] | None = None,
    slots: int | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Shuffled join in which hot and NULL keys of ``facts`` are spread over tasks.

    ``hot`` gives the hot keys with their number of tasks if they are known;
    otherwise they are counted. Each hot key gets that many salts, and its row of
    the lookup as many copies. Rows never match on NULL, so NULL keys may go to
    any of ``slots`` tasks. The salt is a hash of ``spread_by`` (all columns by
    default), so a repeated task computes it again.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    spark = facts.sparkSession
    slots = slots or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(facts, key, slots) if hot is None else list(hot)
    tasks = F.when(F.col(key).isNull(), F.lit(slots)).otherwise(F.lit(1))
    if hot:
        schema = StructType([facts.schema[key], StructField(_TASKS, IntegerType())])
        hot_rows = F.broadcast(spark.createDataFrame(hot, schema))  # fewer than slots
        facts = facts.join(hot_rows, key, "left")
        lookup = lookup.join(hot_rows, key, "left")
        tasks = F.coalesce(F.col(_TASKS), tasks)
    salt = F.pmod(F.xxhash64(*(spread_by or facts.columns)), tasks.cast("bigint")).cast("int")
    salts = F.sequence(F.lit(0), (tasks if hot else F.lit(1)) - 1)
    salted_facts = facts.withColumn(_SALT, F.when(tasks > 1, salt).otherwise(0)).drop(_TASKS)
    salted_lookup = lookup.withColumn(_SALT, F.explode(salts)).drop(_TASKS)
    return salted_facts.join(salted_lookup, [key, _SALT], how).drop(_SALT)


def top_with_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    order: Sequence[Column],
    n: int,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    margin: int = 4,
) -> DataFrame:
    """First ``n`` rows, in an order of the facts alone, of the inner join with a lookup.

    Beside a lookup too large to broadcast, the best few facts are found first and
    then looked up. If too few of them have a lookup row, the whole join is done.
    """
    candidates = n * margin
    if measured_bytes(lookup) <= broadcast_bytes:
        return facts.join(F.broadcast(lookup), key).orderBy(*order).limit(n)
    best = materialize(facts.orderBy(*order).limit(candidates), "best")
    columns = list(dict.fromkeys([key, *facts.columns, *lookup.columns]))
    found = lookup_join(lookup, best, key, how="inner").select(*columns)
    found = materialize(found, "found")
    if found.count() < n and best.count() == candidates:
        found = spread_join(facts, lookup, key, how="inner")
    return found.orderBy(*order).limit(n)


def known_keys(
    batch: DataFrame,
    history: DataFrame,
    key: str,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Distinct keys of ``batch`` that occur in ``history``.

    A batch is small next to everything loaded before, so its distinct keys are
    sent to the history scan when their measured size allows: the history is then
    read once, one column wide, without a shuffle. A larger batch is matched by a
    shuffle of distinct keys on both sides, and so is what is joined to the result.
    """
    keys = batch.select(key).filter(F.col(key).isNotNull()).distinct()
    seen = history.select(key)
    if measured_bytes(keys) <= broadcast_bytes:
        return seen.join(F.broadcast(keys), key, "left_semi").distinct()
    return never_sent(keys.join(never_sent(seen.distinct()), key, "left_semi"))


def unseen(
    batch: DataFrame,
    history: DataFrame,
    key: str,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``history`` (NULL keys stay)."""
    known = known_keys(batch, history, key, broadcast_bytes=broadcast_bytes)
    return batch.join(known, key, "left_anti")


def found_in(
    batch: DataFrame,
    key: str,
    histories: dict[str, DataFrame],
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """A written ``batch`` of one row per key with flags whether its key occurs in each history.

    Its keys are sent to the scans of the histories when their measured size allows, as by
    ``known_keys``; otherwise each side is shuffled by its keys once.
    """
    keys = batch.select(key)
    small = measured_bytes(keys) <= broadcast_bytes
    for name, history in histories.items():
        seen = history.select(key)
        if small:
            seen = seen.join(F.broadcast(keys), key, "left_semi")
        found = seen.distinct().withColumn(name, F.lit(True))
        batch = batch.join(found if small else never_sent(found), key, "left").fillna(False, [name])
    return batch
