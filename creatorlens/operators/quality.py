"""Data tests: one row per test with its number of failures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed


def _report(table: str, column: str, test: str, failures: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(test).alias("test"),
        failures.cast("bigint").alias("failures"),
    )


def column_checks(
    df: DataFrame,
    table: str,
    *,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """not_null and accepted_values tests of one table, all in a single scan.

    Failures are rows; NULL is not a failure of accepted_values.
    """
    tests = [(name, "not_null", F.col(name).isNull()) for name in not_null]
    for name, values in (accepted or {}).items():
        tests.append((name, "accepted_values", ~F.col(name).isin(list(values))))
    counts = df.agg(*[F.count_if(failed).alias(f"t{i}") for i, (_, _, failed) in enumerate(tests)])
    reports = [_report(table, name, test, F.col(f"t{i}")) for i, (name, test, _) in enumerate(tests)]
    return counts.select(F.inline(F.array(*reports)))


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Failures are the values that occur more than once; NULL is left out."""
    repeated = (
        df.filter(F.col(column).isNotNull()).groupBy(column).count().filter(F.col("count") > 1)
    )
    counts = repeated.agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.inline(F.array(_report(table, column, "unique", F.col("n")))))


def foreign_key(df: DataFrame, table: str, column: str, parent: DataFrame) -> DataFrame:
    """Failures are the rows whose key has no parent; rows are counted per key first."""
    keys = df.filter(F.col(column).isNotNull()).groupBy(column).count()
    orphans = keys.join(parent.select(column).distinct(), column, "left_anti")
    total = orphans.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"))
    return total.select(F.inline(F.array(_report(table, column, "relationships", F.col("n")))))


def staging_tests(
    stg_channels: DataFrame,
    stg_videos: DataFrame,
    niches: Sequence[str] = fixed.NICHES,
    regions: Sequence[str] = fixed.REGIONS,
) -> DataFrame:
    """The declared tests of the staging tables, and that channels are named."""
    parts = [
        column_checks(
            stg_channels,
            "stg_channels",
            not_null=["channel_id", "channel_name"],
            accepted={"niche": niches, "region": regions},
        ),
        unique(stg_channels, "stg_channels", "channel_id"),
        column_checks(stg_videos, "stg_videos", not_null=["video_id", "channel_id"]),
        unique(stg_videos, "stg_videos", "video_id"),
    ]
    return reduce(DataFrame.unionByName, parts)
