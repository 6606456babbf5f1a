"""Quantiles from sketches that are kept per small group and merged for any larger one.

``percentile_approx`` gives a number that can't be merged: every niche, region or page reads
all rows again. A sketch of a group is a few kilobytes, and those of a page's groups make up
the page's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch. Groups of no more rows than this are exact.
SIZE = 4096
SKETCH = "sketch"


def rank_error(size: int = SIZE) -> float:
    """Largest error of a rank, as a share of the rows, in 99 of 100 cases (published for KLL)."""
    return 2.296 / size**0.9723


def sketches(rows: DataFrame, measure: str | Column, *keys: str, size: int = SIZE) -> DataFrame:
    """A sketch of a whole-number measure per group; NULL measures count for nothing."""
    measured = rows.select(*keys, (F.col(measure) if isinstance(measure, str) else measure).cast("bigint").alias("_measure"))
    return measured.groupBy(*keys).agg(F.kll_sketch_agg_bigint("_measure", size).alias(SKETCH))


def merged(parts: DataFrame, *keys: str, size: int = SIZE) -> DataFrame:
    """The sketches of larger groups; those of one page without keys."""
    return parts.groupBy(*keys).agg(F.kll_merge_agg_bigint(SKETCH, size).alias(SKETCH))


def quantile(fraction: float) -> Column:
    """The least value that ``fraction`` of the sketched rows don't exceed; NULL without rows."""
    some = F.kll_sketch_get_n_bigint(SKETCH) > 0
    return F.when(some, F.kll_sketch_get_quantile_bigint(F.when(some, F.col(SKETCH)), F.lit(fraction)))


def sketched_rows() -> Column:
    return F.kll_sketch_get_n_bigint(SKETCH)
