"""Running sums per key in an order by hash, for keys of any size.

A key's rows are cut into slices of its hash range. Slices are summed first; a row's
running sum is that of the slices before its own plus that within its slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import materialize

SLICE_ROWS = 1024
#: Narrow rows of a written file.
FILE_ROWS = 100_000
_SLICE, _BASE, _SUM = "_slice", "_base", "_sum"


def shuffled_order(*parts: Column | str, seed: int = 0) -> Column:
    """A hash that puts rows into a repeatable random order (hexadecimal text)."""
    texts = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *texts))


def unit(order: Column) -> Column:
    """The first 32 bits of a hexadecimal hash as a number from 0 to below 1."""
    return F.conv(F.substring(order, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def materialize_rows(
    df: DataFrame, label: str, rows: int, per_file: int = FILE_ROWS, *, sifted: bool = False
) -> DataFrame:
    """``materialize`` for a table of about ``rows`` rows at most: as many files as they need.

    Say ``sifted`` for few rows out of a large scan: they are dealt out anew, so that the
    scan keeps its tasks.
    """
    files = max(1, -(-rows // per_file))
    return materialize(df.repartition(files) if sifted else df.coalesce(files), label)


def running(
    rows: DataFrame,
    key: str,
    order: str,
    value: str,
    slices: Column,
    name: str,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the key's rows before this one.

    ``rows`` is read twice, so give a written table. ``key`` holds no NULL. ``order``
    is hexadecimal text; ``slices`` says into how many slices this row's key is cut.
    """
    cut = rows.withColumn(_SLICE, F.floor(unit(F.col(order)) * slices))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(key, _SLICE).agg(F.sum(value).alias(_SUM))
    base = sums.withColumn(
        _BASE, F.sum(_SUM).over(before.partitionBy(key).orderBy(_SLICE))
    ).drop(_SUM)
    within = F.sum(value).over(before.partitionBy(key, _SLICE).orderBy(order, *ties))
    return (
        cut.withColumn(_SUM, within)
        .join(base, [key, _SLICE])
        .withColumn(name, F.coalesce(_SUM, F.lit(0)) + F.coalesce(_BASE, F.lit(0)))
        .drop(_SLICE, _SUM, _BASE)
    )


def named_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__row``, text that tells its rows apart and stays the same at every reading.

    Rows read straight from files have their file and place there; others are numbered in a
    written copy.
    """
    if "_metadata" not in docs.columns and docs._jdf.queryExecution().analyzed().children().isEmpty():
        try:
            return docs.withColumn("__row", F.concat_ws("#", "_metadata.file_path", "_metadata.row_index"))
        except AnalysisException:  # a leaf, but no file
            pass
    return materialize(docs.withColumn("__row", F.monotonically_increasing_id().cast("string")), "numbered")
