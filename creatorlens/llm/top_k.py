"""Exact top-k by inner product: branch-and-bound over blocks of dimensions.

Vectors lie in blocks, dimension by dimension. A query's scores grow by one block of
dimensions at a time; before the next, candidates go whose sum so far plus the most that
the remaining dimensions can add stays below a score that k others are sure to reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import materialize

#: Vectors of a block, queries that visit it together, and dimensions added at a time.
BLOCK_ROWS, QUERY_ROWS, STEP = 4_096, 1_024, 16
_BLOCKS = "dims int, block long, ids binary, columns binary"
_HITS = "query_block long, query_row long, query_id long, vec_id long, score long"


def scaled(vector: np.ndarray, factor: int) -> np.ndarray:
    """Whole numbers, as doubles so that any finite component has its place.

    A product beyond all doubles becomes the greatest of them.
    """
    with np.errstate(over="ignore"):
        found = np.floor(np.asarray(vector, dtype=np.float64) * factor)
    return np.clip(found, -np.finfo(np.float64).max, np.finfo(np.float64).max)


def exact(numbers: np.ndarray, most: float) -> np.ndarray:
    """Whole doubles as 64-bit numbers if sums of products up to ``most`` fit, else as Python's."""
    if most < 2.0**62:
        return numbers.astype(np.int64)
    return np.frompyfunc(int, 1, 1)(numbers) if numbers.size else numbers.astype(object)


def _within(score) -> int:
    """The nearest 64-bit number."""
    return max(-(2**63), min(2**63 - 1, int(score)))


def _packed(factor: int, block_rows: int):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Blocks of one length of vector each, columns first; whole rows only."""
        waiting: dict[int, tuple[list, list]] = {}
        made = 0

        def block(size: int) -> pd.DataFrame:
            nonlocal made
            ids, vectors = waiting.pop(size)
            columns = np.stack(vectors, axis=1) if size else np.empty((0, len(ids)), np.float64)
            name = (TaskContext.get().partitionId() << 32) + made
            made += 1
            return pd.DataFrame(
                {"dims": [size], "block": [name], "ids": [np.asarray(ids, np.int64).tobytes()], "columns": [columns.tobytes()]}
            )

        for batch in batches:
            for name, vector in zip(batch["vec_id"].tolist(), batch["vector"]):
                ids, vectors = waiting.setdefault(len(vector), ([], []))
                ids.append(name)
                vectors.append(scaled(vector, factor))
                if len(ids) == block_rows:
                    yield block(len(vector))
        for size in list(waiting):
            yield block(size)

    return pack


def _opened(row) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], dtype=np.int64)
    return ids, np.frombuffer(row["columns"], dtype=np.float64).reshape(row["dims"], len(ids))


def tail_masses(columns: np.ndarray, step: int) -> np.ndarray:
    """Per block of dimensions and vector: the length of what lies beyond that block."""
    with np.errstate(over="ignore"):
        squares = np.square(columns.astype(np.float64))
    ends = range(step, columns.shape[0], step)
    return np.array([np.sqrt(squares[end:].sum(axis=0)) for end in ends]).reshape(len(ends), columns.shape[1])


def best_of_block(
    query: np.ndarray,
    columns: np.ndarray,
    tails: np.ndarray,
    k: int,
    step: int,
    skip: int | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores in a block that include its k best for ``query`` with all ties."""
    dims, rows = columns.shape
    alive = np.arange(rows)
    if skip is not None:
        alive = np.delete(alive, skip)
    score = np.zeros(len(alive), dtype=columns.dtype)
    least = None
    for nth, begin in enumerate(range(0, dims, step)):
        end = min(begin + step, dims)
        part = columns[begin:end] if len(alive) == rows else columns[begin:end, alive]
        score = score + query[begin:end] @ part
        if end == dims or len(alive) <= k:
            continue
        if least is None:  # incumbents: the k that lead so far, scored in full
            leaders = alive[np.argpartition(score, len(score) - k)[-k:]]
            least = _within((query @ columns[:, leaders]).min())
        with np.errstate(over="ignore", invalid="ignore"):
            rest = float(np.sqrt(np.square(query[end:].astype(np.float64)).sum()))
            gain = np.nan_to_num(tails[nth, alive] * rest * (1 + 1e-9) + 1, nan=np.inf, posinf=np.inf)
        if columns.dtype == object:  # numbers beyond doubles are compared as they are
            stays = np.array([g == np.inf or s + int(g * (1 + 1e-9)) + 1 >= least for s, g in zip(score, gain.tolist())], bool)
        else:
            stays = score + gain >= least
        alive, score = alive[stays], score[stays]
    return alive, score


def _searched(k: int, step: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                ids, columns = _opened(row)
                tails = tail_masses(columns, step)
                names = np.frombuffer(row["query_ids"], dtype=np.int64)
                places = np.frombuffer(row["query_rows"], dtype=np.int64)
                queries = np.frombuffer(row["queries"], dtype=np.float64).reshape(len(names), row["dims"])
                with np.errstate(over="ignore"):
                    most = np.abs(queries).max(initial=0.0) * np.abs(columns).max(initial=0.0) * max(1, row["dims"])
                queries, columns = exact(queries, most), exact(columns, most)
                own = row["block"] == row["query_block"]
                found = []
                for name, place, query in zip(names.tolist(), places.tolist(), queries):
                    at, score = best_of_block(query, columns, tails, k, step, place if own else None)
                    if score.dtype == object:
                        score = np.array([_within(s) for s in score], np.int64)
                    order = np.lexsort((ids[at], ~score))[:k]  # ~ turns the order around, also for the least number
                    found.append(
                        pd.DataFrame(
                            {"query_block": row["query_block"], "query_row": place, "query_id": name, "vec_id": ids[at][order], "score": score[order]}
                        )
                    )
                if found:
                    yield pd.concat(found)

    return search


def _query_blocks(divisor: int, query_rows: int):
    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                ids, columns = _opened(row)
                chosen = np.flatnonzero(ids % divisor == 0)
                for begin in range(0, len(chosen), query_rows):
                    part = chosen[begin : begin + query_rows]
                    yield pd.DataFrame(
                        {
                            "dims": [row["dims"]],
                            "query_block": [row["block"]],
                            "query_ids": [ids[part].tobytes()],
                            "query_rows": [part.astype(np.int64).tobytes()],
                            "queries": [np.ascontiguousarray(columns[:, part].T).tobytes()],
                        }
                    )

    return take


def usable(vector: Column) -> Column:
    """Neither NULL nor holding NULL, NaN or an infinite component."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf")))
    )
    return vector.isNotNull() & ~bad


def search(
    vectors: DataFrame,
    k: int,
    *,
    query_divisor: int,
    vector: str = "embedding",
    factor: int = 256,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    step: int = STEP,
) -> DataFrame:
    """The k best rows for each query row: query_id, rank, vec_id, score.

    Components become ``floor(factor * x)``; the score is their integer inner product,
    ties go to the smaller vec_id. Queries are the rows whose vec_id is divisible by
    ``query_divisor``; candidates are all rows but the query's own, so of repeated rows
    the others count. Vectors that aren't usable, and rows without vec_id, take no part;
    vectors meet those of their own length only. Scores are exact; one that doesn't fit 64 bits
    counts as the nearest number that does. Queries visit every block of candidates:
    the queries are a fixed part of the rows, so this work is what the question asks for.
    """
    rows = vectors.select("vec_id", F.col(vector).alias("vector")).filter(
        F.col("vec_id").isNotNull() & usable(F.col("vector"))
    )
    blocks = materialize(rows.mapInPandas(_packed(factor, block_rows), _BLOCKS), "blocks")
    queries = materialize(
        blocks.mapInPandas(
            _query_blocks(query_divisor, query_rows),
            "dims int, query_block long, query_ids binary, query_rows binary, queries binary",
        ),
        "queries",
    )
    # Every block of queries with every block of candidates, both of bounded size.
    lanes = max(1, blocks.sparkSession.sparkContext.defaultParallelism)
    lane = F.pmod(F.xxhash64("block"), F.lit(lanes))
    left = blocks.withColumn("lane", lane)
    right = queries.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))))
    hits = left.join(right, ["dims", "lane"]).drop("lane").mapInPandas(_searched(k, step), _HITS)
    order = Window.partitionBy("query_block", "query_row").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
