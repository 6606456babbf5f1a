"""Packing of documents into sequences of a fixed number of tokens, by bin completion.

Pieces of one length are alike, so the search runs over how many pieces there are of each
length: at most ``capacity`` numbers, however many documents there are. It yields fillings
and how often each is used; pieces then find their place by their rank within their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..sources.workspace import materialize
from .spread import SLICE_ROWS, running, shuffled_order
from .tokenizers_by_path import byte_bpe

#: Fillings tried per sequence, nodes of one filling's search, and fillings placed after the first solution.
BRANCHES, FILLING_NODES, SEARCH_STEPS = 3, 2_000, 4_000


def fillings(room: int, counts: np.ndarray, branches: int, nodes: int) -> list[tuple[int, ...]]:
    """Fillings of ``room`` worth trying, least waste first; lengths in falling order.

    Depth first, the longest piece that fits first, so the first one found is the
    best-fit filling. Branches that can't waste less than the worst kept are cut, and so
    are fillings to which another piece could be added: a fuller one dominates them. A
    single piece that fills the room exactly dominates all others.
    """
    if room > 0 and counts[room]:
        return [(room,)]
    present = np.flatnonzero(counts[: room + 1])
    present = present[present > 0][::-1].tolist()
    if not present:
        return [()]
    kept: list[tuple[int, tuple[int, ...]]] = []
    seen: set[tuple[int, ...]] = set()
    left = [nodes]
    smallest = present[-1]
    used: dict[int, int] = {}

    def descend() -> None:
        """Depth first over a stack of its own: a filling may hold thousands of pieces."""
        chosen: list[int] = []
        nodes_open = [(0, 0, room)]  # first length allowed, next one to try, room left
        while nodes_open:
            at, trying, free = nodes_open.pop()
            extended = trying > at
            if not extended:
                left[0] -= 1
            going, given_up = None, False
            if free >= smallest:
                for i in range(trying, len(present)):
                    if present[i] <= free and used.get(present[i], 0) < counts[present[i]]:
                        going = i
                        break
            if going is not None:
                given_up = left[0] <= 0 and bool(kept) or len(kept) == branches and kept[0][0] == 0 == kept[-1][0]
            if going is not None and not given_up:
                size = present[going]
                nodes_open += [(at, going + 1, free), (going, going, free - size)]
                used[size] = used.get(size, 0) + 1
                chosen.append(size)
                continue
            if not extended and not given_up and (
                free < smallest
                or not any(size <= free and used.get(size, 0) < counts[size] for size in present[:at])
            ):
                offer(free, chosen)
            if chosen:
                used[chosen.pop()] -= 1

    def offer(waste: int, chosen: list[int]) -> None:
        found = tuple(chosen)
        if found in seen or len(kept) == branches and waste >= kept[-1][0]:
            return
        seen.add(found)
        kept.append((waste, found))
        kept.sort(key=lambda x: (x[0], len(x[1])))
        del kept[branches:]

    descend()
    return [found for _, found in kept]


def least_sequences(counts: np.ndarray, capacity: int) -> int:
    """No packing needs fewer: pieces above half and what they can't take of the others."""
    sizes = np.arange(capacity + 1)
    total = int((counts * sizes).sum())
    best = -(-total // capacity)
    many, volume = np.cumsum(counts), np.cumsum(counts * sizes)
    half = capacity // 2
    for k in np.flatnonzero(counts[: half + 1]):
        above = int(many[-1] - many[capacity - k])
        middle = int(many[capacity - k] - many[half])
        small = int(volume[half] - (volume[k - 1] if k else 0))
        room = middle * capacity - int(volume[capacity - k] - volume[half])
        best = max(best, above + middle + max(0, -(-(small - room) // capacity)))
    return best


def bin_completion(
    counts: np.ndarray,
    capacity: int,
    *,
    branches: int = BRANCHES,
    nodes: int = FILLING_NODES,
    steps: int = SEARCH_STEPS,
) -> list[tuple[int, tuple[int, ...]]]:
    """Fillings with how often each is used; ``counts[n]`` pieces of length ``n`` all placed.

    Completes the sequence of the longest piece left, as often as its filling's pieces
    allow. The first descent takes the least wasteful filling each time and becomes the
    incumbent; the search then goes back to other fillings, cut off where the sequences
    so far and the lower bound of the rest reach the incumbent. It ends when that bound
    is met or after ``steps`` more fillings; the incumbent is complete in any case.
    """
    counts = counts.astype(np.int64).copy()
    bound = least_sequences(counts, capacity)
    best: list[tuple[int, tuple[int, ...]]] | None = None
    best_used = np.inf
    stack: list[tuple[np.ndarray, list, int, tuple[int, ...] | None]] = [(counts, [], 0, None)]
    spent = 0
    while stack and best_used > bound and (best is None or spent < steps):
        state, plan, used, choice = stack.pop()
        state, plan = state.copy(), list(plan)
        while True:
            if best is not None:
                spent += 1
                if used + least_sequences(state, capacity) >= best_used or spent >= steps:
                    break
            largest = int(np.flatnonzero(state)[-1]) if state.any() else 0
            if not largest:
                if used < best_used:
                    best, best_used = plan, used
                break
            if choice is None:
                state[largest] -= 1
                options = fillings(capacity - largest, state, branches, nodes)
                state[largest] += 1
                for other in reversed(options[1:]):
                    stack.append((state.copy(), list(plan), used, other))
                choice = options[0]
            filling = (largest, *choice)
            choice = None
            sizes, need = np.unique(filling, return_counts=True)
            times = int((state[sizes] // need).min())
            state[sizes] -= need * times
            plan.append((times, filling))
            used += times
        if len(stack) > 4 * capacity:
            del stack[: -2 * capacity]  # the earliest alternatives are tried last anyway
    return best or []


_PLACES = StructType(
    [StructField(n, LongType()) for n in ("length", "_from", "_to", "_each", "_first", "_offset")]
)


def places(plan: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, ...]]:
    """Rows (length, ranks from, to, pieces per sequence, first sequence, offset)."""
    ranks: dict[int, int] = {}
    rows, first = [], 0
    for times, filling in plan:
        offset = 0
        for size in sorted(set(filling), reverse=True):
            each = filling.count(size)
            start = ranks.get(size, 0)
            ranks[size] = start + each * times
            rows.append((size, start, ranks[size], each, first, offset))
            offset += size * each
        first += times
    return rows


def pack(pieces: DataFrame, capacity: int, *, length: str = "length", seed: int = 0) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of 1 to ``capacity`` tokens.

    ``pieces`` must be a written table: it is read several times. Every row gets a place,
    repeated rows one each; places within a sequence follow each other without a gap.
    Which of the pieces of one length gets which place is decided by a hash of the row.
    An empty table gives an empty one.
    """
    spark = pieces.sparkSession
    histogram = pieces.groupBy(F.col(length).cast("long").alias("length")).count().collect()  # ≤ capacity rows
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in histogram:
        if row["length"] is None or not 0 < row["length"] <= capacity:
            raise ValueError(f"a piece of {row['length']} tokens; 1 to {capacity} fit")
        counts[row["length"]] = row["count"]
    plan = bin_completion(counts, capacity)
    # At most capacity lengths; a filling has fewer than sqrt(2 * capacity) different ones.
    table = F.broadcast(spark.createDataFrame(places(plan), _PLACES))
    slices = F.broadcast(
        spark.createDataFrame(
            [(n, int(-(-c // SLICE_ROWS))) for n, c in enumerate(counts.tolist()) if c] or [(0, 1)],
            "length long, _slices long",
        )
    )
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    keyed = (
        pieces.select(*columns)
        .withColumn("length", F.col(length).cast("long"))
        .join(slices, "length")
        .withColumn("_order", shuffled_order(*[c for c in columns if c != "ids"], seed=seed))
        .withColumn("_one", F.lit(1))
    )
    ranked = running(keyed, "length", "_order", "_one", F.col("_slices"), "_rank")
    return (
        ranked.join(table, "length")
        .filter((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
        .withColumn("_nth", F.col("_rank") - F.col("_from"))
        .withColumn("sequence_id", F.col("_first") + F.floor(F.col("_nth") / F.col("_each")))
        .withColumn("offset", F.col("_offset") + (F.col("_nth") % F.col("_each")) * F.col("length"))
        .select(*columns, "sequence_id", "offset")
    )


def cut(ids: np.ndarray, capacity: int) -> Iterator[tuple[int, np.ndarray]]:
    """A document's pieces: all full but the first one."""
    first = len(ids) % capacity or capacity
    start, end = 0, min(first, len(ids))
    while start < len(ids):
        yield start, ids[start:end]
        start, end = end, end + capacity


def document_pieces(
    docs: DataFrame, path: str, capacity: int, *, end_id: int = 0, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked, ids.

    A document is its token ids and ``end_id``; NULL is the empty text. Other columns of
    ``docs`` are left out.
    """
    fields = "start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids

    @F.pandas_udf(f"array<struct<{fields}>>")
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = byte_bpe(path)

        def described(text: str | None) -> list[dict]:
            found = encode(text) if text else np.empty(0, np.uint32)
            ids = np.empty(len(found) + 1, dtype="<u4")
            ids[:-1], ids[-1] = found, end_id
            return [
                {"start": start, "length": len(part), "ids_crc32": zlib.crc32(part.tobytes())}
                | ({"ids": part.astype(np.int64)} if with_ids else {})
                for start, part in cut(ids, capacity)
            ]

        for texts in batches:
            yield texts.map(described)

    return (
        docs.select("doc_id", F.posexplode(pieces("text")).alias("piece", "_p"))
        .select("doc_id", "piece", "_p.*")
    )


def pack_documents(
    docs: DataFrame, path: str, capacity: int, *, end_id: int = 0, with_ids: bool = False
) -> DataFrame:
    """Pieces of all documents with their places; tokenised once."""
    cut_up = document_pieces(docs, path, capacity, end_id=end_id, with_ids=with_ids)
    return pack(materialize(cut_up, "pieces"), capacity)
