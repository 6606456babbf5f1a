"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents are put into a random order and cut into blocks of words. A
source's quota is a number of blocks; a tree over the output shards splits all quotas in
halves, drawing without replacement, down to exact quotas of each shard. Shards take
disjoint runs of a permutation of the blocks and shuffle what they got.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup_join, measured_bytes
from ..sources.workspace import materialize
from .spread import SLICE_ROWS, named_rows, running, shuffled_order

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_SPACED_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
#: Words of a block, and blocks of an output shard.
BLOCK_WORDS, SHARD_BLOCKS = 4_096, 1_024
#: Blocks that a mix may have, so that splits can be drawn exactly; larger ones have larger blocks.
MOST_BLOCKS = 2**29
#: Draws up to this measured size are sent to the texts; more are joined by a shuffle.
BROADCAST_BYTES = 4 * 1024 * 1024


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    totals: DataFrame, weights: Sequence[int], share: float, most_passes: int = 2
) -> DataFrame:
    """Target words per source, from one row per source (source, source_size).

    Sources by code point, NULL last, get ``weights`` in turn and share ``share`` times
    all words. A target stops at ``most_passes`` times its source; the excess goes to the
    others by weight. The others end at ``level`` times their weight: with the sources
    in the order in which they fill up, the level follows from running sums.
    """
    everything = Window.orderBy(F.col("source").isNull(), F.col("source"))
    place = F.row_number().over(everything) - 1
    listed = totals.withColumn(
        "_weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    ).withColumn("_most", F.col("source_size") * most_passes)
    filling = Window.orderBy(
        F.col("_most") / F.col("_weight"), F.col("source").isNull(), F.col("source")
    )
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levelled = (
        listed.withColumn("_goal", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)))
        .withColumn("_taken", F.coalesce(F.sum("_most").over(before), F.lit(0)))
        .withColumn("_weights", F.sum("_weight").over(rest))
        .withColumn("_level", (F.col("_goal") - F.col("_taken")) / F.col("_weights"))
        .withColumn("_free", F.col("_level") * F.col("_weight") < F.col("_most"))
    )
    # From the first source that does not fill up on, none does.
    level = F.min(F.when(F.col("_free"), F.struct("_taken", "_level"))).over(Window.partitionBy())
    return (
        levelled.withColumn("_at", level["_level"])
        .withColumn(
            "target",
            F.when(
                F.col("_at").isNotNull() & (F.col("_at") * F.col("_weight") < F.col("_most")),
                F.col("_at") * F.col("_weight"),
            ).otherwise(F.col("_most").cast("double")),
        )
        .select("source", "source_size", "target")
    )


def shard_quotas(quotas: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(blocks before this shard, blocks of this shard) per source, by walking its path.

    At a node over shards ``low`` to ``high``, the left half takes its share of all blocks,
    drawn without replacement from the node's quotas. The draw depends on the seed and the
    node only, so every shard finds the same splits on its own.
    """
    left_of = np.zeros_like(quotas)
    low, high, here = 0, shards, quotas
    while high - low > 1:
        middle = (low + high) // 2
        total = int(here.sum())
        wanted = total * (middle - low) // (high - low)
        draw = np.random.Generator(np.random.PCG64([seed, low, high]))
        left = np.zeros_like(here)
        for i, has in enumerate(here.tolist()):
            if wanted and total:
                took = int(draw.hypergeometric(has, total - has, wanted)) if has < total else wanted
                left[i], wanted, total = took, wanted - took, total - has
        if shard < middle:
            high, here = middle, left
        else:
            left_of, low, here = left_of + left, middle, here - left
    return left_of, here


def block_size(words: int, block_words: int) -> int:
    """Words of a block, ``block_words`` or what keeps all blocks of a mix to ``MOST_BLOCKS``."""
    return max(block_words, -(-words // MOST_BLOCKS))


def permuted(places: np.ndarray, size: int, key: int) -> np.ndarray:
    """Where a random permutation of 0 to ``size`` - 1 sends each of ``places``; it follows from the key.

    Halves of the bits are swapped and mixed four times, which is one-to-one on all numbers of
    that many bits; a number that is sent outside is sent on until it comes back.
    """
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask, outside = np.uint64((1 << half) - 1), np.arange(len(places))
    now = places.astype(np.uint64)
    while len(outside):
        left, right = now[outside] >> np.uint64(half), now[outside] & mask
        for nth in range(4):
            mixed = (right + np.uint64((key + nth * 0x9E3779B97F4A7C15) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(29))) >> np.uint64(7) & mask)
        now[outside] = (left << np.uint64(half)) | right
        outside = outside[now[outside] >= size]
    return now.astype(np.int64)


def mix(
    docs: DataFrame,
    weights: Sequence[int],
    share: float,
    *,
    most_passes: int = 2,
    block_words: int = BLOCK_WORDS,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = 0,
) -> DataFrame:
    """All rows of ``docs`` (doc_id, source, size) with what the mix takes of them.

    Give a written table; other columns stay, except those added: ``source_size``,
    ``target``, ``taken`` (words) and ``draws``, one struct (pass, words, block, shard,
    place) per time the document is drawn. A source with a target of t words in S is
    read in its random order until t words are taken, starting anew after S words, so a
    document is taken t/S times rounded up or down and only the last one of a source is
    cut. A document belongs to the block that holds its first word, and is drawn in the
    passes in which the tree dealt that block to a shard. Documents without
    words and sources without words take nothing. NULL is a source of its own; repeated
    rows are documents of their own; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    added = ("source_size", "target", "taken", "draws")
    docs = docs.select(*[c for c in docs.columns if c not in added])
    named = docs.withColumn("_key", F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source")))
    totals = materialize(
        named.groupBy("_key").agg(
            F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows")
        ),
        "sources",
    )
    everything = totals.agg(F.sum("source_size")).first()[0] or 0
    block_words = block_size(everything * most_passes, block_words)
    wanted = targets(totals.select("source", "source_size"), weights, share, most_passes)
    keyed = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source"))
    goals = materialize(
        totals.select("_key", "_rows")
        .join(wanted.withColumn("_key", keyed), "_key")
        .withColumn("_goal", F.least(F.round("target"), F.col("source_size") * most_passes).cast("long"))
        .withColumn("_blocks", F.ceil(F.col("source_size") / block_words))
        .drop("source"),
        "goals",
    )
    per_source = goals.select("_key", "_goal", "_blocks", "source_size").orderBy("_key").collect()  # a row per source
    full, rest = zip(*[divmod(r["_goal"], r["source_size"]) if r["source_size"] else (0, 0) for r in per_source]) if per_source else ((), ())
    quotas = np.array(
        [f * r["_blocks"] + -(-w // block_words) for f, w, r in zip(full, rest, per_source)], dtype=np.int64
    )
    shards = max(1, -(-int(quotas.sum()) // shard_blocks))
    keys, sizes = [r["_key"] for r in per_source], [int(r["_blocks"]) for r in per_source]

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"].tolist():
                before, here = shard_quotas(quotas, shards, int(shard), seed)
                for key, blocks, quota, first, many in zip(keys, sizes, quotas.tolist(), before.tolist(), here.tolist()):
                    if many:
                        nth = permuted(np.arange(first, first + many), quota, zlib.crc32(f"{seed}:{key}".encode()))
                        yield pd.DataFrame(
                            {"_key": key, "_block": nth % blocks, "_pass": nth // blocks, "_shard": shard}
                        )

    blocks = (
        spark.range(shards)
        .mapInPandas(drawn, "_key string, _block long, _pass long, _shard long")
        .groupBy("_key", "_block")
        .agg(F.map_from_entries(F.collect_list(F.struct("_pass", "_shard"))).alias("_shards"))  # ≤ most_passes
    )
    rows = lookup_join(
        named, goals.select("_key", "_rows", "_goal", "source_size", "target"), "_key"
    ).withColumn("_order", shuffled_order("doc_id", seed=seed))
    rows = materialize(rows, "mix-rows")
    ties = ["size", *[c for c in docs.columns if c not in ("doc_id", "source", "size")]]
    placed = running(
        rows, "_key", "_order", "size", F.ceil(F.col("_rows") / SLICE_ROWS), "_before", ties
    ).withColumn("_block", F.floor(F.col("_before") / block_words))

    def one(nth: int) -> Column:
        """What a drawn block gives of a document; the block in which the goal ends gives a part."""
        shard = F.try_element_at("_shards", F.lit(nth).cast("long"))
        left = F.col("_goal") - F.col("source_size") * nth - F.col("_before")
        words = F.when(shard.isNotNull(), F.greatest(F.lit(0), F.least(F.col("size"), left))).otherwise(0)
        return F.struct(
            F.lit(nth).cast("long").alias("pass"),
            words.cast("long").alias("words"),
            F.col("_block").alias("block"),
            shard.alias("shard"),
            shuffled_order("_order", F.lit(nth), seed=seed + 1).alias("place"),
        )

    draws = F.filter(F.array(*[one(n) for n in range(most_passes)]), lambda d: d["words"] > 0)
    return (
        placed.join(blocks, ["_key", "_block"], "left")
        .withColumn("draws", draws)
        .withColumn("taken", F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"]))
        .select(*docs.columns, *added)
    )


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its n-th word."""
    pieces = F.regexp_extract_all(text, F.lit(_SPACED_WORD), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")


def mixed_documents(docs: DataFrame, weights: Sequence[int], share: float, **settings) -> DataFrame:
    """The mix itself: a row per draw with the columns of ``docs`` (doc_id, source, text).

    Names and sizes are shuffled for the draws, then each text drawn once to its shard. A
    document of which the mix takes a part ends with its last word taken, and its n_chars,
    if there, follows. Rows come by ``in_shards``: a partition per shard, shuffled within.
    """
    numbered = named_rows(docs)
    sized = materialize(numbered.select("__row", "doc_id", "source", n_words("text").alias("size")), "sized")
    drawn = mix(sized, weights, share, **settings).select("__row", F.col("size").alias("__size"), F.explode("draws").alias("__draw"))
    draws = materialize(
        drawn.select("__row", "__size", *[F.col(f"__draw.{n}").alias(f"__{n}") for n in ("words", "shard", "place")]), "draws"
    )
    last = draws.agg(F.max("__shard")).first()[0]
    ids = F.broadcast(draws) if measured_bytes(draws) <= BROADCAST_BYTES else draws
    part = F.col("__words") < F.col("__size")
    taken = numbered.join(ids, "__row").withColumn(
        "text", F.when(part, first_words(F.col("text"), F.col("__words"))).otherwise(F.col("text"))
    )
    if "n_chars" in docs.columns:
        taken = taken.withColumn("n_chars", F.when(part, F.length("text")).otherwise(F.col("n_chars")))
    return in_shards(taken, 1 + (last or 0), "__shard", "__place").select(*docs.columns)


def in_shards(drawn: DataFrame, shards: int, shard: str = "shard", place: str = "place") -> DataFrame:
    """Rows, one per draw, in one partition per shard and shuffled within it."""
    return drawn.repartitionById(shards, F.col(shard).cast("int")).sortWithinPartitions(place)
