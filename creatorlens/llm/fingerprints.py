"""Fingerprints of weighted bags of words by consistent weighted sampling.

Each of ``samples`` draws picks one (word, level) of a bag so that two bags pick the same
with a chance equal to their generalised Jaccard similarity: the sum of the smaller over
the sum of the greater word counts. Gamma-distributed numbers per word and draw make the
pick consistent: it changes only if the counts around it do.
"""

from __future__ import annotations

import functools
import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Draws per fingerprint.
SAMPLES = 64
#: Text of neighbours that one task holds.
GROUP_BYTES = 8 * 1024 * 1024
#: Words whose draws a task remembers, whose draws are compared at a time, and made at a time.
KEPT_WORDS, STEP_WORDS, TOGETHER = 65_536, 2_048, 256
_NONE = 0  # what an empty bag draws


def word_keys(words: list[str]) -> np.ndarray:
    """64-bit hashes of words."""
    digests = [hashlib.blake2b(w.encode("utf-8", "replace"), digest_size=8).digest() for w in words]
    return np.frombuffer(b"".join(digests), "<u8").astype(np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers (the finaliser of SplitMix64), in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.cache
def _counters(samples: int, seed: int) -> np.ndarray:
    """A number per hash that a word needs: two for each draw."""
    made = np.random.Generator(np.random.PCG64(seed))
    return made.integers(0, 2**64, 2 * samples, dtype=np.uint64)


def _uniform(hashes: np.ndarray, shift: int) -> np.ndarray:
    """21 bits of each hash as a number between 0 and 1."""
    bits = (hashes >> np.uint64(shift)).astype(np.uint32) & np.uint32(0x1FFFFF)
    found = bits.astype(np.float32)
    found += np.float32(0.5)
    found *= np.float32(2.0**-21)
    return found


def draws(keys: np.ndarray, samples: int = SAMPLES, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word key and draw: log of the race value at weight 1, slope r, and shift beta.

    Computed from key, draw and seed alone, so every word has draws of its own. Slope and
    race value are gamma-distributed with shape 2: minus the log of two uniform numbers.
    """
    base, slope, shift = (np.empty((len(keys), samples), np.float32) for _ in range(3))
    for begin in range(0, len(keys), TOGETHER):
        own = slice(begin, begin + TOGETHER)
        found = _mixed(keys[own, None] ^ _counters(samples, seed))
        first, second = found[:, :samples], found[:, samples:]
        slope[own] = -np.log(_uniform(first, 0) * _uniform(first, 21))
        shift[own] = _uniform(first, 42)
        # The race is won by small values: logs of products near 1, so no bit may be lost there.
        race = np.log(-np.log1p(-_uniform(second, 0)) - np.log1p(-_uniform(second, 21)))
        base[own] = race + slope[own] * shift[own] - slope[own]
    return base, slope, shift


class _Words:
    """Draws of words by their slots. Forgets all words when there is no room for more."""

    def __init__(self, samples: int, seed: int):
        self.samples, self.seed = samples, seed
        self.slots: dict[str, int] = {}
        self.keys = np.empty(KEPT_WORDS, np.uint64)
        self.base, self.slope, self.shift = (np.empty((KEPT_WORDS, samples), np.float32) for _ in range(3))

    def find(self, words: list[str]) -> np.ndarray:
        """Slots of at most ``STEP_WORDS`` different words."""
        fresh = [w for w in words if w not in self.slots]
        if len(self.slots) + len(fresh) > KEPT_WORDS:
            self.slots.clear()
            fresh = words
        if fresh:
            begin = len(self.slots)
            own = slice(begin, begin + len(fresh))
            self.slots.update(zip(fresh, range(begin, own.stop)))
            self.keys[own] = word_keys(fresh)
            self.base[own], self.slope[own], self.shift[own] = draws(self.keys[own], self.samples, self.seed)
        return np.fromiter(map(self.slots.__getitem__, words), np.int64, len(words))


@functools.lru_cache(maxsize=1)
def _words(samples: int, seed: int) -> _Words:
    return _Words(samples, seed)


def sketcher(samples: int = SAMPLES, seed: int = 0) -> Callable[[str], str]:
    """Function from a text to its fingerprint: four hexadecimal digits per draw.

    With a word of weight w, t = floor(ln w / r + beta), the draw's value is
    ln c - r (t - beta) - r, and the least value over the words wins. Words are told apart
    by 64-bit hashes, and the least of them wins among equal values.
    """
    known = _words(samples, seed)
    columns = np.arange(samples)
    empty = f"{_NONE:04x}" * samples

    def sketch(text: str) -> str:
        counted = Counter(text.split())
        if not counted:
            return empty
        words = list(counted)
        counts = np.fromiter(counted.values(), np.int64, len(words))
        best = np.full(samples, np.inf, dtype=np.float32)
        picked = np.zeros(samples, dtype=np.uint64)
        level = np.zeros(samples, dtype=np.int64)
        for begin in range(0, len(words), STEP_WORDS):
            slots = known.find(words[begin : begin + STEP_WORDS])
            weights = counts[begin : begin + STEP_WORDS]
            order = np.argsort(known.keys[slots])
            slots, weights = slots[order], weights[order]
            once, often = slots[weights == 1], slots[weights > 1]
            for own, many in ((once, None), (often, weights[weights > 1])):
                if not len(own):
                    continue
                values, t = known.base[own], None
                if many is not None:
                    r = known.slope[own]
                    t = np.floor(np.log(many).astype(np.float32)[:, None] / r + known.shift[own])
                    values -= r * t
                at = values.argmin(axis=0)
                least, keys = values[at, columns], known.keys[own[at]]
                wins = (least < best) | ((least == best) & (keys < picked))
                best = np.where(wins, least, best)
                picked = np.where(wins, keys, picked)
                level = np.where(wins, 0 if t is None else t[at, columns].astype(np.int64), level)
        mixed = _mixed(picked + level.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        short = (mixed % np.uint64(0xFFFF) + np.uint64(1)).astype(">u2")
        return short.tobytes().hex()

    return sketch


def likeness(first: str, second: str) -> float:
    """Share of draws in which two fingerprints agree."""
    draws = len(first) // 4
    same = np.frombuffer(bytes.fromhex(first), ">u2") == np.frombuffer(bytes.fromhex(second), ">u2")
    return float(same.sum()) / draws if draws else 1.0


def with_fingerprints(docs: DataFrame, text: str = "text", samples: int = SAMPLES, seed: int = 0) -> DataFrame:
    """All rows and columns of ``docs`` and ``fingerprint``.

    Words are what white space separates; NULL is the empty text, and all texts without
    words share one fingerprint that no other text has in any place.
    """

    @F.pandas_udf("string")
    def sketched(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sketch = sketcher(samples, seed)
        for texts in batches:
            yield texts.fillna("").map(sketch)

    return docs.withColumn("fingerprint", sketched(F.col(text)))


def edited(text: str, following: str) -> str:
    """The last half of the text (rounded down) gives way to as much of the start of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _bounds(docs: DataFrame, group_bytes: int) -> list[tuple]:
    """Ranges of (id, tie) in falling order that hold about ``group_bytes`` of text each.

    One row (smallest, greatest) per range comes to the driver.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(least, -(-total // group_bytes))
    keys = docs.select("_id", "_tie").repartitionByRange(ranges, F.desc("_id"), F.desc("_tie"))
    found = (
        keys.select(F.spark_partition_id().alias("part"), F.struct("_id", "_tie").alias("key"))
        .groupBy("part")
        .agg(F.min("key").alias("low"), F.max("key").alias("high"))
        .collect()
    )
    return sorted(((r["low"]["_id"], r["low"]["_tie"], r["high"]["_id"], r["high"]["_tie"]) for r in found), reverse=True)


def neighbours(docs: DataFrame, samples: int = SAMPLES, *, group_bytes: int = GROUP_BYTES, seed: int = 0) -> DataFrame:
    """Fingerprints of each document, of its edited text, and their likeness.

    ``docs``: doc_id, text. The next document is the one with the next smaller doc_id;
    after the smallest comes the greatest. Rows of equal doc_id follow each other by a
    hash of the text and the text, and a NULL doc_id is below all others. A text is
    shuffled once, into a group of neighbours; the first row of each group is also sent
    to the group before, so a row finds its next one in its own group.
    """
    lowest = F.lit(-(2**63)).cast("long")
    rows = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id"), lowest).alias("_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_tie"),
    )
    bounds = _bounds(rows, group_bytes)
    # Groups count from 0 in falling order: a key belongs to the first group whose low it reaches.
    lows = [(b[0], b[1]) for b in bounds]
    highs = {(b[2], b[3]): nth for nth, b in enumerate(bounds)}
    low_ids = np.array([b[0] for b in bounds][::-1], dtype=np.int64)

    @F.pandas_udf("array<int>")
    def groups(ids: pd.Series, ties: pd.Series) -> pd.Series:
        """A row's own group and, for a group's first row, the one before it as -1 - group."""
        many = len(lows)
        at = many - np.searchsorted(low_ids, ids.to_numpy(), side="right")
        out = []
        for own, key in zip(at.tolist(), zip(ids.tolist(), ties.tolist())):
            while own < many and key < lows[own]:
                own += 1
            while own > 0 and key >= lows[own - 1]:
                own -= 1
            out.append([own, -1 - (own - 1) % many] if highs.get(key) == own else [own])
        return pd.Series(out)

    dealt = (
        rows.withColumn("_to", F.explode(groups("_id", "_tie")))
        .withColumn("_group", F.when(F.col("_to") >= 0, F.col("_to")).otherwise(-1 - F.col("_to")))
        .withColumn("_guest", F.col("_to") < 0)
        .select("_group", "_guest", "_id", "_tie", "doc_id", "text")
    )

    def compared(part: pd.DataFrame) -> pd.DataFrame:
        sketch = sketcher(samples, seed)
        guests = part[part["_guest"]].sort_values("text", ascending=False).head(1)
        own = part[~part["_guest"]].sort_values(["_id", "_tie", "text"], ascending=False)
        texts = [*own["text"].tolist(), *guests["text"].tolist()]
        prints = [sketch(t) for t in texts[:1]]
        out = []
        for nth, name in enumerate(own["doc_id"].array):
            text, after = texts[nth], texts[nth + 1]
            prints.append(sketch(after))
            changed = edited(text, after)  # its words are those of the two texts just read
            of_changed = sketch(changed)
            out.append(
                (
                    name,
                    len(text),
                    hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
                    prints[nth],
                    of_changed,
                    likeness(prints[nth], of_changed),
                    likeness(prints[nth], prints[nth + 1]),
                )
            )
        frame = pd.DataFrame(
            out,
            columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )
        return frame.astype({"doc_id": "Int64"})

    return dealt.groupBy("_group").applyInPandas(
        compared,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )
