"""Spelling variants: words one edit apart, grouped under their most frequent forms.

One inserted, deleted or replaced letter changes the bag of a word's letters by one letter
or by two, so as a binary vector (a place per letter and repetition) by a Hamming distance
of two at most. PartEnum: letters are dealt to ``parts`` parts, two vectors that near agree
on all but two of them, and a word's signatures are what is left of its vector without each
two parts. Words with an equal signature are compared; no pair that near is missed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from ..sources.workspace import materialize

#: Parts of the alphabet, and the Hamming distance that signatures allow for.
PARTS, DISTANCE = 7, 2
#: Words with one signature beyond which they are told apart by half of their letters too.
CROWD = 256
#: How much more frequent a form must be than its variant.
RATIO = 5


def _mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def signatures(words: Sequence[str], parts: int) -> np.ndarray:
    """A row per word, a column per two parts left out: a hash of the bag of all other letters.

    A bag's hash is the sum of its letters' hashes, so leaving out a part is a subtraction.
    """
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    sums = np.zeros((len(words), parts), np.uint64)
    np.add.at(sums, (owner, letters % parts), _mixed(letters.astype(np.uint64) + np.uint64(1)))
    total = sums.sum(axis=1, dtype=np.uint64)
    rest = [total - sum(sums[:, p] for p in left_out) for left_out in combinations(range(parts), DISTANCE)]
    return np.stack([_mixed(r + np.uint64(nth)) for nth, r in enumerate(rest, 1)], axis=1).view(np.int64)


def _signed(words: DataFrame, parts: int) -> DataFrame:
    """A written table (word, n, signature), a row per signature."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = signatures(batch.column("word").to_pylist(), parts)
            own = pa.array(np.repeat(np.arange(len(found)), found.shape[1]))
            columns = [batch.column("word").take(own), batch.column("n").take(own), pa.array(found.ravel())]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", "signature"])

    return materialize(words.select("word", "n").mapInArrow(sign, "word string, n long, signature long"), "signatures")


def _halves(signature: Column, word: Column, size: Column) -> Column:
    """Signatures together with the first or last half of the shorter of two words one edit apart.

    The edit lies behind the first half or before the last one. The word may be the shorter
    of the two (or as long), or the longer.
    """
    made = []
    for shorter in (size, size - 1):
        half = F.floor(shorter / 2).cast("int")
        made.append(F.xxhash64(signature, shorter, F.lit("first"), F.substr(word, F.lit(1), half)))
        made.append(F.xxhash64(signature, shorter, F.lit("last"), F.substr(word, size - half + 1, half)))
    return F.array(*made)


def near_pairs(words: DataFrame, *, parts: int = PARTS, crowd: int = CROWD) -> DataFrame:
    """A written table (a, n_a, b, n_b) of all words (word, n) one edit apart, a before b."""
    signed = _signed(words, parts)
    crowded = signed.groupBy("signature").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > crowd)
    marked = lookup_join(signed, materialize(crowded, "crowded"), "signature")
    size = F.length("word")
    keys = F.when(F.col("members").isNull(), F.array("signature")).otherwise(_halves(F.col("signature"), F.col("word"), size))
    keyed = marked.select(F.explode(keys).alias("key"), "word", "n", size.alias("size"))
    left = keyed.select("key", F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("size").alias("size_a"))
    right = keyed.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("size").alias("size_b"))
    near = (
        (F.col("a") < F.col("b"))
        & (F.abs(F.col("size_a") - F.col("size_b")) <= 1)
        & (F.levenshtein("a", "b", 1) == 1)
    )
    pairs = left.join(right, (left["key"] == right["key"]) & near).select("a", "n_a", "b", "n_b")
    return materialize(pairs.distinct(), "near-words")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all rows (word, form): where following forms ends.

    Every round a word's target is replaced by its target's target, so ways get half as
    long. A form is ``ratio`` times as frequent as its word, so a way has at most log(n)
    steps and there are no circles.
    """
    state = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = materialize(lookup_join(state, onward, "root"), "roots")
        state = moved.select("word", F.coalesce("_next", "root").alias("root"))
        if moved.filter(F.col("_next").isNotNull()).isEmpty():
            return state


def variants(words: DataFrame, *, ratio: int = RATIO, parts: int = PARTS, crowd: int = CROWD) -> DataFrame:
    """Every word of ``words`` (word, n; one row per word, at least two letters) with its form.

    Columns: word, form (of the words one edit apart the one with the greatest n, the
    smaller in code-point order among equals; NULL unless its n is at least ``ratio`` times
    the word's), root (the last form reached from the word, itself without a form), n,
    n_near (words one edit apart) and form_n. Give a written table. No words give no rows.
    """
    pairs = near_pairs(words, parts=parts, crowd=crowd)
    both = pairs.unionByName(
        pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b"))
    )
    best = F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form")))
    around = both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.select("word", "n").join(around, "word", "left")
    has_form = -F.col("best.less") >= ratio * F.col("n")
    found = materialize(
        joined.select(
            "word",
            F.when(has_form, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(found.filter(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
