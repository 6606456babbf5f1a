"""Near-duplicate documents by bottom-k sketches, with every link confirmed on full sets.

Documents with equal shingle sets are one class from the start. A class keeps the k least
hashes of its shingles; inverted lists of the rarer ones give pairs, the sketch of a pair's
union filters them, and exact Jaccard similarity decides.

Two similar sets share most of their sketches, so they meet in a list of one of the rarest
values of each (prefix filter). Each list is first worked off against a few of its members;
those already in one component need no further comparing, so a large group of copies takes
a pair or two per document. Members of lists that are not settled then (groups of texts a
little too different) are searched once more, over their whole sets: rarest shingles first,
a pair's overlap is bounded by what follows the first shingle it shares, and a share of the pairs
is compared before the others, most of which it joins. No list is cut.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import measured_bytes, spread_join
from ..sources.workspace import materialize
from .components import labelled
from .spread import FILE_ROWS, materialize_rows, named_rows

#: Values of a sketch, and how far below the threshold a pair's estimate may lie (in deviations).
SKETCH, DEVIATIONS = 96, 6.0
#: Ids up to this measured size are sent to a scan; more are joined by a shuffle.
BROADCAST_BYTES = 32 * 1024 * 1024
#: How many members of a list the others have been compared with after each round by lists.
PIVOTS = (1, 8)
#: One in how many pairs of whole sets each round compares, until all are compared or joined.
SHARES = (16, 4, 1)
#: Rows of a written file that hold a sketch, and that hold a whole set.
SKETCH_ROWS, SET_ROWS = FILE_ROWS // 10, FILE_ROWS // 20
#: Texts or pairs that a task holds the sets of at a time.
TOGETHER = 256
#: Numbers of the sets, as many as its pairs ask for, that a cell of pairs holds on average.
CELL_NUMBERS = 2_000_000
#: Words whose hashes a task remembers.
KEPT_WORDS = 100_000
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _word_hashes():
    remembered: dict[bytes, int] = {}

    def of(word: bytes) -> int:
        found = remembered.get(word)
        if found is None:
            if len(remembered) >= KEPT_WORDS:
                remembered.clear()
            found = remembered[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return found

    return of


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(width: int):
    """Function from a text to its distinct shingles as 64-bit hashes in rising order.

    A-Z is lower-cased; words are what ASCII white space separates; a text of fewer words
    than ``width`` is one shingle, and one without words has none.
    """
    hash_of = _word_hashes()

    def shingles(text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "replace").lower().split() if text else []
        if not words:
            return np.empty(0, dtype=np.int64)
        if len(words) < width:
            whole = hashlib.blake2b(b" ".join(words), digest_size=8, person=b"short").digest()
            return np.frombuffer(whole, dtype=np.int64)
        hashes = np.fromiter(map(hash_of, words), dtype=np.uint64, count=len(words))
        many = len(words) - width + 1
        total = np.zeros(many, dtype=np.uint64)
        for nth in range(width):
            total = _mixed(total * np.uint64(_MULTIPLIERS[0]) + hashes[nth : nth + many] + np.uint64(nth + 1))
        return np.unique(total.view(np.int64))

    return shingles


def _set_name(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def least_overlap(k: int, similarity: float) -> int:
    """Sketch values that two similar large sets share at least.

    A pair right at the similarity has fewer with the binomial lower tail: with k = 96 in
    1.6 of 10^8 pairs at 0.85 and 1.0 of 10^8 at 0.8.
    """
    return max(1, math.floor(k * similarity - DEVIATIONS * math.sqrt(k * similarity * (1 - similarity))))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, TOGETHER):
            yield batch.slice(begin, TOGETHER)


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    """The rows of a column of number lists, without copying."""
    ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [values[begin:end] for begin, end in zip(ends[:-1], ends[1:])]


def sketched(docs: DataFrame, width: int, k: int) -> DataFrame:
    """A written table (rid, doc_id, n, name, sketch) of all rows; ``name`` stands for the set."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = shingle_hashes(width)
        for batch in _slices(batches):
            sets = [shingles(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"),
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_set_name(s) for s in sets], pa.binary()),
                    pa.array([s[:k] for s in sets], pa.list_(pa.int64())),
                ],
                ["_row", "doc_id", "n", "name", "sketch"],
            )

    row = F.col("_row").cast("string") if "_row" in docs.columns else F.lit(None).cast("string").alias("_row")
    made = docs.select(row, "doc_id", "text").mapInArrow(
        sketch, "_row string, doc_id long, n long, name binary, sketch array<long>"
    )
    return materialize(made.withColumn("rid", F.monotonically_increasing_id()), "sketches")


def _only(table: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of ``table`` whose ``column`` is in ``ids``: sent to the scan if few, else shuffled."""
    if measured_bytes(ids) <= BROADCAST_BYTES:
        ids = F.broadcast(ids)
    return table.join(ids, column, "left_semi")


def _prefixes(classes: DataFrame, k: int, similarity: Fraction) -> DataFrame:
    """A written table (value, cid, n): inverted lists of the rarest values of each sketch."""
    large = least_overlap(k, float(similarity))
    # A set of up to similarity * k shingles meets only sets that are whole in their sketch.
    needed = F.when(
        F.col("n") <= math.floor(k * similarity),
        F.ceil(F.col("n") * similarity.numerator / similarity.denominator),
    ).otherwise(F.least(F.lit(large), F.col("n")))
    postings = classes.select("cid", F.explode("sketch").alias("value"))
    often = postings.groupBy("value").agg(F.count(F.lit(1)).alias("times")).filter(F.col("times") > 1)
    shared = (
        postings.join(often, "value")
        .groupBy("cid")
        .agg(F.array_sort(F.collect_list(F.struct("times", "value"))).alias("_shared"))  # at most k
    )
    sizes = classes.select("cid", "n", (F.least("n", F.lit(k)) - needed + 1).alias("_prefix"), F.least("n", F.lit(k)).alias("_m"))
    kept = shared.join(sizes, "cid").withColumn(
        "_take", F.greatest(F.lit(0), F.col("_prefix") - (F.col("_m") - F.size("_shared"))).cast("int")
    )
    lists = kept.select("cid", "n", F.explode(F.slice("_shared", F.lit(1), F.col("_take"))).alias("_v")).select(
        F.col("_v.value").alias("value"), "cid", "n"
    )
    return materialize(lists, "lists")


def _with_both(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with the columns of ``sets`` (cid, n, hashes) of either end."""
    for end in ("a", "b"):
        named = sets.select(F.col("cid").alias(end), F.col("n").alias(f"n_{end}"), F.col("hashes").alias(f"hashes_{end}"))
        pairs = pairs.join(named, end)
    return pairs


def _judged(pairs: DataFrame, similarity: Fraction, k: int | None = None) -> DataFrame:
    """(a, b, verdict) of pairs with both sets: 1 linked, 0 not.

    With ``k``, hashes are sketches and 2 is for a pair that its whole sets must decide.
    """
    num, den = similarity.numerator, similarity.denominator
    least = float(similarity)
    if k:
        least -= DEVIATIONS * math.sqrt(least * (1 - least) / k)

    def verdict(first: np.ndarray, n_first: int, second: np.ndarray, n_second: int) -> int:
        small, great = sorted((n_first, n_second))
        if small * den < great * num:
            return 0
        common = np.intersect1d(first, second, assume_unique=True)
        if not k or great <= k:
            return int(den * len(common) >= num * (n_first + n_second - len(common)))
        union = np.union1d(first, second)[:k]
        return 2 if np.count_nonzero(common <= union[-1]) >= least * len(union) else 0

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = zip(
                _arrays(batch.column("hashes_a")),
                batch.column("n_a").to_pylist(),
                _arrays(batch.column("hashes_b")),
                batch.column("n_b").to_pylist(),
            )
            found = pa.array([verdict(*row) for row in rows], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), found], ["a", "b", "verdict"])

    return pairs.mapInArrow(judge, "a long, b long, verdict int")


def _whole_sets(ids: DataFrame, docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """A written table (cid, n, hashes) of the whole sets of some classes; reads their texts again."""
    many = ids.count()
    wanted = materialize_rows(_only(classes.select("cid", "name", "doc_id"), ids, "cid"), "wanted", many, sifted=True)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = shingle_hashes(width)
        for batch in _slices(batches):
            sets = [shingles(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_set_name(s) for s in sets], pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
                ["name", "hashes"],
            )

    of_docs = docs.select(F.coalesce("doc_id", F.lit(0)).alias("_id"), "text")
    named = _only(of_docs, wanted.select(F.coalesce("doc_id", F.lit(0)).alias("_id")).distinct(), "_id")
    sets = named.select("text").mapInArrow(whole, "name binary, hashes array<long>")
    found = sets.join(wanted.select("cid", "name"), "name").dropDuplicates(["cid"])
    found = found.select("cid", F.size("hashes").cast("long").alias("n"), "hashes")
    return materialize_rows(found, "sets", many, SET_ROWS)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough. Give written tables.

    Pairs are dealt to the cells of a square by both ends, and a set goes once to each cell
    that asks for it, however many pairs it has there: to as many cells as one side is long.
    """
    num, den = similarity.numerator, similarity.denominator
    mean = sets.agg(F.avg("n")).first()[0] or 0
    side = max(1, math.ceil(math.sqrt(2 * mean * pairs.count() / CELL_NUMBERS)))
    row, column = (F.pmod(F.xxhash64(F.lit(end), end), F.lit(side)) for end in ("a", "b"))
    dealt = pairs.select("a", "b", (row * side + column).alias("cell"))
    asked = dealt.select("cell", F.col("a").alias("cid")).unionByName(dealt.select("cell", F.col("b").alias("cid")))
    given = asked.distinct().join(sets.select("cid", "hashes"), "cid").withColumnRenamed("cell", "in_cell")

    def similar(first: np.ndarray, second: np.ndarray) -> bool:
        small, great = sorted((len(first), len(second)))
        if small * den < great * num:
            return False
        common = len(np.intersect1d(first, second, assume_unique=True))
        return den * common >= num * (small + great - common)

    def confirm(own: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        hashes = dict(zip(held["cid"].tolist(), held["hashes"]))
        found = [similar(hashes[a], hashes[b]) for a, b in zip(own["a"].tolist(), own["b"].tolist())]
        return own.loc[np.array(found, bool), ["a", "b"]]

    return dealt.groupBy("cell").cogroup(given.groupBy("in_cell")).applyInPandas(confirm, "a long, b long")


def _open(lists: DataFrame, labels: DataFrame | None, done: int) -> tuple[DataFrame, int]:
    """A written table of the lists with members of several components, with labels, and its rows.

    Lists of which all have been compared with the first ``done`` are left out as well.
    """
    now = lists if labels is None else lists.join(labels, "cid", "left")
    now = now.withColumn("label", F.col("cid") if labels is None else F.coalesce("label", "cid"))
    unsettled = (
        now.groupBy("value")
        .agg(F.count(F.lit(1)).alias("_members"), F.min("label").alias("_low"), F.max("label").alias("_high"))
        .filter((F.col("_low") != F.col("_high")) & (F.col("_members") > done + 1))
        .select("value")
    )
    found = materialize_rows(now.join(unsettled, "value", "left_semi"), "open-lists", lists.count())
    return found, found.count()


def _meeting(now: DataFrame, first: DataFrame, fits: Column, similarity: Fraction) -> DataFrame:
    """Pairs (a, b) of different components and fitting sizes that meet in a list."""
    num, den = similarity.numerator, similarity.denominator
    other = first.select("value", *[F.col(c).alias(f"_{c}") for c in now.columns if c != "value"])
    fits = (
        (F.col("_cid") < F.col("cid"))
        & (F.col("_label") != F.col("label"))
        & (F.least("n", "_n") * den >= F.greatest("n", "_n") * num)
        & fits
    )
    return now.join(other, "value").filter(fits).select(F.col("_cid").alias("a"), F.col("cid").alias("b")).distinct()


def _listed(now: DataFrame, similarity: Fraction, done: int, pivots: int) -> DataFrame:
    """Pairs (a, b) of each list's members ``done`` to ``pivots`` with all its later members."""
    nth = F.row_number().over(Window.partitionBy("value").orderBy("cid"))
    chosen = now.withColumn("_place", nth).filter(F.col("_place") <= pivots).filter(F.col("_place") > done)
    return _meeting(now, chosen, F.lit(True), similarity)


def _searched(now: DataFrame, similarity: Fraction, k: int, done: int | None, share: int) -> DataFrame:
    """Pairs (a, b) of lists over whole sets that may be similar: one in ``share`` of them.

    What both have is at most what follows in either (``rest``, the value included), and must
    be enough; and the sketches must share what those of similar sets do, as the members' own
    lists took for granted. Shares are parts of each other; what a share of one in ``done``
    had is left out.
    """
    num, den = similarity.numerator, similarity.denominator
    most = F.least("rest", "_rest")
    common = F.size(F.array_intersect("sketch", "_sketch"))
    alike = F.when(F.greatest("n", "_n") > k, common >= least_overlap(k, float(similarity))).otherwise(
        common * (den + num) >= (F.col("n") + F.col("_n")) * num
    )
    dealt = F.xxhash64("_cid", "cid")
    turn = F.pmod(dealt, F.lit(share)) == 0
    if done:
        turn = turn & (F.pmod(dealt, F.lit(done)) != 0)
    return _meeting(now, now, turn & (most * den >= (F.col("n") + F.col("_n") - most) * num) & alike, similarity)


def _whole_lists(sets: DataFrame, similarity: Fraction, k: int) -> DataFrame:
    """A written table (value, cid, n, rest, sketch): inverted lists over whole sets, rarest shingles first."""
    num, den = similarity.numerator, similarity.denominator
    postings = sets.select("cid", F.explode("hashes").alias("value"))
    often = postings.groupBy("value").agg(F.count(F.lit(1)).alias("times")).filter(F.col("times") > 1)
    shared = postings.join(often, "value").groupBy("cid").agg(
        F.array_sort(F.collect_list(F.struct("times", "value"))).alias("_shared")  # of one document
    )
    alone = F.col("n") - F.size("_shared")
    take = F.greatest(F.lit(0), F.col("n") - F.ceil(F.col("n") * num / den) + 1 - alone).cast("int")
    sketch = F.slice("hashes", 1, k).alias("sketch")
    cut = shared.join(sets.select("cid", "n", sketch), "cid").select(
        "cid", "n", "sketch", (F.col("n") - alone).alias("_rest"), F.posexplode(F.slice("_shared", F.lit(1), take))
    )
    return materialize(
        cut.select(F.col("col.value").alias("value"), "cid", "n", (F.col("_rest") - F.col("pos")).alias("rest"), "sketch"), "whole-lists"
    )


def _components(docs: DataFrame, classes: DataFrame, width: int, k: int, similarity: Fraction) -> DataFrame | None:
    """(cid, label) of all classes that have links; None if no two meet.

    Lists of sketch values are worked off against a few of their members at a time; what is
    open then goes through lists over whole sets, a share of the pairs first: they join most of
    a large family of copies, whose other pairs need no comparing then. The last share is all.
    """
    lists = _prefixes(classes, k, similarity)
    sketches = classes.select("cid", "n", F.col("sketch").alias("hashes"))
    labels: DataFrame | None = None
    for done, pivots in zip((0, *PIVOTS), PIVOTS):
        now, many = _open(lists, labels, done)
        if not many:
            return labels
        lists = now.drop("label")
        pairs = materialize_rows(_listed(now, similarity, done, pivots), "pairs", many)
        many = pairs.count()
        known = materialize_rows(_only(sketches, _ends(pairs), "cid"), "pair-sketches", many, SKETCH_ROWS, sifted=True)
        judged = materialize_rows(_judged(_with_both(pairs, known), similarity, k), "judged", many, SKETCH_ROWS)
        sure = judged.filter(F.col("verdict") == 1).select("a", "b")
        asked = materialize_rows(judged.filter(F.col("verdict") == 2).select("a", "b"), "asked-pairs", many)
        sets = _whole_sets(materialize_rows(_ends(asked), "asked", many), docs, classes, width)
        links = sure.unionByName(_confirmed(asked, sets, similarity))
        labels = _joined_labels(labels, materialize_rows(links, "found-links", many, SET_ROWS))
    now, many = _open(lists, labels, PIVOTS[-1])
    if not many:
        return labels
    members = materialize_rows(now.select("cid").distinct(), "members", many)
    sets = _whole_sets(members, docs, classes, width)
    lists = _whole_lists(sets, similarity, k)
    for done, share in zip((None, *SHARES), SHARES):
        now, many = _open(lists, labels, 0)
        if not many:
            break
        lists = now.drop("label")
        pairs = materialize_rows(_searched(now, similarity, k, done, share), "pairs", many)
        links = materialize_rows(_confirmed(pairs, sets, similarity), "found-links", pairs.count(), SET_ROWS)
        labels = _joined_labels(labels, links)
    return labels


def _joined_labels(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after new links: components of what the linked nodes belonged to."""
    if labels is None:
        return labelled(links).select(F.col("node").alias("cid"), "label")
    many = links.count()
    for end in ("a", "b"):
        now = labels.select(F.col("cid").alias(end), F.col("label").alias(f"_{end}"))
        links = links.join(now, end, "left").withColumn(f"_{end}", F.coalesce(f"_{end}", end))
    links = materialize_rows(links, "relabelled", many)
    merged = labelled(links.select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    nodes = labels.unionByName(
        links.select(F.col("a").alias("cid"), F.col("_a").alias("label")).unionByName(
            links.select(F.col("b").alias("cid"), F.col("_b").alias("label"))
        )
    ).distinct()
    moved = nodes.join(merged.select(F.col("node").alias("label"), F.col("label").alias("_to")), "label", "left")
    moved = moved.select("cid", F.coalesce("_to", "label").alias("label"))
    return materialize_rows(moved, "components", labels.count() + 2 * many)


def near_duplicates(
    docs: DataFrame, *, width: int = 5, similarity: Fraction | str = "0.8", sketch: int = SKETCH
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, and _row, cast to text, if given): its component.

    Columns: doc_id, n_shingles, component_id (the smallest doc_id that links lead to),
    kept (whether that is its own) and survivor (true for exactly one row of each
    component, also where rows repeat a doc_id), and _row if given. Texts that are NULL
    or without words are linked with nothing. A NULL doc_id is greater than all others.
    An empty table gives an empty one.
    """
    similarity = Fraction(similarity)
    rows = sketched(docs, width, sketch)
    unknown = F.col("doc_id").isNull()
    first = F.min(F.struct(unknown.alias("unknown"), "doc_id", "rid")).alias("first")
    with_words = rows.filter(F.col("n") > 0)
    names = materialize(with_words.groupBy("name").agg(first, F.count(F.lit(1)).alias("copies")), "set-names")
    leaders = names.select(F.col("first.rid").alias("rid"))
    classes = _only(with_words.select("rid", "doc_id", "n", "name", "sketch"), leaders, "rid").withColumnRenamed("rid", "cid")
    labels = _components(docs, classes, width, sketch, similarity)
    named = names.withColumn("cid", F.col("first.rid"))
    if labels is not None:
        named = named.join(labels, "cid", "left")
    else:
        named = named.withColumn("label", F.lit(None).cast("long"))
    grouped = named.filter((F.col("copies") > 1) | F.col("label").isNotNull()).withColumn("label", F.coalesce("label", "cid"))
    grouped = materialize(grouped.select("name", "label", "first"), "groups")
    heads = grouped.groupBy("label").agg(F.min("first").alias("head"))
    lookup = materialize(grouped.join(heads, "label").select("name", "head"), "heads")
    narrow = rows.select("_row", "rid", "doc_id", "n", "name")
    if measured_bytes(lookup) <= BROADCAST_BYTES:
        found = narrow.join(F.broadcast(lookup), "name", "left")
    else:
        found = spread_join(narrow, lookup, "name", spread_by=["rid"])
    has_head = F.col("head").isNotNull() & (F.col("n") > 0)
    component = F.when(has_head, F.col("head.doc_id")).otherwise(F.col("doc_id"))
    out = found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
        (~has_head | (F.col("head.rid") == F.col("rid"))).alias("survivor"),
        "_row",
    )
    return out if "_row" in docs.columns else out.drop("_row")


def survivors(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` without all but one of each component, all columns."""
    named = named_rows(docs)
    found = near_duplicates(named.select(F.col("__row").alias("_row"), "doc_id", "text"), **settings)
    lost = found.filter(~F.col("survivor")).select(F.col("_row").alias("__row"))
    gone = materialize_rows(lost, "gone", docs.count())
    ids = F.broadcast(gone) if measured_bytes(gone) <= BROADCAST_BYTES else gone
    return named.join(ids, "__row", "left_anti").select(*docs.columns)
