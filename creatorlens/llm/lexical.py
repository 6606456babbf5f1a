"""Ranked lexical search for many queries at once, with shared parts computed once.

Queries (items) share terms. Sets of terms that several items hold are mined from the items
of a block: terms held by the same items become one set, then the two parts that most items
hold together become one, again and again. This gives a directed graph from terms over
shared sets to items. Documents are scored in batches: a partial score per set and document
is added up once and used by every larger set and item above it.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import first_per_key
from ..sources.workspace import materialize

#: Terms of items that one pass over the documents looks for, all items together.
PASS_TERMS = 2**20
#: Pairs of shared terms that a block of items may have, so that mining takes bounded time.
BLOCK_PAIRS = 2**21
#: Numbers (sets times documents) that a task holds, and bytes of a text it splits at a time.
HELD_NUMBERS, SPLIT_BYTES = 2**22, 2**20
#: Texts that are turned into Python objects at a time.
TOGETHER = 256
_NO_ID = 2**63 - 1
#: Bytes of terms: digits, letters and all of non-ASCII characters; A-Z lower-cased, others blank.
_TERM_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def term_pieces(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, in lists of bounded size."""
    data, begin = (text or b"").translate(_TERM_BYTES), 0
    while begin < len(data):
        end = data.find(b" ", begin + SPLIT_BYTES)
        end = len(data) if end < 0 else end
        yield data[begin:end].split()
        begin = end


def counted_terms(text: bytes | None) -> Counter:
    found: Counter = Counter()
    for terms in term_pieces(text):
        found.update(terms)
    return found


class Shared(NamedTuple):
    """A graph of sums: parts 0 to ``terms`` are terms, then sets, then items, by level."""

    terms: int
    #: Per level: parts that each of its nodes adds up, one after the other, and where each begins.
    levels: list[tuple[np.ndarray, np.ndarray]]
    #: Node of each item.
    items: np.ndarray

    @property
    def additions(self) -> int:
        return sum(len(parts) - len(starts) for parts, starts in self.levels)


def shared_sets(items: Sequence[Sequence[int]], terms: int) -> Shared:
    """The graph for items given as distinct term numbers below ``terms``, none of them empty."""
    holders: dict[int, list[int]] = defaultdict(list)
    for nth, held in enumerate(items):
        for term in held:
            holders[term].append(nth)
    alike: dict[tuple, list[int]] = defaultdict(list)
    for term, those in sorted(holders.items()):
        alike[tuple(those)].append(term)
    made: list[tuple[int, ...]] = []  # parts of the sets from number ``terms`` on
    private: list[list[int]] = [[] for _ in items]
    common: list[set[int]] = [set() for _ in items]

    def new(parts: Sequence[int]) -> int:
        made.append(tuple(parts))
        return terms + len(made) - 1

    for those, group in alike.items():
        if len(those) == 1:
            private[those[0]] += group
            continue
        node = group[0] if len(group) == 1 else new(group)
        for nth in those:
            common[nth].add(node)
    together: dict[tuple[int, int], set[int]] = defaultdict(set)
    for nth, nodes in enumerate(common):
        for pair in combinations(sorted(nodes), 2):
            together[pair].add(nth)
    waiting = [(-len(those), pair) for pair, those in together.items() if len(those) > 1]
    heapq.heapify(waiting)
    while waiting:
        less, pair = heapq.heappop(waiting)
        those = together.get(pair, set())
        if len(those) < 2 or -less != len(those):
            if len(those) > 1:
                heapq.heappush(waiting, (-len(those), pair))
            continue
        node, those = new(pair), sorted(those)
        touched: dict[tuple[int, int], set[int]] = defaultdict(set)
        for nth in those:
            for old in pair:
                common[nth].discard(old)
                for other in common[nth]:
                    together[min(old, other), max(old, other)].discard(nth)
            for other in common[nth]:
                touched[other, node].add(nth)
            common[nth].add(node)
        del together[pair]
        together.update(touched)
        for more, its in touched.items():
            if len(its) > 1:
                heapq.heappush(waiting, (-len(its), more))
    # Sets by level, so that each adds up what is there already; items come last.
    depth: dict[int, int] = {}
    for nth, parts in enumerate(made):
        depth[terms + nth] = 1 + max(depth.get(p, 0) for p in parts)
    order = sorted(depth, key=lambda node: (depth[node], node))
    place = {old: terms + nth for nth, old in enumerate(order)}
    levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add_level(sums: list[list[int]]) -> None:
        starts = np.cumsum([0, *map(len, sums[:-1])])
        levels.append((np.array([p for s in sums for p in s], np.int64), starts.astype(np.int64)))

    for level in range(1, max(depth.values(), default=0) + 1):
        add_level([[place.get(p, p) for p in made[node - terms]] for node in order if depth[node] == level])
    add_level([[*own, *(place.get(p, p) for p in sorted(nodes))] for own, nodes in zip(private, common)])
    first = terms + len(made)
    return Shared(terms, levels, np.arange(first, first + len(items)))


def blocks(items: Sequence[Sequence[int]], most_pairs: int = BLOCK_PAIRS) -> list[range]:
    """Consecutive items whose terms form at most so many pairs, or one item alone."""
    found, begin, pairs = [], 0, 0
    for nth, held in enumerate(items):
        pairs += len(held) ** 2
        if pairs > most_pairs and nth > begin:
            found.append(range(begin, nth))
            begin, pairs = nth, len(held) ** 2
    return [*found, range(begin, len(items))] if len(items) > begin else found


class _Best:
    """The k best documents of each item so far; holds few more than that."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.held = [np.empty(0, np.int64) for _ in range(4)]  # item, score, doc_id, without id

    def add(self, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        item, at = np.nonzero(scores >= self.least[:, None])
        new = (item, scores[item, at], ids[at], nameless[at])
        self.held = [np.concatenate(pair) for pair in zip(self.held, new)]
        if len(self.held[0]) > 4 * self.k * len(self.least):
            self.settle()

    def settle(self) -> None:
        item, score, ids, nameless = self.held
        order = np.lexsort((nameless, ids, -score, item))
        item = item[order]
        starts = np.searchsorted(item, np.arange(len(self.least)))
        place = np.arange(len(item)) - starts[item]
        self.held = [column[order][place < self.k] for column in self.held]
        last = place == self.k - 1
        self.least[item[last]] = score[order][last]


def _postings(docs: DataFrame, numbers) -> DataFrame:
    """A written table (doc_id, n, terms, times) of the documents that have a term at all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.value
        for batch in batches:
            for begin in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(begin, TOGETHER)
                sizes, terms, times = [], [], []
                for text in part.column("text").to_pylist():
                    counted = counted_terms(text)
                    sizes.append(counted.total())
                    found = [(known[t], n) for t, n in counted.items() if t in known]
                    terms.append([t for t, _ in found])
                    times.append([n for _, n in found])
                columns = [part.column("doc_id"), pa.array(sizes, pa.int64())]
                columns += [pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "times"])

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    made = rows.mapInArrow(count, "doc_id long, n long, terms array<int>, times array<long>")
    return materialize(made.filter(F.col("n") > 0), "postings")


def weight(documents: int, having: int) -> int:
    """floor(1000 ln((2 N + 2) / (2 df + 1)))"""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * having + 1)))


def length_share(n: int, documents: int, all_terms: int) -> int:
    """100 - 50 + ((50 n N) div L)"""
    return 100 - 50 + (50 * n * documents) // all_terms


class _Plan(NamedTuple):
    graphs: list[tuple[np.ndarray, Shared, np.ndarray]]  # terms of a block, its graph, its items' numbers
    weights: np.ndarray
    documents: int
    all_terms: int


def _scored(plan, k: int):
    """Tasks' k best documents of each item."""

    def block_scores(graph: Shared, values: np.ndarray) -> np.ndarray:
        filled = graph.terms
        for parts, starts in graph.levels:
            filled += len(starts)
            values[filled - len(starts) : filled] = np.add.reduceat(values[parts], starts, axis=0)
        return values[graph.items]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: _Plan = plan.value
        best = [_Best(len(graph.items), k) for _, graph, _ in given.graphs]
        widest = max(graph.items[-1] + 1 + len(parts) for _, graph, _ in given.graphs for parts, _ in graph.levels)
        together = max(1, HELD_NUMBERS // int(widest))
        for batch in batches:
            for begin in range(0, batch.num_rows, together):
                part = batch.slice(begin, together)
                lists, many = part.column("terms"), part.num_rows
                ends = lists.offsets.to_numpy()
                terms = lists.values.to_numpy()[ends[0] : ends[-1]]
                times = part.column("times").values.to_numpy()[ends[0] : ends[-1]]
                doc = np.repeat(np.arange(many), np.diff(ends))
                share = np.array([length_share(n, given.documents, given.all_terms) for n in part.column("n").to_pylist()], np.int64)
                gains = given.weights[terms] * ((1_000_000_000 * times) // (1000 * times + 20 * share[doc]))
                ids = part.column("doc_id")
                nameless = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                ids = ids.fill_null(_NO_ID).to_numpy()
                for (own, graph, _), found in zip(given.graphs, best):
                    at = np.searchsorted(own, terms)
                    here = np.flatnonzero(own[np.minimum(at, len(own) - 1)] == terms)
                    if not len(here):
                        continue
                    values = np.zeros((int(graph.items[-1]) + 1, many), np.int64)
                    values[at[here], doc[here]] = gains[here]
                    found.add(block_scores(graph, values), ids, nameless)
        for (_, _, names), found in zip(given.graphs, best):
            found.settle()
            item, scores, ids, nameless = found.held
            columns = [names[item], pa.array(ids, mask=nameless == 1), scores]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query", "doc_id", "score"])

    return score


def _plan(items: list[list[int]], names: Sequence[int], weights: np.ndarray, documents: int, all_terms: int) -> _Plan:
    graphs = []
    for block in blocks(items):
        own = np.unique(np.concatenate([np.asarray(items[i], np.int64) for i in block]))
        local = {term: nth for nth, term in enumerate(own.tolist())}
        graph = shared_sets([[local[t] for t in items[i]] for i in block], len(own))
        graphs.append((own, graph, np.array([names[i] for i in block], np.int64)))
    return _Plan(graphs, weights, documents, all_terms)


def _pass(docs: DataFrame, items: list, k: int) -> DataFrame | None:
    """(query, doc_id, score) of a pass's items [(query, terms)], k or a few times k rows each."""
    context = docs.sparkSession.sparkContext
    numbers: dict[bytes, int] = {}
    for _, terms in items:
        for term in terms:
            numbers.setdefault(term, len(numbers))
    postings = _postings(docs, context.broadcast(numbers))
    total = postings.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
    having = postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # of the pass's terms
    if not having:
        return None
    weights = np.zeros(len(numbers), np.int64)
    for row in having:
        weights[row["term"]] = weight(total["documents"], row["count"])
    held = [[numbers[t] for t in terms if weights[numbers[t]] > 0] for _, terms in items]
    names = [query for (query, _), terms in zip(items, held) if terms]
    held = [terms for terms in held if terms]
    if not held:
        return None
    plan = context.broadcast(_plan(held, names, weights, total["documents"], total["terms"]))
    return postings.mapInArrow(_scored(plan, k), "query long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int, *, pass_terms: int = PASS_TERMS) -> DataFrame:
    """The k best documents for each row of ``items`` (item_id, text): item_id, rank, doc_id, score.

    ``docs``: doc_id, text. Terms are the longest runs of digits, ASCII letters and non-ASCII
    characters of whole texts, A-Z lower-cased; NULL has none. A document's score adds, for
    each of the item's terms once, its weight times a share that grows with its times in the
    document and shrinks with the document's length; statistics are over all documents.
    Only scores above 0 count, ties go to the smaller doc_id (NULL last). Every row is an
    item or a document of its own, also where ids are repeated or NULL. Items are dealt to
    passes by hash, each of about ``pass_terms`` terms at most (or one item), which come to
    the driver; a pass reads all documents. Without documents or items there are no rows.
    """
    spark = docs.sparkSession
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(counted_terms(t)) for t in batch.column("text").to_pylist()]
            columns = [batch.column("query"), batch.column("item_id"), pa.array(found, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["query", "item_id", "terms"])

    rows = items.select(
        F.monotonically_increasing_id().alias("query"), "item_id", F.col("text").cast("binary").alias("text")
    )
    asked = materialize(rows.mapInArrow(split, "query long, item_id long, terms array<binary>"), "items")
    passes = max(1, -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // pass_terms))
    hits = spark.createDataFrame([], "query long, doc_id long, score long")
    for nth in range(passes):
        own = asked.filter(F.pmod(F.xxhash64("query"), F.lit(passes)) == nth).orderBy("query")
        found = _pass(docs, [(r["query"], [bytes(t) for t in r["terms"]]) for r in own.collect()], k)
        if found is not None:
            hits = hits.unionByName(found)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    best = materialize(first_per_key(hits, ["query"], order, k), "hits")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
    return ranked.join(asked.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
