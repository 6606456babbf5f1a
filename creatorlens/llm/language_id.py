"""Language by cross-parsing: which language's sample explains a text in the fewest phrases.

A suffix automaton per language knows every substring of a sample of that language. A
text is cut greedily into phrases, each the longest match in the sample; few phrases mean
much in common. Phrases weigh log2 of the sample's size, as a pointer into it would.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The model is fitted on so many documents of each language and code points of each.
SAMPLE_DOCS, SAMPLE_CHARS = 64, 500
UNKNOWN = "und"
#: Symbols: letters that no sample has, everything that is no letter, then the letters of all samples.
_OTHER, _GAP = 0, 1
#: Transitions of a language are a table up to so many fields and sorted edges beyond.
TABLE_FIELDS = 2**23
#: Texts are parsed in segments of so many symbols, so many symbols at a time.
SEGMENT, TOGETHER = 1_024, 2_000_000


@dataclass(frozen=True)
class Samples:
    """Sample text per language, by name."""

    languages: tuple[str, ...]
    texts: tuple[str, ...]


def collect_samples(
    labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS
) -> Samples:
    """From rows (order, text, lang): of each language the first documents in a hash order.

    From each the middle part. At most ``sample_docs * sample_chars`` code points per
    language come to the driver, whatever the size of the table.
    """
    begin = F.greatest(F.lit(1), ((F.length("text") - sample_chars) / 2).cast("int"))
    order = Window.partitionBy("lang").orderBy("order", "part")
    rows = (
        labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
        .select("lang", "order", F.substr("text", begin, F.lit(sample_chars)).alias("part"))
        .withColumn("nth", F.row_number().over(order))
        .filter(F.col("nth") <= sample_docs)
        .collect()
    )
    parts: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["nth"])):
        parts.setdefault(row["lang"], []).append(row["part"])
    names = tuple(sorted(parts))
    return Samples(names, tuple("\n".join(parts[n]) for n in names))


@dataclass(frozen=True)
class Automaton:
    """Transitions of all substrings of a sample; state 0 is the start and stands for none.

    Symbols are numbered anew from those the sample has: ``own_of`` gives 0 for others.
    Transitions are a table by state and own symbol or, for a large alphabet, edges sorted
    by state * width + own symbol.
    """

    own_of: np.ndarray
    width: int
    start: np.ndarray
    table: np.ndarray | None
    edges: np.ndarray | None
    targets: np.ndarray | None

    def follow(self, states: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The states after these, 0 where there is no transition."""
        if self.table is not None:
            return self.table[states * self.width + own]
        following = np.zeros(len(states), dtype=self.targets.dtype)
        held = np.flatnonzero(own)
        wanted = states[held] * self.width + own[held]
        at = np.searchsorted(self.edges, wanted)
        found = self.edges[at] == wanted  # the last edge is greater than any
        following[held[found]] = self.targets[at[found]]
        return following


def suffix_automaton(symbols: list[int], many: int, fields: int = TABLE_FIELDS) -> Automaton:
    """The automaton of a sample over symbols below ``many``."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and c not in step[at]:
            step[at][c] = new
            at = link[at]
        if at >= 0:
            target = step[at][c]
            if length[target] == length[at] + 1:
                link[new] = target
            else:
                clone = len(step)
                step.append(dict(step[target]))
                link.append(link[target])
                length.append(length[at] + 1)
                while at >= 0 and step[at].get(c) == target:
                    step[at][c] = clone
                    at = link[at]
                link[target] = link[new] = clone
        last = new
    held = np.array(sorted(step[0]), dtype=np.int64)
    own_of = np.zeros(many, dtype=np.int32)
    own_of[held] = np.arange(1, len(held) + 1)
    width = len(held) + 1
    sizes = np.fromiter(map(len, step), np.int64, len(step))
    states = np.repeat(np.arange(len(step)), sizes)
    chars = np.fromiter((c for row in step for c in row), np.int64, len(states))
    kind = np.uint16 if len(step) <= 2**16 else np.uint32
    targets = np.fromiter((t for row in step for t in row.values()), kind, len(states))
    edges = states * width + own_of[chars]
    start = np.zeros(width, dtype=kind)
    start[edges[: sizes[0]]] = targets[: sizes[0]]
    if len(step) * width <= fields:
        table = np.zeros(len(step) * width, dtype=kind)
        table[edges] = targets
        return Automaton(own_of, width, start, table, None, None)
    order = np.argsort(edges)
    return Automaton(
        own_of, width, start, None, np.append(edges[order], np.iinfo(np.int64).max), np.append(targets[order], kind(0))
    )


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    symbol_of: np.ndarray
    automata: tuple[Automaton, ...]
    weights: tuple[float, ...]


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


@functools.lru_cache(maxsize=2)
def fitted(samples: Samples) -> Model:
    """All letters of the samples are symbols; letters that differ in case only are one."""
    folded = {c: low if len(low := c.lower()) == 1 else c for text in samples.texts for c in set(text) if c.isalpha()}
    alphabet = sorted(set(folded.values()))
    symbol_of = np.where(_letters(), _OTHER, _GAP).astype(np.uint8 if len(alphabet) <= 254 else np.int32)
    for nth, letter in enumerate(alphabet, 2):
        symbol_of[ord(letter)] = nth
        if len(upper := letter.upper()) == 1 and upper.lower() == letter:
            symbol_of[ord(upper)] = nth
    for c, letter in folded.items():
        symbol_of[ord(c)] = symbol_of[ord(letter)]
    coded = [symbol_of[_points(text)] for text in samples.texts]
    return Model(
        samples.languages,
        symbol_of,
        tuple(suffix_automaton(c.tolist(), len(alphabet) + 2) for c in coded),
        tuple(float(np.log2(len(c) + 2)) for c in coded),
    )


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)


def phrases(automaton: Automaton, columns: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Phrases of each segment; segments are columns, the longest first."""
    start = automaton.start
    state = np.zeros(columns.shape[1], dtype=np.int64)
    count = np.zeros(columns.shape[1], dtype=np.int32)
    active = columns.shape[1]
    for place in range(columns.shape[0]):
        while active and lengths[active - 1] <= place:
            active -= 1
        own = automaton.own_of[columns[place, :active]]
        following = automaton.follow(state[:active], own)
        missed = np.flatnonzero(following == 0)
        again = start[own[missed]]
        # A phrase ends before the symbol; one that the sample lacks is a phrase of its own.
        count[missed] += (state[missed] != 0).astype(np.int32) + (again == 0)
        following[missed] = again
        state[:active] = following
    return count + (state != 0)


def classify(model: Model, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and score of each text; the score is how much fewer phrases it needs than the next."""
    coded = [model.symbol_of[_points(t)] for t in texts]
    known = [i for i, c in enumerate(coded) if len(c) and (c != _GAP).any()]
    languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not known or not model.languages:
        return languages, scores
    owner = np.concatenate([np.full(-(-len(coded[i]) // SEGMENT), i) for i in known])
    whole = [coded[i][b : b + SEGMENT] for i in known for b in range(0, len(coded[i]), SEGMENT)]
    lengths = np.array([len(s) for s in whole])
    order = np.argsort(-lengths, kind="stable")
    columns = np.full((int(lengths[order[0]]), len(whole)), _GAP, dtype=model.symbol_of.dtype)
    for at, nth in enumerate(order.tolist()):
        columns[: lengths[nth], at] = whole[nth]
    costs = np.empty((len(model.languages), len(texts)))
    for nth, (automaton, weight) in enumerate(zip(model.automata, model.weights)):
        found = phrases(automaton, columns, lengths[order])
        costs[nth] = np.bincount(owner[order], weights=found, minlength=len(texts)) * weight
    ranked = np.sort(costs, axis=0)
    best = np.argmin(costs, axis=0)  # the first of equal ones: languages are in order
    for i in known:
        languages[i] = model.languages[best[i]]
        scores[i] = 1 - ranked[0, i] / ranked[1, i] if len(ranked) > 1 else 1.0
    return languages, scores


def identify(samples: Samples):
    """A Pandas UDF: text to (lang, score). NULL and texts without a letter: ``und``, 0."""

    @F.pandas_udf("lang string, score double")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = fitted(samples)
        for texts in batches:
            texts = texts.fillna("").tolist()
            names: list[str] = []
            scores: list[float] = []
            begin, size = 0, 0
            for end, text in enumerate(texts, 1):
                size += len(text)
                if size >= TOGETHER or end == len(texts):
                    found = classify(model, texts[begin:end])
                    names += found[0]
                    scores += found[1]
                    begin, size = end, 0
            yield pd.DataFrame({"lang": names, "score": scores})

    return language.asNondeterministic()  # else a filter on the answer asks for it twice


def with_language(docs: DataFrame, samples: Samples, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` and ``lang_pred``, ``lang_score``.

    Repeated rows get the same answer; equal costs go to the first language by name;
    without samples every text is ``und``.
    """
    columns = [c for c in docs.columns if c not in ("lang_pred", "lang_score")]
    return (
        docs.select(*columns)
        .withColumn("__found", identify(samples)(F.col(text)))
        .select(*columns, F.col("__found.lang").alias("lang_pred"), F.col("__found.score").alias("lang_score"))
    )


def in_fold(row_id: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(row_id).cast("string"), F.lit("")).cast("binary")) % folds == fold
