"""Toxic sentences learned from labels of whole documents (multiple-instance learning).

A document is toxic if any of its sentences is: with a probability per sentence, that of
the document is their noisy-or. Weights of words and word beginnings are fitted to the
documents' labels through it, and then tell which sentences offend.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import shuffled_order

#: The model is fitted on so many labelled documents of each kind at most.
SAMPLE_TOXIC, SAMPLE_CLEAN = 2_000, 4_000
#: Beginnings of words that are features beside the words themselves.
BEGINNINGS = (4, 5, 6, 7)
#: A feature counts if so many documents of the sample have it, and how much more often toxic ones.
LEAST_DOCS, LEAST_Z = 4, 2.0
ROUNDS, RATE, DECAY = 200, 0.2, 1e-4
_KEPT_WORDS = 200_000
_SENTENCE_END = re.compile(r"[.!?…。！？\n]+")
_STRIP = "\"'`.,;:!?()[]{}<>|*_#-–—«»„“”‘’/\\&$%~^+="


def sentences(text: str) -> list[str]:
    return [s for s in _SENTENCE_END.split(text) if s and not s.isspace()]


def features(word: str) -> list[int]:
    """Hashes of a word and of its beginnings."""
    word = word.strip(_STRIP)
    if not word:
        return []
    parts = ["=" + word, *[word[:n] for n in BEGINNINGS if len(word) >= n]]
    return [zlib.crc32(p.encode("utf-8", "replace")) for p in parts]


@dataclass(frozen=True)
class Model:
    weights: dict[int, float]
    bias: float


def log_odds_of(model: Model):
    """Function from a sentence to its log-odds; remembers words."""
    get = model.weights.get
    remembered: dict[str, float] = {}

    def word(w: str) -> float:
        found = remembered.get(w)
        if found is None:
            if len(remembered) >= _KEPT_WORDS:
                remembered.clear()
            found = remembered[w] = sum(get(f, 0.0) for f in features(w))
        return found

    def sentence(s: str) -> float:
        return model.bias + sum(map(word, set(s.split())))

    return sentence


def noisy_or(log_odds: np.ndarray) -> float:
    """1 minus the product of the sentences' chances to be clean."""
    return float(-np.expm1(-np.logaddexp(0.0, log_odds).sum())) if len(log_odds) else 0.0


def fit(docs: list[list[np.ndarray]], toxic: np.ndarray, share_toxic: float | None = None) -> Model:
    """Weights by gradient descent on the likelihood of the documents' labels.

    ``docs``: per document, per sentence, the features of its words. ``share_toxic`` is
    that of all labelled documents, if the sample has another.
    """
    if not len(docs) or not toxic.any() or toxic.all():
        return Model({}, -50.0 if not toxic.any() else 50.0)
    of_doc = [np.unique(np.concatenate([*d, np.empty(0, np.int64)])) for d in docs]
    names, docs_with = np.unique(np.concatenate(of_doc), return_counts=True)
    _, toxic_with = np.unique(
        np.concatenate([names, *[f for f, y in zip(of_doc, toxic) if y]]), return_counts=True
    )
    toxic_with = toxic_with - 1
    share = toxic.mean()
    wanted = share_toxic or share
    counts_for = np.where(toxic, wanted / share, (1 - wanted) / (1 - share))
    z = (toxic_with - docs_with * share) / np.sqrt(docs_with * share * (1 - share))
    names = names[(docs_with >= LEAST_DOCS) & (np.abs(z) >= LEAST_Z)]
    if not len(names):
        return Model({}, float(np.log(share / (1 - share))))
    chosen, owner, ends = [], [], []
    for nth, doc in enumerate(docs):
        for sentence in doc:
            at = np.searchsorted(names, sentence)
            at = at[(at < len(names)) & (names[np.minimum(at, len(names) - 1)] == sentence)]
            chosen.append(np.unique(at))
            owner.append(nth)
    lengths = np.array([len(c) for c in chosen])
    flat = np.concatenate(chosen)
    row = np.repeat(np.arange(len(chosen)), lengths)
    owner = np.asarray(owner)
    weights, bias = np.zeros(len(names)), -6.0
    first, second = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, ROUNDS + 1):
        odds = bias + np.bincount(row, weights=weights[flat], minlength=len(chosen))
        chance = 1 / (1 + np.exp(-odds))
        clean = np.bincount(owner, weights=np.logaddexp(0.0, odds), minlength=len(docs))
        # d/d(clean) of -log p(label): 1 for clean documents, -1/(e^clean - 1) for toxic ones
        push = np.where(toxic, -1 / np.expm1(np.maximum(clean, 1e-6)), 1.0) * counts_for
        slope = push[owner] * chance
        gradient = np.append(
            np.bincount(flat, weights=slope[row], minlength=len(names)) / len(docs) + DECAY * weights,
            slope.sum() / len(docs),
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], min(bias - move[-1], -2.0)
    kept = np.abs(weights) > 1e-3
    return Model(dict(zip(names[kept].tolist(), weights[kept].tolist())), float(bias))


def learn(
    docs: DataFrame, labels: DataFrame, sample_toxic: int = SAMPLE_TOXIC, sample_clean: int = SAMPLE_CLEAN
) -> Model:
    """From ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) that may be learned from.

    Takes the first labels of each kind in a hash order, at most as many as said; a
    document with labels of both kinds is toxic. Only those documents' features come
    to the driver.
    """
    clear = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")
    )
    ordered = clear.withColumn("_order", shuffled_order("doc_id"))
    shares = clear.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0]

    def some(kind: int, many: int) -> DataFrame:
        return ordered.filter((F.col("toxic") > 0) == bool(kind)).orderBy("_order").limit(many)

    sample = some(1, sample_toxic).unionByName(some(0, sample_clean)).select("doc_id", "toxic")

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remembered: dict[str, list[int]] = {}
        for batch in batches:
            out = []
            for text in batch["text"]:
                of_text = []
                for sentence in sentences(text.lower()):
                    found: set[int] = set()
                    for word in set(sentence.split()):
                        if word not in remembered:
                            remembered[word] = features(word)
                        found.update(remembered[word])
                    of_text.append(np.fromiter(found, dtype=np.int64).astype(np.uint32))
                ends = np.cumsum([len(s) for s in of_text], dtype=np.int64)
                flat = np.concatenate([*of_text, np.empty(0, np.uint32)]).astype(np.uint32)
                out.append((flat.tobytes(), ends.tobytes()))
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "toxic": batch["toxic"], "features": [o[0] for o in out], "ends": [o[1] for o in out]}
            )

    rows = (
        docs.select("doc_id", "text")
        .filter(F.col("text").isNotNull())
        .join(F.broadcast(sample), "doc_id")  # of bounded size
        .mapInPandas(described, "doc_id long, toxic int, features binary, ends binary")
        .toPandas()
    )
    rows = rows.sort_values(["doc_id", "features"], ignore_index=True).drop_duplicates(["doc_id", "features", "ends"])
    split = [
        np.split(np.frombuffer(f, dtype=np.uint32).astype(np.int64), np.frombuffer(e, dtype=np.int64)[:-1])
        for f, e in zip(rows["features"], rows["ends"])
    ]
    return fit(split, rows["toxic"].to_numpy() > 0, shares)


def scored(model: Model):
    """A Pandas UDF: text to (score, worst sentence's number and log-odds)."""

    @F.pandas_udf("score double, sentence long, log_odds double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of = log_odds_of(model)

        def one(text: str) -> tuple[float, int | None, float | None]:
            odds = np.array([of(s) for s in sentences(text.lower())])
            if not len(odds):
                return 0.0, None, None
            worst = int(odds.argmax())
            return noisy_or(odds), worst, float(odds[worst])

        for texts in batches:
            yield pd.DataFrame(
                [one(t) for t in texts.fillna("")], columns=["score", "sentence", "log_odds"]
            ).astype({"sentence": "Int64", "log_odds": "Float64"})

    return score.asNondeterministic()  # else a filter on the score asks for it twice


def with_toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` and ``toxicity``, ``worst_sentence``, ``worst_log_odds``.

    Sentences count from 0; NULL and texts without a sentence have toxicity 0 and no
    worst sentence. Repeated rows get the same score.
    """
    added = ("toxicity", "worst_sentence", "worst_log_odds")
    columns = [c for c in docs.columns if c not in added]
    return (
        docs.select(*columns)
        .withColumn("__found", scored(model)(F.col(text)))
        .select(*columns, *[F.col(f"__found.{old}").alias(new) for old, new in zip(("score", "sentence", "log_odds"), added)])
    )


def offending(docs: DataFrame, model: Model, least: float = 0.5, text: str = "text") -> DataFrame:
    """All rows of ``docs`` and ``offences``: number, text and chance of each sentence found toxic."""

    @F.pandas_udf("array<struct<sentence:long,text:string,chance:double>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = log_odds_of(model)
        for texts in batches:
            yield texts.fillna("").map(
                lambda t: [
                    {"sentence": n, "text": s, "chance": chance}
                    for n, s in enumerate(sentences(t))
                    if (chance := float(1 / (1 + np.exp(-of(s.lower()))))) >= least
                ]
            )

    return docs.withColumn("offences", found(F.col(text)))
