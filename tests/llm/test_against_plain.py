"""Learning and packing against plain versions, and the registered queries without SQL on given documents."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from creatorlens.llm import packing, queries, toxicity

FOLDER = "/root/testdata/sf0.001"


def plain_loss(docs, toxic, weights, bias):
    total = 0.0
    for doc, is_toxic in zip(docs, toxic):
        clean = 1.0
        for sentence in doc:
            odds = bias + sum(weights.get(f, 0.0) for f in set(sentence))
            clean *= 1 - 1 / (1 + math.exp(-odds))
        total -= math.log(1 - clean if is_toxic else clean)
    return total / len(docs) + toxicity.DECAY / 2 * sum(w * w for w in weights.values())


def test_fitted_weights_are_those_of_a_plain_noisy_or(monkeypatch):
    draw = random.Random(2)
    monkeypatch.setattr(toxicity, "ROUNDS", 6)
    monkeypatch.setattr(toxicity, "LEAST_Z", -1.0)  # all features
    docs, toxic = [], []
    for nth in range(24):
        toxic.append(nth % 3 == 0)
        docs.append([draw.sample([11, 12, 13], draw.randint(0, 2)) + [99] * (toxic[-1] and at == 0) for at in range(draw.randint(1, 3))])
    model = toxicity.fit([[np.array(s, dtype=np.int64) for s in d] for d in docs], np.array(toxic))
    names, step = [11, 12, 13, 99], 1e-5
    weights, bias = dict.fromkeys(names, 0.0), -6.0
    first, second = [0.0] * 5, [0.0] * 5
    for turn in range(1, 7):
        slopes = []
        for name in names:
            up, down = ({**weights, name: weights[name] + s} for s in (step, -step))
            slopes.append((plain_loss(docs, toxic, up, bias) - plain_loss(docs, toxic, down, bias)) / (2 * step))
        slopes.append((plain_loss(docs, toxic, weights, bias + step) - plain_loss(docs, toxic, weights, bias - step)) / (2 * step))
        first = [0.9 * a + 0.1 * g for a, g in zip(first, slopes)]
        second = [0.99 * b + 0.01 * g * g for b, g in zip(second, slopes)]
        moves = [
            toxicity.RATE * (a / (1 - 0.9**turn)) / (math.sqrt(b / (1 - 0.99**turn)) + 1e-8) for a, b in zip(first, second)
        ]
        weights = {name: weights[name] - move for name, move in zip(names, moves)}
        bias = min(bias - moves[-1], -2.0)
    assert model.bias == pytest.approx(bias, abs=1e-3)
    assert {n: model.weights.get(n, 0.0) for n in names} == pytest.approx(weights, abs=2e-3)


def test_noisy_or_as_a_product():
    draw = random.Random(3)
    for many in (0, 1, 2, 9):
        odds = [draw.uniform(-8, 3) for _ in range(many)]
        plain = 1 - math.prod(1 - 1 / (1 + math.exp(-o)) for o in odds)
        assert toxicity.noisy_or(np.array(odds)) == pytest.approx(plain, abs=1e-12)


def optimum(pieces, capacity):
    """Least number of sequences, over all subsets of pieces."""
    full = (1 << len(pieces)) - 1
    best = {0: (0, capacity)}  # sequences used, filled in the last one
    for subset in range(full + 1):
        used, filled = best[subset]
        for nth, size in enumerate(pieces):
            if not subset >> nth & 1:
                fits = filled + size <= capacity
                state = (used, filled + size) if fits else (used + 1, size)
                after = subset | 1 << nth
                best[after] = min(best.get(after, state), state)
    return best[full][0]


@pytest.mark.parametrize("least", [1, 4])
def test_sequences_of_few_pieces_are_as_few_as_can_be(least):
    draw = random.Random(least)
    for _ in range(60):
        pieces = [draw.randint(least, 20) for _ in range(draw.randint(1, 10))]
        counts = np.bincount(pieces, minlength=21)
        plan = packing.bin_completion(counts, 20)
        assert np.bincount([s for times, filling in plan for s in filling * times], minlength=21).tolist() == counts.tolist()
        assert sum(times for times, _ in plan) == optimum(pieces, 20)


@pytest.fixture(scope="module")
def texts(given):
    return {r["doc_id"]: r["text"] for r in given.collect()}


def rows_of(query, spark):
    rows = query(spark, FOLDER).collect()
    return {r["doc_id"]: r for r in rows}, rows


def fold(doc, parts):
    return zlib.crc32(str(doc).encode()) % parts


def test_registered_toxicity(spark, texts):
    found, rows = rows_of(queries.op2_toxicity, spark)
    assert len(rows) == len(texts) and found.keys() == texts.keys()
    for doc, row in found.items():
        assert row["held_out"] == (fold(doc, 5) == 0) and 0 <= row["score"] <= 1
        assert row["predicted"] == int(row["score"] >= 0.5)


def test_registered_token_counts(spark, texts):
    import sentencepiece
    from creatorlens.llm.tokenizers_by_path import vocabulary

    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    found, rows = rows_of(queries.op4_token_counts, spark)
    assert len(rows) == len(texts)
    for doc, text in texts.items():
        many = len(library.encode(text or ""))
        assert tuple(found[doc])[1:4] == (len((text or "").encode()), many, many > 4096)


def test_registered_languages(spark, texts):
    found, rows = rows_of(queries.op5_language_id, spark)
    assert len(rows) == len(texts)
    for doc, text in texts.items():
        row = found[doc]
        assert row["held_out"] == (fold(doc, 4) == 2) and 0 <= row["score"] <= 1
        assert (row["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))


def test_registered_shingles(spark, texts):
    found, rows = rows_of(queries.op8_near_dedup, spark)
    assert len(rows) == len(texts)
    for doc, text in texts.items():
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        shingles = {tuple(words[i : i + 3]) for i in range(max(len(words) - 2, 1))} if words else set()
        assert found[doc]["n_shingles"] == len(shingles)
        assert found[doc]["kept"] == (doc == found[doc]["component_id"]) and found[doc]["component_id"] <= doc


def test_registered_fingerprints(spark, texts):
    found, rows = rows_of(queries.op6_fingerprints, spark)
    order = sorted(texts, reverse=True)
    assert len(rows) == len(texts)
    for at, doc in enumerate(order):
        text, after = texts[doc] or "", texts[order[(at + 1) % len(order)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = found[doc]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= row["near_next"] <= 1 and (row["near_edited"] == 1 or edited != text)


def test_registered_packing_leaves_no_gap(spark, texts):
    _, rows = rows_of(queries.op9_packing, spark)
    assert {r["doc_id"] for r in rows} == texts.keys()
    at = {}
    for row in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert row["offset"] == at.get(row["sequence_id"], 0)
        at[row["sequence_id"]] = row["offset"] + row["length"]
    assert max(at.values()) <= 2048
    ends = {}
    for row in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        assert row["start"] == ends.get(row["doc_id"], 0)
        ends[row["doc_id"]] = row["start"] + row["length"]
