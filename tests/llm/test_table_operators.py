"""Mixing, reply trees, near-duplicates, packing, top-k, pipeline."""

import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from creatorlens.llm import mixing, near_dedup, packing, reply_trees, top_k
from creatorlens.llm import tokenizers_by_path as by_path
from creatorlens.llm.components import labelled


def sized(documents, rows):
    return documents(rows).select("doc_id", "source", mixing.n_words().alias("size"))


def test_mix_meets_targets_exactly(spark, documents):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(0, 90), "en", f"s{min(i % 9, 4)}") for i in range(600)] + [(None, "a b", "en", None), (None, "a b", "en", None)]
    mixed = mixing.mix(sized(documents, rows), (3, 1, 2), 1.5, block_words=100, shard_blocks=7).collect()
    taken, target, size = Counter(), {}, Counter()
    for r in mixed:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        size[r["source"]] += r["size"]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == sum(d["words"] for d in r["draws"])
        assert all(d["shard"] is not None for d in r["draws"])
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert all(r["source_size"] == size[r["source"]] for r in mixed)
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6 * sum(size.values())
    again = mixing.mix(sized(documents, rows).repartition(3), (3, 1, 2), 1.5, block_words=100, shard_blocks=7)
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"])
    assert sorted(map(key, again.collect())) == sorted(map(key, mixed))


def test_targets_stop_at_twice_the_source(spark):
    totals = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 10)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(totals, (3, 1, 2), 1.5).collect()}
    assert got["a"] == 20 and got[None] == 20
    assert got["b"] == pytest.approx((1.5 * 2020 - 40) / 3) and got["c"] == pytest.approx(2 * got["b"])


def test_splitting_tree_deals_every_block_once():
    quotas = np.array([1000, 7, 0, 250])
    parts = [mixing.shard_quotas(quotas, 13, s, 5) for s in range(13)]
    at = np.zeros(4, dtype=int)
    for before, here in parts:
        assert (before == at).all() and (here >= 0).all()
        at = at + here
    assert (at == quotas).all()
    assert max(h.sum() for _, h in parts) - min(h.sum() for _, h in parts) <= 1


def test_mix_of_nothing_and_of_documents_without_words(documents):
    assert mixing.mix(sized(documents, []), (3, 1, 2), 1.5).collect() == []
    rows = mixing.mix(sized(documents, [(1, None), (2, ""), (3, " ")]), (3, 1, 2), 1.5).collect()
    assert [(r["taken"], r["target"]) for r in rows] == [(0, 0.0)] * 3


def test_mixed_documents_keep_columns_and_cut_one_per_source(documents):
    rows = [(i, f"w{i} " * 20, "en", f"s{i % 2}") for i in range(30)]
    out = mixing.mixed_documents(documents(rows, "'x' as words"), (3, 1, 2), 1.5).collect()
    assert out[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars", "words"}
    words = sum(len(r["text"].split()) for r in out)
    assert abs(words - 900) <= 2
    cut = Counter(r["source"] for r in out if len(r["text"].split()) < 20)
    assert all(n <= 1 for n in cut.values())


def test_rows_come_from_the_blocks_that_the_tree_drew(documents, monkeypatch):
    rows = sized(documents, [(i, f"w{i} " * 20, "en", f"s{i % 2}") for i in range(60)])
    settings = {"block_words": 100, "shard_blocks": 3}
    whole = mixing.mix(rows, (3, 1, 2), 1.5, **settings).collect()
    dealt = mixing.shard_quotas

    def without_shard_2(quotas, shards, shard, seed):
        before, here = dealt(quotas, shards, shard, seed)
        return before, here * (shard != 2)

    monkeypatch.setattr(mixing, "shard_quotas", without_shard_2)
    less = {r["doc_id"]: r["taken"] for r in mixing.mix(rows, (3, 1, 2), 1.5, **settings).collect()}
    want = {r["doc_id"]: sum(d["words"] for d in r["draws"] if d["shard"] != 2) for r in whole}
    assert less == want and sum(want.values()) < sum(r["taken"] for r in whole)


def test_mixed_documents_lie_by_shard(documents):
    rows = [(i, f"w{i} " * 20, "en", f"s{i % 2}") for i in range(60)]
    settings = {"block_words": 100, "shard_blocks": 3}
    want = defaultdict(list)
    for r in mixing.mix(sized(documents, rows), (3, 1, 2), 1.5, **settings).collect():
        for d in r["draws"]:
            want[d["shard"]].append((d["place"], r["doc_id"]))
    got = mixing.mixed_documents(documents(rows), (3, 1, 2), 1.5, **settings)
    parts = defaultdict(list)
    for r in got.withColumn("at", F.spark_partition_id()).collect():
        parts[r["at"]].append(r["doc_id"])
    assert parts == {s: [d for _, d in sorted(v)] for s, v in want.items()} and len(parts) > 3


def tree(spark, rows):
    return spark.createDataFrame(rows, "tree string, node long, parent long, score double, role string, text string")


def test_best_branch_of_a_reply_tree(spark):
    rows = [
        ("t", 1, None, 1.0, "user", "q"), ("t", 2, 1, 0.1, "assistant", "bad"), ("t", 3, 1, 0.9, "assistant", "good"),
        ("t", 4, 3, 0.5, "user", "more"), ("t", 5, 3, 0.8, "user", "best"), ("u", 7, 99, None, None, None),
        ("l", 1, 3, 1.0, "user", "x"), ("l", 2, 1, 1.0, "user", "y"), ("l", 3, 2, 1.0, "user", "z"),
    ]
    best = {r["tree"]: r["formatted"] for r in reply_trees.conversations(tree(spark, rows)).collect()}
    assert [best["t"].index(w) for w in ("q", "good", "best")] == sorted(best["t"].index(w) for w in ("q", "good", "best"))
    assert "bad" not in best["t"] and "more" not in best["t"]
    assert best["u"] == "<|im_start|>\n<|im_end|>\n"
    assert [best["l"].index(w) for w in "xyz"] == sorted(best["l"].index(w) for w in "xyz")
    everyone = reply_trees.conversations(tree(spark, rows), branches=None)
    assert Counter(r["tree"] for r in everyone.collect()) == {"t": 3, "u": 1, "l": 1}
    assert reply_trees.conversations(tree(spark, [])).collect() == []


def test_long_threads_and_wide_trees(spark):
    rows = [("a", i, i - 1, 0.0, "user", str(i)) for i in range(1, 101)]
    rows += [("b", i, 0, float(i == 57), "assistant", f"r{i}") for i in range(1, 100)] + [("b", 0, None, 0.0, "user", "q")]
    got = {r["tree"]: r for r in reply_trees.conversations(tree(spark, rows)).select("tree", reply_trees.read_back(F.col("formatted")).alias("t")).collect()}
    assert [t["text"] for t in got["a"]["t"]] == [str(i) for i in range(1, 101)]
    assert [t["text"] for t in got["b"]["t"]] == ["q", "r57"]


def test_marks_in_texts_come_back(spark):
    rng = random.Random(8)
    parts = ["<|im_end|>", "<|im_start|>", "<|", "\\", "\\\\", "|", "<", "\n", "é", "assistant", "<\\|", "<\\n>", ""]
    turns = [(c, p, "".join(rng.choices(["user", "assistant", "<|", "\n", "\\"], k=rng.randint(1, 2))), "".join(rng.choices(parts, k=rng.randint(0, 6)))) for c in range(60) for p in range(4)]
    table = spark.createDataFrame(turns, "conv long, position long, role string, text string")
    out = reply_trees.formatted(table, ["conv"]).select(
        "conv", reply_trees.read_back(F.col("formatted")).alias("turns"), reply_trees.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")
    )
    for row in out.collect():
        own = [t for t in turns if t[0] == row["conv"]]
        assert [(t["role"], t["text"]) for t in row["turns"]] == [(t[2], t[3]) for t in own]
        assert row["loss"] == "".join(t[3] for t in own if t[2] == "assistant")


def near(docs, width, similarity, **more):
    rows = near_dedup.near_duplicates(docs, width=width, similarity=similarity, **more).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}, rows


@pytest.mark.parametrize("sketch", [24, 96])
def test_near_duplicates_as_all_pairs(documents, sketch):
    """Chains, a large group around one text, a passage that many others hold, short texts."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(3))
    base, passage = [word() for _ in range(120)], [word() for _ in range(60)]
    texts = [None, "", "One", "one", "a b", "a  B", "a b c d"]
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    chain = list(base)
    for _ in range(12):
        chain[rng.randrange(len(chain))] = word()
        texts.append(" ".join(chain))
    texts += [" ".join(passage + [word() for _ in range(rng.randint(5, 60))]) for _ in range(60)]
    texts += [" ".join(word() for _ in range(rng.randint(1, 200))) for _ in range(30)]
    texts += [texts[10]] * 5
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got, _ = near(documents(rows), 3, "0.85", sketch=sketch)
    assert got == brute.components(rows, 3, 85, 100)
    got, _ = near(documents(rows), 5, "0.8", sketch=sketch)
    assert got == brute.components(rows, 5, 80, 100)


def test_lists_of_unlike_documents_are_worked_off_in_rounds(documents):
    """Texts nearly made of one passage: all in one list, few of them linked."""
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(80):
        own = [f"u{rng.randrange(40)}-{j}" for j in range(9)]
        rows.append((i, " ".join(passage + own)))
    got, _ = near(documents(rows), 3, "0.85", sketch=96)
    assert got == brute.components(rows, 3, 85, 100)


def test_survivors_with_repeated_ids_and_nulls(documents):
    text = "one two three four five six seven"
    rows = [(5, text), (5, text), (None, text), (3, text), (7, None), (7, None), (8, ""), (9, "other words than these here now")]
    docs = documents(rows, "'k' as __size")
    kept = near_dedup.survivors(docs, width=5, similarity="0.8")
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "7", "7", "8", "9"]
    _, rows = near(documents([(None, text), (None, text)]), 3, "0.85")
    assert sum(r["survivor"] for r in rows) == 1 and all(r["kept"] for r in rows)
    assert near(documents([]), 3, "0.85") == ({}, [])


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 30)] + [(200, 199)]
    got = dict(labelled(spark.createDataFrame(links, "a long, b long")).collect())
    assert {got[i] for i in range(100, 141)} == {100} and {got[i] for i in range(1, 30)} == {1} and got[200] == 199


def placed(pieces, capacity):
    """Checks places; number of sequences."""
    of = defaultdict(list)
    for r in pieces:
        of[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in of.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(of)


def test_bin_completion_reaches_the_bound_where_plain_best_fit_does_not():
    counts = np.zeros(101, dtype=np.int64)
    for size in (51, 27, 26, 23, 25, 24, 24):
        counts[size] += 1
    plan = packing.bin_completion(counts, 100)
    assert sum(t for t, _ in plan) == packing.least_sequences(counts, 100) == 2
    rng = np.random.Generator(np.random.PCG64(1))
    for _ in range(20):
        counts = np.bincount(rng.integers(1, 101, 60), minlength=101)
        plan = packing.bin_completion(counts, 100, steps=300)
        used = np.zeros(101, dtype=np.int64)
        for times, filling in plan:
            assert sum(filling) <= 100
            for size in filling:
                used[size] += times
        assert (used == counts).all()
        assert sum(t for t, _ in plan) <= packing.least_sequences(counts, 100) + 2


def test_thousands_of_pieces_in_one_sequence(documents):
    path = by_path.vocabulary("byte_bpe_50k.json")
    rows = packing.pack_documents(documents([(i, None) for i in range(5000)]), path, 2048).collect()
    assert len(rows) == 5000 and placed(rows, 2048) == 3
    counts = np.zeros(2049, dtype=np.int64)
    counts[[1, 2, 700, 1500]] = 3000, 4000, 5, 9
    plan = packing.bin_completion(counts, 2048)
    used = Counter()
    for times, filling in plan:
        assert sum(filling) <= 2048
        for size in filling:
            used[size] += times
    assert used == {1: 3000, 2: 4000, 700: 5, 1500: 9}


def test_packed_documents_round_trip(documents):
    rng = random.Random(3)
    texts = [None, "", "<|endoftext|> a", "x", "x", "long text " * 700] + ["word " * rng.randint(1, 300) for _ in range(80)]
    path = by_path.vocabulary("byte_bpe_50k.json")
    plain = by_path._tokenizer(path)
    rows = packing.pack_documents(documents(list(enumerate(texts)), "1 as piece"), path, 256, with_ids=True).collect()
    pieces = defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids"]))
    for name, text in enumerate(texts):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        parts = sorted(pieces[name])
        assert sum((p[3] for p in parts), []) == ids
        assert [p[0] for p in parts] == list(range(len(parts))) and all(p[2] == 256 for p in parts[1:])
        assert len(parts) == -(-len(ids) // 256)
    total = sum(r["length"] for r in rows)
    assert placed(rows, 256) <= 1.03 * -(-total // 256) + 1
    assert packing.pack_documents(documents([]), path, 256).collect() == []


def test_packing_refuses_pieces_that_do_not_fit(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(300,)], "length long"), 256)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_top_k_as_all_products(spark, documents):
    rng = np.random.Generator(np.random.PCG64(2))
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, 24)], 1) for i in range(400)]
    rows += [(i, rows[10][1], 1) for i in range(400, 420)] + [(50, rows[50][1], 1), (100, rows[3][1], 1)]
    rows += [(450, None, 1), (500, [1.0, None], 1), (550, [float("nan")] * 24, 1), (600, [float("inf")] * 24, 1), (None, [0.0] * 24, 1), (650, [0.5, 0.25], 1), (651, [0.5, 1.0], 1)]
    got = top_k.search(vectors(spark, rows), 5, query_divisor=50, block_rows=64, query_rows=3, step=5)
    want = brute.best_inner_products([r[:2] for r in rows if r[0] is not None], 50, 5)
    assert sorted(map(tuple, got.collect())) == want
    assert top_k.search(vectors(spark, []), 5, query_divisor=50).collect() == []


def test_bounds_drop_candidates_but_no_result():
    rng = np.random.Generator(np.random.PCG64(3))
    columns = np.floor(256 * rng.normal(0, 1, (32, 3000)) * np.linspace(2, 0.01, 32)[:, None]).astype(np.int64)
    query = columns[:, 5]
    tails = top_k.tail_masses(columns, 4)
    at, score = top_k.best_of_block(query, columns, tails, 5, 4, 5)
    whole = query @ columns
    whole[5] = np.iinfo(np.int64).min
    assert sorted(score)[-5:] == sorted(whole)[-5:] and len(at) < 600


def test_pipeline_stage_by_stage(spark, documents):
    import corpus_pipeline as pipeline

    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    texts = [" ".join(word() for _ in range(40)) for _ in range(30)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(texts)]
    rows += [(100, texts[0], None, "s1"), (101, texts[1] + " end", "en", "s1"), (102, "1234 !!", "en", "s1"), (103, None, "en", None)]
    rows += [(104, "token=0123456789abcdef0123456789abcdef " + " ".join(word() for _ in range(30)), "en", None)]
    docs = documents(rows, "'x' as size")
    seen = {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, "unused")
        if name != "packing":
            assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen[name] = docs.collect()
    ids = lambda name: sorted(r["doc_id"] for r in seen[name])
    assert ids("language_id") == sorted([*range(30), 100, 101, 104])
    assert {r["lang"] for r in seen["language_id"]} == {"en"}
    assert ids("near_dedup") == ids("secret_scan") == sorted([*range(30), 104])
    clean = next(r for r in seen["secret_scan"] if r["doc_id"] == 104)
    assert clean["text"].startswith("<secret> ") and clean["n_chars"] == len(clean["text"])
    words = sum(len(r["text"].split()) for r in seen["secret_scan"])
    assert abs(sum(len(r["text"].split()) for r in seen["mixing"]) - 1.5 * words) <= 4
    assert placed(seen["packing"], 2048) == -(-sum(r["length"] for r in seen["packing"]) // 2048)
    empty = documents([])
    for _, stage in pipeline.STAGES:
        out = stage(spark, empty, "unused")
        assert out.collect() == []


def test_pipeline_redacts_secrets_beside_allowed_words(spark, documents):
    import corpus_pipeline as pipeline

    mixed_case, lower, upper = "q7Rk2LmX9vBt4NzC8wYp3HsD6gJf5TaE1uQo0ViK", "k3v9x2m7q4z8w1n6b5t0r3j7", "JBSWY3DPEHPK3PXPMZXW6YTB"
    texts = [
        f"EXAMPLE_KEY={mixed_case} end", f"your-service/prod/{mixed_case}", f"example/{mixed_case}", f"a {lower} b", f"a {upper} b",
        "key EXAMPLEkey0123456789ABCxyz09", "internationalizationandlocalization", "example/placeholder/your-own-text",
    ]
    rows = pipeline.without_secrets(spark, documents(list(enumerate(texts))), "unused").orderBy("doc_id").collect()
    clean = [r["text"] for r in rows]
    assert not any(secret in text for text in clean for secret in (mixed_case, lower, upper))
    assert clean[0] == "EXAMPLE_KEY=<secret> end" and clean[2] == "example/<secret>" and clean[3:5] == ["a <secret> b"] * 2
    assert clean[5:] == texts[5:]


def test_documents_stay_when_no_language_is_known(spark, documents):
    import corpus_pipeline as pipeline

    rows = [(1, "some words", None, "s"), (2, "слова", None, "s"), (3, "12 !", None, "s"), (4, None, None, "s"), (5, "", None, None)]
    kept = pipeline.known_language(spark, documents(rows), "unused").collect()
    assert sorted((r["doc_id"], r["lang"]) for r in kept) == [(1, "und"), (2, "und")]


def test_fractions_of_similarity():
    assert near_dedup.least_overlap(96, 0.85) < 96 * 0.7 and Fraction("0.85") == Fraction(85, 100)


@pytest.mark.parametrize("big", [1.0, 1e7, 1e30, 1e307])
def test_top_k_of_huge_components(spark, big):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * rng.choice([1, 1, big]) for _ in range(20)]) for i in range(60)]
    whole = [[int(top_k.scaled(x, 256)) for x in v] for _, v in rows]
    want = []
    for i in range(0, 60, 10):
        scores = [(sum(a * b for a, b in zip(whole[i], whole[j])), j) for j in range(60) if j != i]
        best = sorted((-max(-(2**63), min(2**63 - 1, s)), j) for s, j in scores)[:5]
        want += [(i, rank, j, -s) for rank, (s, j) in enumerate(best, 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k.search(vectors, 5, query_divisor=10, block_rows=16).collect())) == want


def test_block_permutations_are_one_to_one():
    for size in (1, 2, 7, 1000, 4097):
        assert sorted(mixing.permuted(np.arange(size), size, 99).tolist()) == list(range(size))
    assert mixing.permuted(np.arange(8), 2**29, 1).tolist() != mixing.permuted(np.arange(8), 2**29, 2).tolist()
    assert mixing.block_size(10**6, 4096) == 4096
    assert 4 * 10**13 / mixing.block_size(4 * 10**13, 4096) <= mixing.MOST_BLOCKS < 10**9
