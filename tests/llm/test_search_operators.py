"""Lexical search, spelling variants, URL filter."""

import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from creatorlens.llm import host_reputation, lexical, queries, spelling
from creatorlens.llm.host_reputation import Rule

ITEMS, WORDS, PAGES = "item_id long, text string", "word string, n long", "page_id long, url string, document long"


# ---- lexical search


def test_search_equals_scores_one_by_one(spark, documents):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["É", "naïve", "日本", "X9"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(120)] + [None, "", "-- !!", "w1_w2;W3"]
    texts += [texts[5]] * 9
    rows = list(enumerate(texts))
    asked = [" ".join(rng.sample(words, rng.randint(1, 25))) for _ in range(25)] + [None, "", "absent", "w1 w1 W1"]
    items = spark.createDataFrame(list(enumerate(asked)), ITEMS)
    for k, pass_terms in ((5, 2**20), (200, 40)):
        got = sorted(map(tuple, lexical.search(documents(rows), items, k, pass_terms=pass_terms).collect()))
        assert got == brute.lexical_search(rows, enumerate(asked), k)


def test_search_of_odd_rows(spark, documents):
    asked = spark.createDataFrame([(1, "same"), (None, "same"), (1, "same"), (2, None)], ITEMS)
    docs = documents([(None, "same"), (4, "same"), (4, "same"), (3, "other same"), (5, "x" * 3_000_000), (6, "é " * 400_000)], "'x' as score")
    got = [tuple(r) for r in lexical.search(docs, asked, 3).collect()]
    best = lexical.search(docs, asked.limit(1), 10).orderBy("rank").collect()
    assert [r["doc_id"] for r in best] == [3, 4, 4, None]
    assert Counter((i, rank) for i, rank, _, _ in got) == Counter({(1, 1): 2, (1, 2): 2, (1, 3): 2, (None, 1): 1, (None, 2): 1, (None, 3): 1})
    empty = documents([(1, "a")]).limit(0)
    assert lexical.search(empty, asked, 3).count() == 0
    assert lexical.search(docs, asked.limit(0), 3).count() == 0


def test_terms_of_long_texts_come_in_pieces_that_lose_nothing(monkeypatch):
    monkeypatch.setattr(lexical, "SPLIT_BYTES", 7)
    text = "ab cd, efghijklmnop  É ab" * 9
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    want = Counter(t.encode() for t in pattern.findall(text.translate(brute.LOWER)))
    assert lexical.counted_terms(text.encode()) == want


def test_shared_sets_add_up_to_the_items_with_fewer_additions():
    rng = random.Random(1)
    base = [rng.sample(range(60), 8) for _ in range(6)]
    items = [sorted({*rng.choice(base), *rng.choice(base), rng.randrange(60)}) for _ in range(50)]
    graph = lexical.shared_sets(items, 60)
    values = np.zeros((int(graph.items[-1]) + 1, 3), np.int64)
    values[:60] = np.arange(180).reshape(60, 3) ** 2
    filled = 60
    for parts, starts in graph.levels:
        assert parts.max() < filled  # only of what is there already
        values[filled : filled + len(starts)] = np.add.reduceat(values[parts], starts, axis=0)
        filled += len(starts)
    assert [values[n].tolist() for n in graph.items] == [values[i].sum(axis=0).tolist() for i in items]
    assert graph.additions < sum(len(i) - 1 for i in items) / 2
    assert lexical.blocks(items, 500)[0].start == 0 and sum(map(len, lexical.blocks(items, 500))) == 50


# ---- spelling variants


def words_for_test():
    rng = random.Random(8)
    found = set()
    for _ in range(60):
        word = "".join(rng.choice("abéht") for _ in range(rng.randint(6, 9)))
        found.add(word)
        for _ in range(6):
            at, kind = rng.randrange(len(word)), rng.randrange(3)
            word = word[:at] + ("" if kind == 0 else rng.choice("abéht")) + word[at + (kind < 2) :]
            found.add(word)
    return [(w, rng.choice([1, 2, 5, 5, 10, 25, 30, 700])) for w in sorted(found) if len(w) > 1]


@pytest.mark.parametrize("crowd", [1, 256])
def test_variants_equal_all_pairs_compared(spark, crowd):
    rows = words_for_test()
    got = spelling.variants(spark.createDataFrame(rows, WORDS), crowd=crowd).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.variants(rows), key=str)


def test_words_alone_long_words_and_no_words(spark):
    assert spelling.variants(spark.createDataFrame([], WORDS)).count() == 0
    rows = [("x" * 50_000, 5), ("x" * 50_001, 25), ("lonely", 9)]
    got = {r["word"]: (r["root"], r["n_near"]) for r in spelling.variants(spark.createDataFrame(rows, WORDS)).collect()}
    assert got == {"x" * 50_000: ("x" * 50_001, 1), "x" * 50_001: ("x" * 50_001, 1), "lonely": ("lonely", 0)}


def test_registered_words_equal_plain_python(spark, given):
    counted = Counter()
    for row in given.select("doc_id", "text").collect():
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", (row["text"] or "").translate(brute.LOWER)):
            h = zlib.crc32(f"{row['doc_id']}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counted[run] += len(run) >= 6
    got = queries.op12_spelling_variants(spark, "/root/testdata/sf0.001").select("word", "n").collect()
    assert dict(map(tuple, got)) == {w: n for w, n in counted.items() if n >= 5}


# ---- URL filter

RULES = [Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "a.b.org", "/x"), Rule("allow", "b.org", "/xyz"), Rule("allow", "b.org", "/x/22")]


def verdicts(spark, pages, outcomes, rules=RULES):
    table = spark.createDataFrame(pages, PAGES).withColumns({"host": F.lit(7), "verdict": F.lit(None), "bad": F.lit("x")})
    found = host_reputation.judged(table, spark.createDataFrame(outcomes, "document long, bad boolean"), rules)
    return {r["page_id"]: r for r in found.collect()}


def test_longest_rule_that_fits(spark):
    urls = [
        "http://Q.EXAMPLE.net/en/1", "https://example.net/EN/", "http://net/", "http://net", "http://internet/", "x.net/en/", None, "",
        "ftp://a.b.org/xyz?x", "ftp://c.b.org/xyz#/x", "s://a.b.org/x/22://c", "http://z.a.b.org?/x", "http://É.net/?a", "a://b://net/",
        "http://" + "a." * 2000 + "net/" + "p" * 9000,
    ]
    got = verdicts(spark, [(i, u, None) for i, u in enumerate(urls)], [])
    assert [got[i]["rule"] for i in range(len(urls))] == [
        "example.net/en/", "net/", "net/", None, None, None, None, None,
        "a.b.org/x", "b.org/xyz", "b.org/x/22", None, "net/", None, "net/",
    ]
    assert [got[i]["verdict"] for i in (0, 1, 3, 6, 8, 9)] == ["allow", "block", "allow", "allow", "block", "allow"]
    assert (got[0]["host"], got[0]["path"]) == ("q.example.net", "/en/1")
    assert [(got[i]["host"], got[i]["path"]) for i in (5, 6, 11, 13)] == [("", ""), ("", ""), ("z.a.b.org", ""), ("b:", "//net/")]


def test_hosts_go_only_on_evidence_and_borrow_from_their_domain(spark):
    pages, outcomes = [], []

    def add(host, bad, good):
        for verdict in [True] * bad + [False] * good:
            pages.append((len(pages), f"http://{host}/p", len(pages)))
            outcomes.append((len(outcomes), verdict))

    add("spam.evil.com", 40, 2)
    add("more.evil.com", 30, 1)
    add("one.evil.com", 1, 0)
    add("fresh.evil.com", 0, 0)
    for nth in range(12):
        add(f"h{nth}.fine.org", 1, 30)
    add("lone.fine.org", 1, 0)
    add("odd.fine.org", 25, 0)
    extra = [(9000, "http://fresh.evil.com/", None), (9001, "http://spam.evil.com/", 0), (9002, "http://new.fine.org", 99_999)]
    got = verdicts(spark, pages + extra, outcomes + [(0, True), (0, None), (None, True)], [])
    by_host = {r["host"]: (r["verdict"], r["pages"], r["bad"]) for r in got.values()}
    assert by_host["spam.evil.com"] == ("block", 42, 40) and by_host["odd.fine.org"][0] == "block"
    assert by_host["lone.fine.org"] == ("allow", 1, 1) and by_host["new.fine.org"] == ("allow", 0, 0)
    assert all(by_host[f"h{nth}.fine.org"][0] == "allow" for nth in range(12))
    found = host_reputation.reputations(spark.createDataFrame([(h, n, b) for h, (_, n, b) in by_host.items()], "host string, pages long, bad long"))
    rates = {r["host"]: (r["rate"], r["bound"]) for r in found.collect()}
    assert rates == {h: pytest.approx(v) for h, v in brute.reputations({h: (n, b) for h, (_, n, b) in by_host.items()}).items()}
    assert rates["fresh.evil.com"][0] > 0.4 > 0.2 > rates["new.fine.org"][0] and rates["lone.fine.org"][0] > rates["new.fine.org"][0]


def test_no_pages_and_no_outcomes(spark):
    assert verdicts(spark, [], [(1, True)]) == {}
    assert {r["verdict"] for r in verdicts(spark, [(1, "http://x.org/", 3), (1, "http://x.org/", 3)], []).values()} == {"allow"}
