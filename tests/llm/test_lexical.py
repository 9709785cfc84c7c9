"""Ranked search against scoring every document."""

import math
import random
import re

import numpy as np
import pytest

from stratalake.llm.lexical import Best, ImpactList, best_positions, lexical_search, split_terms
from tests.llm.conftest import LONG, ODD

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(_LOWER))


def by_hand(docs, items, k=10):
    """``{(item, rank): (doc_id, score)}`` of rows (id, text)."""
    split = [(i, terms(t)) for i, t in docs]
    split = [(i, t) for i, t in split if t]
    total, words = len(split), sum(len(t) for _, t in split)
    df = {}
    for _, t in split:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc_id, t in split:
            m = 10 + (90 * len(t) * total) // words
            score = 0
            for term in wanted & set(t):
                tf = t.count(term)
                score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[term] + 1))) * (
                    (10**9 * tf) // (1000 * tf + 8 * m)
                )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item, r, None if n else d, -s) for r, (s, n, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_terms_of_bytes_are_terms_of_text():
    for text in ("Don't  x_y-Z9", "ÄRGER Straße½€ 😀a1", "\x00\x7fa\x85b\xa0c", "", "__"):
        assert [t.decode() for t in split_terms(text.encode())] == terms(text)


def corpus(seed, n):
    pick = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(pick.choices(vocabulary, weights, k=pick.randrange(0, 60)))) for i in range(n)]
    return docs + [(i + 50_000, docs[i % 40][1]) for i in range(200)]


def test_equals_scoring_all(spark, documents):
    docs = corpus(3, 1500)
    pick = random.Random(4)
    items = [(i, " ".join(pick.choices([f"v{j}" for j in range(300)], k=12))) for i in range(25)] + [(99, docs[7][1])]
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, term string")
    assert found(lexical_search(documents(docs).repartition(9), table)) == by_hand(docs, items)


def test_odd_rows_and_ties(spark, documents):
    docs = ODD + [(i, "Same words here") for i in range(100, 130)] + [(None, "same words here")] * 3 + [(100, "SAME Words, here!")]
    items = [
        (1, "same words"),
        (1, "of one item; SAME"),
        (2, None),
        (3, "..."),
        (4, "word3 part5 word3"),
        (5, "nowhere"),
        (None, "copy of a row"),
        (6, "ärger Ärger"),
        (7, LONG),
    ]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert found(lexical_search(documents(docs), table, k=40)) == by_hand(docs, items, 40)


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert found(lexical_search(documents([]), items)) == []
    assert found(lexical_search(documents([(1, "a b")]), items.limit(0))) == []


def test_text_item_ids_and_several_passes(spark, documents, monkeypatch):
    monkeypatch.setattr("stratalake.llm.lexical.PASS_TERMS", 20)
    docs = corpus(5, 300)
    items = [(f"item {i}", docs[i][1]) for i in range(12)]
    table = spark.createDataFrame(items, "name string, said string")
    result = lexical_search(documents(docs), table, item_column="name", item_text_column="said")
    assert found(result) == by_hand(docs, items)


def shard_lists(rng, n, sizes):
    lists = []
    for size in sizes:
        docs = np.sort(rng.choice(n, size, replace=False))
        lists.append(ImpactList.of(docs, (rng.pareto(2, size) * 1000).astype(np.int64) + 1))
    return lists


@pytest.mark.parametrize("seed", range(20))
def test_best_positions_of_a_shard(seed):
    rng = np.random.default_rng(seed)
    n = 3000
    lists = shard_lists(rng, n, rng.integers(1, 2000, rng.integers(1, 8)))
    total = np.zeros(n, np.int64)
    for x in lists:
        total[x.documents] += x.impact
    best = Best(10)
    best_positions(lists, list(range(n)), best)
    wanted = sorted((-int(s), i) for i, s in enumerate(total) if s > 0)[:10]
    assert [(d, s) for d, s in best.documents()] == [(i, -s) for s, i in wanted]


def test_stops_early_and_only_strictly_below_the_last():
    n = 20_000
    falling = np.arange(n, 0, -1, dtype=np.int64) * 100
    lists = [ImpactList.of(np.arange(n), falling), ImpactList.of(np.arange(n), falling)]
    best = Best(10)
    assert best_positions(lists, list(range(n)), best) < n / 100
    assert [d for d, _ in best.documents()] == list(range(10))

    # All equal: the smallest ids win, though the list's order by impact says nothing about them.
    ids = list(range(n, 0, -1))
    flat = [ImpactList.of(np.arange(n), np.full(n, 7, np.int64))]
    best = Best(10)
    assert best_positions(flat, ids, best) == n
    assert [d for d, _ in best.documents()] == list(range(1, 11))

    # The best of an earlier shard end the search of a later one sooner.
    alone, carried = Best(10), Best(10)
    carried.add(list(range(-10, 0)), np.full(10, 10**9))
    later = shard_lists(np.random.default_rng(1), n, [15_000, 12_000, 9_000])
    assert best_positions(later, list(range(n)), carried) < best_positions(later, list(range(n)), alone)
