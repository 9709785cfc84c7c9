import random

import pytest

from stratalake.llm import minhash
from stratalake.llm.components import connected_components
from stratalake.llm.minhash import near_duplicates
from tests.llm import brute
from tests.llm.conftest import ODD


def labelled(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=repr)


def expected(texts, n):
    component = brute.near(texts, n)
    return sorted(((i, len(brute.shingles(t, n)), component[i], component[i] == i) for i, t in texts.items()), key=repr)


def group(rng, size, words, edits):
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10_000)}"
        yield " ".join(copy)


@pytest.mark.parametrize("n", [2, 5])
def test_equals_brute_force(spark, documents, n):
    rng = random.Random(n)
    texts = []
    for _ in range(12):
        texts += group(rng, rng.randrange(2, 8), rng.randrange(20, 120), 6)
    texts += [f"{rng.random()} alone" for _ in range(20)] + texts[:9]
    rng.shuffle(texts)
    by_id = {i * 3: t for i, t in enumerate(texts)}
    assert labelled(near_duplicates(documents(by_id.items()), n)) == expected(by_id, n)


@pytest.mark.parametrize("block", [7, 512])
def test_large_group_whose_members_resemble_a_middle_one_only(spark, documents, monkeypatch, block):
    """Members differ from each other by more than they may, so a pivot that is not the middle one links nobody."""
    rng = random.Random(7)
    texts = list(group(rng, 60, 60, 7))
    by_id = dict(enumerate(texts))
    monkeypatch.setattr(minhash, "BLOCK", block)
    assert labelled(near_duplicates(documents(by_id.items()), 2)) == expected(by_id, 2)


def test_odd_rows(spark, documents):
    found = labelled(near_duplicates(documents(ODD), 2))
    assert found.count((7, 3, 7, True)) == 2
    assert (1, 0, 1, True) in found and (2, 0, 2, True) in found and (3, 0, 3, True) in found
    assert (None, 2, None, True) in found and (None, 0, None, True) in found
    assert len(found) == len(ODD)


def test_a_row_without_id_joins_a_group(spark, documents):
    found = labelled(near_duplicates(documents([(None, "a b c"), (4, "A b c"), (9, "a B c")]), 2))
    assert found == [(4, 2, 4, True), (9, 2, 4, False), (None, 2, 4, False)]


def test_same_id_with_different_texts(spark, documents):
    found = labelled(near_duplicates(documents([(1, "a b c"), (1, "d e f"), (2, "d e f")]), 2))
    assert found == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]


def test_empty_table(spark, documents):
    assert labelled(near_duplicates(documents([]), 2)) == []


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += [(1000 + i, 1001 + i) for i in range(40)]  # a path
    links += [(2000, 2001 + i) for i in range(200)] + [(5, 5), (None, 3)]  # a star, a loop, a null
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    real = [(a, b) for a, b in links if a is not None and a != b]
    nodes = {x for link in real for x in link}
    assert {(r.node, r.root) for r in found} == set(brute.components(nodes, real).items())
    assert len(found) == len(nodes)


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
