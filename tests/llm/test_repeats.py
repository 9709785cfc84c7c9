import random

import numpy as np
import pytest

from stratalake.llm import cover, fingerprints as fp, suffixes
from stratalake.llm.cover import remove_repeated_words
from stratalake.llm.suffixes import remove_repeated_strings
from tests.llm import brute
from tests.llm.conftest import LONG, ODD


def corpus(seed, n=60):
    """Texts that share passages of all lengths, also with themselves."""
    rng = random.Random(seed)
    vocabulary = ["a", "of", "thé", "inend", "wördle", "xx", "…"]
    some = lambda k: " ".join(rng.choice(vocabulary) + str(rng.randrange(60)) for _ in range(k))
    passages = [some(rng.randrange(8, 90)) for _ in range(12)]
    texts = []
    for _ in range(n):
        parts = [rng.choice(passages)[rng.randrange(6) :] if rng.random() < 0.5 else some(rng.randrange(60)) for _ in range(rng.randrange(6))]
        texts.append(rng.choice([" ", "\n", "  "]).join(parts))
    texts += [texts[3], "ab " * 300, "z" * 999, texts[5][:199], texts[5][:200]]
    return [(i * 7 % 101, t) for i, t in enumerate(texts)]


def words_removed(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()), key=repr)


def strings_removed(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_words_equal_brute_force(spark, documents, seed):
    rows = corpus(seed)
    assert words_removed(remove_repeated_words(documents(rows).repartition(5))) == sorted(brute.without_repeated_words(rows), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_strings_equal_brute_force(spark, documents, seed):
    rows = corpus(seed)
    assert strings_removed(remove_repeated_strings(documents(rows).repartition(5))) == sorted(brute.without_repeated_strings(rows), key=repr)


def test_odd_rows(spark, documents):
    rows = [*ODD, (8, LONG[5_000:5_300]), (9, "x " + LONG[:90_000])]
    assert words_removed(remove_repeated_words(documents(rows))) == sorted(brute.without_repeated_words(rows), key=repr)
    assert strings_removed(remove_repeated_strings(documents(rows))) == sorted(brute.without_repeated_strings(rows), key=repr)


def test_empty_tables(spark, documents):
    assert words_removed(remove_repeated_words(documents([]))) == []
    assert strings_removed(remove_repeated_strings(documents([]))) == []


def test_layout_is_kept(spark, documents):
    passage = " ".join(f"p{i}" for i in range(13))
    rows = [(1, f"start {passage} end"), (2, f"own\n\nwords  {passage}\tand more")]
    found = dict((r.doc_id, r.kept_text) for r in remove_repeated_words(documents(rows), keep_layout=True).collect())
    assert found == {1: rows[0][1], 2: "own\n\nwords  and more"}


def test_any_two_positions_share_an_anchor():
    for a in range(cover.PERIOD):
        for b in range(cover.PERIOD):
            assert any((a + s) % cover.PERIOD in cover.COVER and (b + s) % cover.PERIOD in cover.COVER for s in range(cover.PERIOD))


def test_owners_that_tie_hear_of_a_smaller_id(spark, documents):
    """Rows without an id, and different texts under one id, share passages with a smaller id in another partition."""
    rng = random.Random(8)
    some = lambda n: " ".join(f"v{rng.randrange(10_000)}" for _ in range(n))
    passages = [some(20) for _ in range(3)]
    rows = [(1, f"{some(5)} {passages[0]}"), (4, f"{passages[1]} {some(5)}")]
    rows += [(i, f"{some(8)} {passages[k]} {some(8)}") for i in (None, 9) for k in (0, 1, 2) for _ in range(20)]
    rows += rows[2:6] + [(None, rows[30][1])]
    rng.shuffle(rows)
    expected = sorted(brute.without_repeated_words(rows), key=repr)
    for partitions in (1, 5):
        assert words_removed(remove_repeated_words(documents(rows).repartition(partitions))) == expected


def test_every_owner_of_the_smallest_rank_asks():
    gathered = fp.Gathered()
    for key, rank in ((11, 5), (12, 5), (11, 5), (13, 7), (12, 5)):
        gathered.add(key, rank, np.array([77], np.uint64))
    rows = [r for batch in fp.pack_first(gathered, 3, fp.EXACT) for r in batch.to_pylist()]
    keys = lambda answer: sorted(k for r in rows if r["answer"] == answer for k in np.frombuffer(r["keys"], "<i8").tolist())
    assert keys(False) == [11, 12] and keys(True) == [13]


def test_texts_longer_than_a_piece(monkeypatch):
    rng = random.Random(5)
    text = bytes(rng.choice(b"ab") for _ in range(5_000))
    whole = suffixes._candidates(text, np.unique(suffixes._seeds(text)[0] & np.uint64(2**48 - 1)))
    twice = suffixes._seeds(text + b"|" + text)
    monkeypatch.setattr(suffixes, "PIECE", 700)
    pieces = suffixes._candidates(text, np.unique(suffixes._seeds(text)[0] & np.uint64(2**48 - 1)))
    assert (whole[0] == pieces[0]).all() and (whole[1] == pieces[1]).all() and len(whole[0]) == 5_000 - 199
    again = suffixes._seeds(text + b"|" + text)
    assert (twice[0] == again[0]).all() and (twice[1] == again[1]).all()


def test_level_index_finds_what_occurs_twice():
    rng = np.random.default_rng(4)
    batches = [rng.choice(2_000, size, replace=False).astype(np.uint64) for size in (5, 300, 3, 40, 300, 1, 700, 2)]
    settled = [rng.random(len(b)) < 0.05 for b in batches]
    index = fp.LevelIndex()
    for b, s in zip(batches, settled):
        index.add(b, s)
        sizes = [len(f) for f in index.found]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))
    every = np.concatenate(batches)
    values, counts = np.unique(every, return_counts=True)
    marked = set(every[np.concatenate(settled)].tolist())
    assert index.answers().tolist() == [counts[np.searchsorted(values, v)] > 1 or int(v) in marked for v in every]


def test_windows_are_sent_once_by_each_task():
    """A passage in very many documents of a chunk goes out as one fingerprint."""
    gathered = fp.Gathered()
    for i in range(500):
        gathered.add(i, i, np.array([77, 1000 + i], np.uint64))
    rows = [r for batch in fp.pack_first(gathered, 3, fp.EXACT) for r in batch.to_pylist()]
    sent = np.concatenate([fp.from_bytes(r["hashes"], 8) for r in rows if not r["answer"]])
    assert (sent == 77).sum() == 1 and len(sent) == 501
    told = np.concatenate([fp.from_bytes(r["hashes"], 8) for r in rows if r["answer"]])
    assert (told == 77).sum() == 499


def weak(values):
    """Fingerprints of which the first hash has two bits only."""
    values = np.asarray(values, np.uint64)
    return fp.pair(values & np.uint64(3), values * np.uint64(7919))


def test_fingerprints_that_agree_in_the_first_hash_stay_apart():
    rng = np.random.default_rng(6)
    batches = [rng.choice(300, size, replace=False) for size in (5, 90, 3, 40, 120, 1, 2)]
    every = np.concatenate(batches)
    values, counts = np.unique(every, return_counts=True)
    of = dict(zip(values.tolist(), counts.tolist()))
    weak_values, weak_counts = fp.distinct(weak(every))
    assert sorted(weak_counts.tolist()) == sorted(counts.tolist()) and len(weak_values) == len(values)
    assert fp.contains(weak_values, weak(range(300))).tolist() == [v in of for v in range(300)]
    nobody = [np.zeros(len(b), np.int64) for b in batches]
    assert fp.SHARED([weak(b) for b in batches], nobody).tolist() == [of[v] > 1 for v in every.tolist()]
    ranks = [rng.integers(0, 9, len(b)) for b in batches]
    rank = np.concatenate(ranks)
    least = {v: rank[every == v].min() for v in of}
    assert fp.NOT_FIRST([weak(b) for b in batches], ranks).tolist() == [r > least[v] for v, r in zip(every.tolist(), rank.tolist())]


def test_weak_fingerprints_survive_the_way():
    """What is packed for a part comes back whole, and only equal fingerprints are combined."""
    gathered = fp.Gathered()
    for i in range(40):
        gathered.add(i, i, weak([7, 11, 100 + 4 * i]))  # all agree in the first hash
    rows = [r for batch in fp.pack_first(gathered, 3, fp.EXACT) for r in batch.to_pylist()]
    sent = np.concatenate([fp.from_bytes(r["hashes"], fp.EXACT) for r in rows if not r["answer"]])
    told = np.concatenate([fp.from_bytes(r["hashes"], fp.EXACT) for r in rows if r["answer"]])
    assert len(sent) == 42 and fp.contains(fp.distinct(sent)[0], weak([7, 11, *range(100, 260, 4)])).all()
    assert len(told) == 78 and not fp.contains(fp.distinct(told)[0], weak(range(100, 260, 4))).any()


def test_parts_follow_the_size_of_the_texts(spark, documents, monkeypatch):
    texts = documents([(i, "x" * 1_000) for i in range(50)]).selectExpr("cast(text as binary) text")
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert fp.parts_of(texts) == usual == fp.parts_of(texts.limit(0))
    monkeypatch.setattr(fp, "PART_BYTES", 999)
    assert fp.parts_of(texts) == 51
