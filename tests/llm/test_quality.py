import itertools
import math
import random
import re
import string
from collections import Counter

import numpy as np
import pytest

from stratalake.llm import importance, line_crf
from stratalake.llm.common import SplitTexts, read
from stratalake.llm.importance import PRIOR, Ngrams, kth_largest, resample
from stratalake.llm.line_crf import FEATURES, LineCrf, base_counts, quality_rules, train, train_on_labels
from tests.llm import brute
from tests.llm.conftest import ODD

SF_DIR = "/root/testdata/sf0.01"


def held_out(spark):
    """Documents, half of the labels for training, and the quality of the clean and bad documents of the other half."""
    labels = read(spark, SF_DIR, "labels")
    truth = {r.doc_id: r.quality for r in labels.where("doc_id % 2 = 1 and toxic = 0").collect()}
    return read(spark, SF_DIR, "documents"), labels.where("doc_id % 2 = 0"), truth


# --- line labels ---


def test_viterbi_equals_trying_all_labellings():
    rng = np.random.default_rng(1)
    for n in range(1, 8):
        model = LineCrf(rng.normal(size=(len(FEATURES), 2)), rng.normal(size=(2, 2)))
        features = rng.integers(0, 2, (n, len(FEATURES))).astype(float)
        scores = features @ model.state

        def total(labels):
            return sum(scores[i, y] for i, y in enumerate(labels)) + sum(model.step[a, b] for a, b in zip(labels, labels[1:]))

        best = max(itertools.product((0, 1), repeat=n), key=total)
        assert model.decode(features).tolist() == [bool(y) for y in best]
    assert model.decode(np.zeros((0, len(FEATURES)))).tolist() == []


def test_marginals_equal_trying_all_labellings():
    rng = np.random.default_rng(2)
    scores, step = rng.normal(size=(1, 4, 2)), rng.normal(size=(2, 2))
    here = np.array([[True, True, True, False]])
    node, edge = line_crf._marginals(scores, step, np.array([3]), here, here[:, 1:])
    weights = {
        y: np.exp(sum(scores[0, i, k] for i, k in enumerate(y)) + sum(step[a, b] for a, b in zip(y, y[1:])))
        for y in itertools.product((0, 1), repeat=3)
    }
    z = sum(weights.values())
    for i, k in itertools.product(range(3), (0, 1)):
        assert node[0, i, k] == pytest.approx(sum(w for y, w in weights.items() if y[i] == k) / z)
    assert not node[0, 3].any()
    for a, b in itertools.product((0, 1), repeat=2):
        assert edge[a, b] == pytest.approx(sum(w * sum(p == (a, b) for p in zip(y, y[1:])) for y, w in weights.items()) / z)


def test_chain_learns_that_neighbours_agree():
    """A feature that tells the label only now and then, and labels that seldom change."""
    rng = np.random.default_rng(3)
    sequences = []
    for _ in range(200):
        labels = np.repeat(rng.integers(0, 2, 4), 5)
        features = np.zeros((20, len(FEATURES)))
        features[:, 0] = 1
        features[:, 3] = (rng.random(20) < np.where(labels == 1, 0.75, 0.25)).astype(float)
        sequences.append((features, labels))
    model = train(sequences[:150])
    right = np.mean([(model.decode(f) == (y == 1)).mean() for f, y in sequences[150:]])
    alone = np.mean([((f[:, 3] == 1) == (y == 1)).mean() for f, y in sequences[150:]])
    assert model.step[0, 0] > model.step[0, 1] and right > alone + 0.03


@pytest.mark.parametrize("seed", range(3))
def test_base_counts_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b c", "é#", "$$", " ", "\n", "\t", "\n\n", "a b c", "\r", " ", "|"]) for _ in range(rng.randrange(40)))
        assert base_counts(text.encode()) == brute.base_counts(text)


def test_line_labels_on_held_out_documents(spark):
    docs, labels, truth = held_out(spark)
    found = {r.doc_id: r for r in quality_rules(docs, train_on_labels(docs, labels)).collect()}
    judged = [(r.kept, truth[i]) for i, r in found.items() if i in truth and not r.base_failed]
    assert len(judged) > 100
    assert np.mean([kept for kept, quality in judged if quality == 1]) > 0.98
    assert np.mean([kept for kept, quality in judged if quality == 0]) < 0.1


def test_odd_documents(spark, documents):
    model = LineCrf(np.zeros((len(FEATURES), 2)), np.zeros((2, 2)))
    found = quality_rules(documents(ODD), model).collect()
    assert sorted(repr((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in found) == sorted(
        repr((i, *brute.base_counts(t or ""))) for i, t in ODD
    )
    assert [r.doc_id for r in found if r.kept] == [5] and not any(r.kept and r.base_failed for r in found)
    assert quality_rules(documents([]), model).collect() == []


def test_without_labels_every_line_is_content(spark, documents):
    docs = documents([(1, "many different words here " + " ".join(f"w{i}" for i in range(60)))])
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    (row,) = quality_rules(docs, train_on_labels(docs, labels)).collect()
    assert row.kept and row.content_share == 1


def hashed(*documents):
    return [np.array([hash(line) % 10**9 + 1 if line else 0 for line in lines], np.uint64) for lines in documents]


def test_lines_that_are_not_a_documents_own_are_boilerplate():
    own = [[f"line {i} of {d}" for i in range(4)] for d in range(8)]
    menu = [[*lines[:2], "menu", *lines[2:]] for lines in own[:3]]
    copies = [own[3] + [f"end {i}"] for i in range(5)]
    repeats = [*own[4], "again", "", "", "again"]
    found = line_crf.line_labels(hashed(*menu, *copies, repeats, own[5], [], ["alone"]), [True] * 9 + [False, True, True])
    assert [x.tolist() for x in found[:3]] == [[0, 0, 1, 0, 0]] * 3
    # A text that many documents hold is still their own.
    assert [x.tolist() for x in found[3:8]] == [[0] * 5] * 5
    assert found[8].tolist() == [0, 0, 0, 0, 1, 0, 0, 1]
    assert [x.tolist() for x in found[9:]] == [[1] * 4, [], [0]]


def test_planted_boilerplate_lines_are_found(spark, documents):
    """Menus and notices stand in good documents, which are kept for the rest of their lines."""
    rng = random.Random(7)
    prose = lambda: " ".join(f"word{rng.randrange(400)}" for _ in range(rng.randrange(14, 25))).capitalize() + "."
    menus = [f"Home | {x} | Login" for x in ("News", "Shop", "Help")] + ["* Share * Print * Save", "<< back | next >>"]

    def page(d):
        lines = [prose() for _ in range(8)]
        at = rng.randrange(2, 6)
        lines[at:at] = rng.sample(menus, 2)
        return lines

    pages = {d: page(d) for d in range(80)}
    rows = [(d, "\n".join(lines)) for d, lines in pages.items()]
    rows += [(1000 + d, "\n".join("$$ WIN *** NOW " * 4 for _ in range(9))) for d in range(30)]
    labels = spark.createDataFrame([(d, 1) for d in range(40)] + [(1000 + d, 0) for d in range(15)], "doc_id long, quality int")
    docs = documents(rows)
    model = train_on_labels(docs, labels)
    found = {r.doc_id: r for r in quality_rules(docs, model).collect()}
    for d in range(40, 80):
        lines = pages[d]
        marked = model.decode(line_crf.line_features([line.encode() for line in lines])).tolist()
        assert marked == [line in menus for line in lines]
        words = sum(len(line.split()) for line in lines if line not in menus)
        assert found[d].kept and found[d].content_share == pytest.approx(words / found[d].n_words)
        assert 0 < found[d].content_share < 1
    assert not any(found[1000 + d].kept for d in range(30))


def test_documents_of_the_corpus_have_both_labels(spark):
    docs, labels, truth = held_out(spark)
    shares = [r.content_share for r in quality_rules(docs, train_on_labels(docs, labels)).collect()]
    assert sum(0 < s < 1 for s in shares) > 0.2 * len(shares)


# --- importance resampling ---


def test_resampling_on_held_out_documents(spark):
    docs, labels, truth = held_out(spark)
    found = resample(docs, labels).collect()
    judged = [(r.kept, truth[r.doc_id]) for r in found if r.doc_id in truth]
    assert np.mean([kept for kept, quality in judged if quality == 1]) > 0.97
    assert np.mean([kept for kept, quality in judged if quality == 0]) < 0.1


def test_held_out_toxic_documents_are_rejected(spark):
    """Also those of good quality, of which only a few words are toxic."""
    labels = read(spark, "/root/testdata/sf0.1", "labels")
    truth = {r.doc_id: (r.quality, r.toxic) for r in labels.where("doc_id % 2 = 1").collect()}
    found = resample(read(spark, "/root/testdata/sf0.1", "documents"), labels.where("doc_id % 2 = 0")).collect()
    kept = {kind: np.mean([r.kept for r in found if truth.get(r.doc_id) == kind]) for kind in ((1, 0), (1, 1))}
    print(kept)
    assert kept[1, 0] > 0.97 and kept[1, 1] < 0.06


def test_a_long_text_does_not_hide_toxic_words(spark, documents):
    rng = random.Random(4)
    some = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    bad = lambda n: f"{some(n)} You vile, {some(9)} nasty. {some(n)}"
    rows = [(i, some(rng.randrange(20, 400))) for i in range(100)] + [(100 + i, bad(20)) for i in range(20)]
    rows += [(200, bad(2_000)), (201, some(4_000)), (202, bad(5)), (203, some(10))]
    labels = spark.createDataFrame([(i, 1, int(i >= 100)) for i in range(120)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in resample(documents(rows), labels).collect() if r.kept}
    assert not kept & {200, 202, *range(100, 120)} and {201, 203} <= kept
    most = resample(documents(rows), labels, k=len(rows)).collect()
    assert not any(r.kept for r in most if r.doc_id in (200, 202))


def test_the_k_largest_keys_stay(spark):
    docs, labels, _ = held_out(spark)
    found = resample(docs, labels, k=137).collect()
    kept = {r.doc_id for r in found if r.kept}
    assert kept == {r.doc_id for r in sorted(found, key=lambda r: -r.key)[:137]}
    again = resample(docs.repartition(5), labels, k=137)
    assert {r.doc_id for r in again.where("kept").collect()} == kept


def test_weights_follow_the_counts(spark, documents):
    """A word that only good documents have speaks for a document, one that they lack against it."""
    docs = documents([(i, "good common " * 20) for i in range(30)] + [(100 + i, "bad common " * 20) for i in range(30)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(15)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in resample(docs, labels).collect()}
    good = [found[i].log_weight for i in range(30)]
    assert min(good) > max(found[100 + i].log_weight for i in range(30))
    assert max(good) - min(good) < 0.1 * abs(good[0])  # labelled or not
    assert {i for i, r in found.items() if r.kept} >= set(range(29))


def shape(word):
    kinds = "".join("A" if c.isascii() and c.isupper() else "a" if not c.isascii() or c.islower() else "0" if c.isdigit() else c for c in word)
    return re.sub(r"(.)\1+", r"\1", kinds)


def test_words_shapes_and_plain_words_are_told_apart_as_by_hand():
    rng = random.Random(8)
    parts = ["a", "B", "é", "7", "00", ".", "--", "(", "xyz", "longer-word", "😀", "'s", "ABC", "q" * 300]
    texts = [" ".join("".join(rng.choices(parts, k=rng.randrange(1, 5))) for _ in range(rng.randrange(0, 40))) for _ in range(60)]
    split = SplitTexts([t.encode() for t in texts])
    words = [w for t in texts for w in t.split()]
    assert np.diff(split.bounds).tolist() == [len(t.split()) for t in texts]
    plain = [w.strip(string.punctuation).lower() if w.strip(string.punctuation) else w for w in words]
    # Only A-Z change their case; a character of several bytes has a shape of one or more letters, as before.
    for hashes, said in ((split.hashes(), words), (importance._plain_hashes(split), plain), (importance._shape_hashes(split), map(shape, words))):
        pairs = set(zip(hashes.tolist(), said, strict=True))
        assert len(pairs) == len({h for h, _ in pairs}) == len({w for _, w in pairs})


def test_weights_and_draw_equal_a_plain_version(spark, documents):
    rng = random.Random(5)
    word = lambda: rng.choice(("Good", "bad,", "vile", "w1", "w2", "w22", "(x)", "ok"))
    rows = [(i, " ".join(word() for _ in range(rng.randrange(0, 30)))) for i in range(120)]
    known = {i: (int(i % 3 > 0), int(i % 7 == 0)) for i in range(60)}
    labels = spark.createDataFrame([(i, *q) for i, q in known.items()], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in resample(documents(rows).repartition(3), labels, k=40).collect()}

    grams = {i: Counter(Ngrams([t.encode()]).buckets()[0].tolist()) for i, t in rows}
    told = {i: set(Ngrams([t.encode()]).distinct_words()[0].tolist()) for i, t in rows}
    target = [i for i, q in known.items() if q == (1, 0)]
    toxic, clean = [i for i, q in known.items() if q[1]], [i for i, q in known.items() if not q[1]]
    raw, of_target = sum(grams.values(), Counter()), sum((grams[i] for i in target), Counter())
    for i, own in grams.items():
        mine = own if i in target else Counter()
        share = max(of_target.total() - mine.total(), 0) / max(raw.total() - own.total(), 1)
        weight = sum(
            n * math.log((of_target[g] - mine[g] + PRIOR) / ((raw[g] - n) * share + PRIOR)) for g, n in own.items()
        )
        assert found[i].n_ngrams == own.total() and found[i].log_weight == pytest.approx(weight, abs=1e-9)
        bad, good = [j for j in toxic if j != i], [j for j in clean if j != i]
        ratios = sorted(
            math.log((sum(w in told[j] for j in bad) + 1) / (sum(w in told[j] for j in good) * len(bad) / len(good) + 1)) for w in told[i]
        )
        assert found[i].toxic_ratio == pytest.approx(sum(ratios[-3:]), abs=1e-9)
    cut = sorted(found[i].toxic_ratio for i in target)[-1 - int(len(target) * importance.CLEAN_LOST)]
    left = sorted((r for r in found.values() if r.toxic_ratio <= cut), key=lambda r: -r.key)
    assert {i for i, r in found.items() if r.kept} == {r.doc_id for r in left[:40]}
    assert all(r.key == float("-inf") for r in found.values() if r.toxic_ratio > cut)


def test_odd_documents_are_weighed(spark, documents):
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, None), (7, 0, 0), (None, 1, 0), (5, 1, 1)], "doc_id long, quality int, toxic int")
    found = resample(documents(ODD), labels, k=3).collect()
    assert len(found) == len(ODD)
    assert all(r.log_weight == 0 and r.n_ngrams <= 1 for r in found if r.doc_id in (1, 2, 3))
    same = [r.key for r in found if r.doc_id == 7]
    assert same[0] == same[1]
    assert resample(documents([]), labels).collect() == []
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.kept and r.log_weight == 0 for r in resample(documents(ODD), none).collect())


@pytest.mark.parametrize("values", [[1.0], [2.0] * 9, [float(i * i % 101) for i in range(300)], [1e-300 * i for i in range(50)] + [1e300]])
def test_kth_largest(spark, values, monkeypatch):
    monkeypatch.setattr(importance, "SEARCH_BINS", 4)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ordered = sorted(values, reverse=True)
    for k in {1, 2, len(values) // 2 + 1, len(values)} & set(range(1, len(values) + 1)):
        assert kth_largest(df, "v", k) == ordered[k - 1]
