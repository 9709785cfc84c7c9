import random
from collections import Counter

import numpy as np

import corpus_pipeline
from corpus_pipeline import STAGES, encode, mix, near_dedup, quality, substring_dedup
from stratalake.llm.common import read
from stratalake.llm.queries import tokenizer_path
from tests.llm import brute
from tests.llm.conftest import ODD

SF_DIR = "/root/testdata/sf0.001"


def sentence(rng, n):
    return " ".join(f"word{rng.randrange(3_000)}" for _ in range(n))


def small(rng):
    texts = [sentence(rng, rng.randrange(30, 90)) for _ in range(30)]
    texts += [t + " ending" for t in texts[:8]] + texts[5:10]
    passage = sentence(rng, 40)
    texts += [f"{sentence(rng, 30)}\n{passage}\n{sentence(rng, 20)}" for _ in range(6)]
    return [(i, t, f"s{i % 3}") for i, t in enumerate(texts)]


def test_stages_and_registration(spark):
    assert [n for n, _ in STAGES] == ["quality", "near_dedup", "substring_dedup", "mix", "encode"]
    from __spark_entry__ import queries

    assert queries()["pipeline"].__wrapped__ is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None


def test_quality_takes_effect(spark):
    docs = read(spark, SF_DIR, "documents")
    kept = {r.doc_id for r in quality(spark, docs, SF_DIR).collect()}
    clean = {r.doc_id for r in read(spark, SF_DIR, "labels").where("quality = 1 and toxic = 0").collect()}
    bad = {r.doc_id for r in read(spark, SF_DIR, "labels").where("quality = 0").collect()}
    assert len(kept & clean) >= 0.95 * len(clean) and len(kept & bad) <= 0.2 * len(bad)


def test_dedup_stages_equal_brute_force(spark, documents):
    rows = small(random.Random(1))
    docs = documents(rows)
    stays = near_dedup(spark, docs, SF_DIR)
    assert stays.columns == docs.columns
    component = brute.near({i: t for i, t, _ in rows}, 5)
    left = [(i, t) for i, t, _ in rows if component[i] == i]
    assert sorted((r.doc_id, r.text) for r in stays.collect()) == left

    cut = substring_dedup(spark, stays, SF_DIR)
    assert cut.columns == docs.columns
    wanted = brute.without_repeated_words(left)
    found = {r.doc_id: r.text for r in cut.collect()}
    assert {i: " ".join(t.split()) for i, t in found.items()} == {i: kept for i, _, _, kept in wanted}
    assert all(found[i] == dict(left)[i] for i, _, gone, _ in wanted if not gone)
    assert sum(gone for _, _, gone, _ in wanted) >= 5 * 40


def test_near_dedup_keeps_one_document_of_each_component(spark, documents):
    """Whatever ids its rows have: the smallest id, without one the last, then the smallest hash of the text."""
    rng = random.Random(6)
    texts = [sentence(rng, 60) for _ in range(6)]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[2]), (2, texts[1] + " ending"), (1, texts[0] + " ending")]
    rows += [(None, texts[3]), (None, texts[3] + " ending"), (None, texts[3]), (None, texts[4]), (None, texts[2] + " ending")]
    rows += [(5, texts[5]), (None, texts[5] + " ending"), (7, None), (7, ""), (7, " "), (None, "")]
    stays = [(r.doc_id, r.text) for r in near_dedup(spark, documents(rows), SF_DIR).collect()]
    with_words = [(i, t) for i, t in stays if t and t.strip()]
    found = Counter((i, t.removesuffix(" ending")) for i, t in with_words)
    assert found == Counter({(1, texts[0]): 1, (1, texts[1]): 1, (1, texts[2]): 1, (None, texts[3]): 1, (None, texts[4]): 1, (5, texts[5]): 1})
    assert Counter(i for i, t in stays if not (t and t.strip())) == Counter({7: 2, None: 1})


def test_mix_and_encode(spark, documents):
    rows = [(i, f"document {i} " + "w " * (i % 30), "abc"[i % 3] if i % 2 else "a") for i in range(200)]
    docs = documents(rows)
    mixed = mix(spark, docs, SF_DIR)
    assert mixed.columns == docs.columns
    times = Counter(r.doc_id for r in mixed.collect())
    assert max(times.values()) <= 3 and set(times) < {i for i, _, _ in rows}
    by_source = Counter()
    for i, t, s in rows:
        by_source[s] += times[i] * len(t.split())
    total = sum(len(t.split()) for _, t, _ in rows)
    assert abs(by_source["a"] - total / 6) <= 40 and by_source["c"] > by_source["b"]

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    encoded = encode(spark, mixed, SF_DIR).collect()
    texts = {i: t for i, t, _ in rows}
    assert Counter(r.doc_id for r in encoded) == times
    for r in encoded:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(texts[r.doc_id], add_special_tokens=False).ids


def test_odd_documents_pass_all_stages(spark, documents):
    rows = documents([(i, t, None if i == 2 else "s", 5) for i, t in ODD], "doc_id long, text string, source string, n_chars long")
    for table in (rows, rows.limit(0)):
        docs = table
        for _, function in STAGES[:-1]:
            docs = function(spark, docs, SF_DIR)
            assert docs.columns == table.columns
        assert encode(spark, docs, SF_DIR).count() == docs.count()
    once = near_dedup(spark, rows, SF_DIR).collect()
    assert Counter(r.doc_id for r in once) == Counter({1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1, None: 2})


def test_rows_that_differ_in_other_columns_only(spark):
    """Whatever the partitioning, one and the same of them stays; the mix does not confuse their sources."""
    rng = random.Random(3)
    text, other = sentence(rng, 50), sentence(rng, 50)
    rows = [(1, text, s, lang) for s, lang in (("b", "x"), ("a", "z"), ("a", "y"), (None, "w"))] + [(None, other, "a", str(i)) for i in range(30)]
    schema = "doc_id long, text string, source string, lang string, __row_id string, __doc_id int, row_id string, decided_doc_id string, n_chars int"
    results = set()
    for n in (1, 3, 5):
        docs = spark.createDataFrame([(*r, "x", 1, "y", "z", 7) for r in rows], schema).repartition(n)
        (kept,) = [r for r in near_dedup(spark, docs, SF_DIR).collect() if r.doc_id == 1]
        mixed = sorted((tuple(r)[:4] for r in mix(spark, docs, SF_DIR).collect() if r.doc_id == 1), key=repr)
        results.add((kept.source, kept.lang, tuple(map(str, mixed))))
    assert len(results) == 1
    ((source, lang, mixed),) = results
    assert (source, lang) == ("a", "y") and all("'z'" not in m for m in mixed)


def test_clashing_names_pass_all_stages(spark):
    names = "__row_id, __row_text_hash, __doc_id, __text_hash, row_id, Row_Text_Hash, row_id_, decided_doc_id, decided_copies, whole_row, copy"
    schema = "doc_id long, text string, source string, " + ", ".join(f"{c.strip()} string" for c in names.split(","))
    docs = table = spark.createDataFrame([(i, t, "s", *["x"] * 11) for i, t in ODD], schema)
    for _, function in STAGES[:-1]:
        docs = function(spark, docs, SF_DIR)
        assert docs.columns == table.columns
        assert all(r.row_id == r.copy == r["__doc_id"] == "x" for r in docs.collect())
    assert encode(spark, docs, SF_DIR).count() == docs.count() > 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert len(rows) > 50 and all(len(r.ids) == 4 * r.n_tokens for r in rows)
