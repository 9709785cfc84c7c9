import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from stratalake.llm.chat import format_chats, read_loss_texts, read_turns
from stratalake.llm.mixing import mix_sources
from stratalake.llm.oracles import ORACLES
from stratalake.llm.queries import QUERIES
from tests.helpers import canonical
from tests.llm import brute
from tests.llm.conftest import ODD

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "conversations", "embeddings", "benchmark"):
        duck.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    wanted = duck.execute(f"select {', '.join(df.columns)} from ({ORACLES[name]})").fetchall()
    assert sorted([canonical(v) for v in r] for r in df.collect()) == sorted([canonical(v) for v in r] for r in wanted)


def test_mix_reaches_its_targets(spark, documents):
    rows = [(i, "w " * (1 + i * 7 % 90), f"s{i % 7}" if i % 50 else None) for i in range(2_000)]
    rows += [(5_000 + i, "big " * 50, "hot") for i in range(1_000)]
    taken = mix_sources(documents(rows).repartition(7)).collect()
    assert len(taken) == len(rows)
    by_source = defaultdict(list)
    for r in taken:
        by_source[r.source].append(r)
        assert 0 <= r.taken <= 3 * r.size
    for found in by_source.values():
        assert sum(r.size for r in found) == found[0].source_size
        assert sum(r.taken for r in found) == round(found[0].target)
    assert sum(r.taken for r in taken) == pytest.approx(sum(r.size for r in taken), abs=len(by_source))
    again = mix_sources(documents(rows).repartition(3)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in taken)


def test_full_sources_leave_their_excess_to_the_others(spark, documents):
    rows = [(1, "a " * 10, "a"), (2, "b " * 1_000, "b"), (3, "c " * 10, "c")]
    found = {r.source: (r.target, r.taken) for r in mix_sources(documents(rows)).collect()}
    assert found == {"a": (30.0, 30), "b": (960.0, 960), "c": (30.0, 30)}


def test_each_document_has_its_chance(spark, documents):
    """Over many seeds, the share of draws of a document comes near its inclusion probability."""
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(40)]
    docs = documents(rows).cache()
    drawn = defaultdict(int)
    for seed in range(12):
        for r in mix_sources(docs, seed=seed).where("source = 'a'").collect():
            drawn[r.doc_id] += r.taken
    shares = [n / (12 * 10) for n in drawn.values()]
    assert sum(shares) / len(shares) == pytest.approx(2 / 3, abs=0.02)  # weight 1 of 3, half of all words
    assert min(shares) > 0.15


def test_reruns_agree_without_ids(spark, documents, conf):
    """Texts of one size that have no id, or all the same, and copies of them, however they are dealt to tasks."""
    rows = [(None if i % 2 else 5, f"text {i // 3} and more", "ab"[i % 2 if i % 7 else 0]) for i in range(3_000)]
    taken = []
    for n in (2, 7):
        conf({"spark.sql.shuffle.partitions": str(n)})
        found = mix_sources(documents(rows).repartition(n), bins=64).collect()
        taken.append(sorted((r.doc_id or 0, r.source, r.text_hash, r.taken) for r in found))
    assert taken[0] == taken[1]
    # They do not share one random number: in a source some come once more, others do not.
    assert {r.copies for r in found if r.source == "a"} == {0, 1}


def test_long_documents_are_drawn_more_often(spark, documents):
    """Over many seeds, shares of draws come near the inclusion probabilities, which rise with the size class."""
    sizes = [2, 9, 40, 200, 600]
    rows = [(i, "w " * sizes[i % 5], "ab"[i // 5 % 2]) for i in range(200)]
    docs, drawn, seen = documents(rows).cache(), defaultdict(int), {}
    seeds = 25
    for seed in range(seeds):
        for r in mix_sources(docs, seed=seed).where("source = 'a'").collect():
            drawn[r.size] += r.copies
            seen[r.size] = r.p
    shares = {size: n / (seeds * 20) for size, n in drawn.items()}
    assert [seen[s] for s in sizes] == sorted(seen.values()) and seen[600] > 3 * seen[2]
    assert all(shares[s] == pytest.approx(seen[s], abs=0.12) for s in sizes)
    assert sum(seen[s] * s * 20 for s in sizes) == pytest.approx(sum(sizes) * 20 * 2 / 3, rel=0.01)


def test_what_is_heavy_enough_is_certain(spark, documents):
    """Most of the words lie in light documents, so the few heavy ones reach probability 1."""
    rows = [(i, "w " * 2, "a") for i in range(500)] + [(1_000 + i, "w " * 300, "a") for i in range(2)]
    rows += [(5_000 + i, "w " * 2, "b") for i in range(600)]
    found = mix_sources(documents(rows)).collect()
    heavy = [r for r in found if r.size == 300]
    assert all(r.p == 1 and r.taken == 300 for r in heavy)
    light = [r for r in found if r.source == "a" and r.size == 2]
    assert len({r.p for r in light}) == 1 and 0 < light[0].p < 1
    assert sum(r.taken for r in found if r.source == "a") == round(light[0].target)


def test_odd_documents(spark, documents):
    found = mix_sources(documents([(i, t, None if i == 4 else "s") for i, t in ODD])).collect()
    assert len(found) == len(ODD)
    assert {r.doc_id: r.size for r in found if r.doc_id in (1, 2, 3, 4)} == {1: 0, 2: 0, 3: 0, 4: 2}
    assert all(r.taken == 0 for r in found if r.size == 0)
    assert mix_sources(documents([])).collect() == []
    assert [r.taken for r in mix_sources(documents([(1, "", "s"), (2, None, None)])).collect()] == [0, 0]


# --- chats ---


def chats(spark, rows):
    turns = spark.createDataFrame([r + ("x", "y") for r in rows], "conv_id long, turn long, role string, text string, turns string, pieces string")
    return format_chats(turns).select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss"), "loss_spans"
    )


def test_control_strings_survive(spark):
    texts = ["<|end|>", "a<|+|>b<|user|>", "\\1 \\0 \\", "<", "\\<\\1", "</s>[INST] ok [/INST]", "😀<|assistant|>\n", ""]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)]
    (found,) = chats(spark, rows).collect()
    assert [(t.role, t.text) for t in found.turns] == [(r[2], r[3]) for r in rows]
    assert found.loss == texts[1::2]
    assert len(re.findall(r"<\|end\|>", found.formatted)) == len(texts)


def test_neighbours_of_one_role_are_merged(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", "d"), (1, 4, "user", "e")]
    (found,) = chats(spark, rows).collect()
    assert found.formatted == "<|user|>a<|+|>b<|end|><|assistant|>c<|+|>d<|end|><|user|>e<|end|>"
    assert [found.formatted[s.start : s.start + s.length] for s in found.loss_spans] == ["c", "d"]
    assert [t.text for t in found.turns] == list("abcde")


def test_odd_turns(spark):
    rows = [
        (1, None, "user", "last"), (1, 1, None, None), (1, 0, "a|b<c>", "x"), (1, 0, "a|b<c>", "x"),
        (None, 0, "assistant", "no id"), (2, 0, "assistant", "word " * 50_000),
    ]
    found = {r.conv_id: r for r in chats(spark, rows).collect()}
    assert [(t.role, t.text) for t in found[1].turns] == [("a|b<c>", "x"), ("a|b<c>", "x"), ("", ""), ("user", "last")]
    assert found[None].loss == ["no id"] and found[2].loss == ["word " * 50_000]
    assert chats(spark, []).collect() == []


def test_ties_go_by_the_text_as_it_was(spark):
    """Escaping changes the order of texts, so it comes after sorting."""
    (found,) = chats(spark, [(1, 0, "user", t) for t in ("<b", "A", "\\", "Z")]).collect()
    assert [t.text for t in found.turns] == ["<b", "A", "Z", "\\"]


@pytest.mark.parametrize("n", [1, 255, 256, 257, 3000])
def test_spans_of_long_conversations(spark, n):
    rows = [(1, i, ("user", "assistant", "assistant")[i % 3], f"<{i}>") for i in range(n)]
    (found,) = chats(spark, rows).collect()
    assert [(t.role, t.text) for t in found.turns] == [(r[2], r[3]) for r in rows]
    assert found.loss == [r[3] for r in rows if r[2] == "assistant"]


def test_hash_of_turns(spark):
    row = next(r for r in QUERIES["op6_chat_formatting"](spark, SF_DIR).collect() if r.conv_id == -7)
    said = "</s>[INST] ok [/INST]"
    assert row.turns_sha256 == brute.sha(f"user\n{said}\nassistant\n{said}\n") and row.loss_sha256 == brute.sha(said)
    assert (row.n_turns, row.loss_chars) == (2, len(said))
