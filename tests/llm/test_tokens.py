import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from stratalake.llm import bpe, repair
from stratalake.llm.queries import QUERIES, tokenizer_path
from stratalake.sources.scratch import scratch_folder
from tests.llm import brute
from tests.llm.conftest import ODD

SF_DIR = "/root/testdata/sf0.001"
PARTS = [
    "a", "the", " ", " ", "  ", "\n", "\t", " \n", "\r\n", "é", "'s", "'LL", "12", "½", "你好", "😀", "　", "\x85", "\x1c", "-", "...",
    "ZZ", "_", "<|endoftext|>", "<|", "​", "ⅷ", "֍", "aaaa", "hello world", "\0", "über",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


@pytest.mark.parametrize("encoder", [bpe.trie_encoder, repair.library_encoder])
def test_any_text_is_encoded_as_by_the_library(library, encoder):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(15))) for _ in range(4_000)]
    for start in range(0, len(texts), 37):
        for text, found in zip(texts[start : start + 37], encoder(tokenizer_path()).encode_all(texts[start : start + 37])):
            assert ids(found) == library.encode(text, add_special_tokens=False).ids, text


def test_full_tables_start_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBER", 300)
    bpe.trie_encoder.cache_clear()
    encoder = bpe.trie_encoder(tokenizer_path())
    bpe.trie_encoder.cache_clear()
    rng = random.Random(2)
    for _ in range(40):
        text = " ".join(f"w{rng.randrange(200)}\tq" if rng.random() < 0.1 else f"v{rng.randrange(150)}" for _ in range(120))
        assert ids(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids
    assert encoder.known.n <= 300


def test_long_texts_are_cut_where_the_pattern_cuts(library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 50)
    monkeypatch.setattr(bpe, "BATCH", 1 << 20)
    rng = random.Random(3)
    text = "".join(rng.choice(PARTS) for _ in range(3_000))
    assert ids(bpe.trie_encoder(tokenizer_path()).encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_every_token_encodes_to_itself():
    words = bpe.vocabulary(tokenizer_path())
    found = words.encode_words(words.id_of)
    assert all(ids(found[token]) == [i] for token, i in words.id_of.items())


def test_documents_equal_the_library(spark, documents, library):
    found = sorted(bpe.encode_documents(documents(ODD), tokenizer_path()).collect(), key=lambda r: repr((r.doc_id, r.decoded)))
    for row, (doc_id, text) in zip(found, sorted(ODD, key=lambda r: repr((r[0], r[1] or "")))):
        wanted = library.encode(text or "", add_special_tokens=False).ids
        assert (row.doc_id, row.n_tokens, ids(row.ids), row.decoded) == (doc_id, len(wanted), wanted, library.decode(wanted, skip_special_tokens=False))
    assert bpe.encode_documents(documents([]), tokenizer_path()).collect() == []


def test_queries_equal_the_library(spark, library):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    encoded = {r.doc_id: r for r in QUERIES["op4_bpe_encoding"](spark, SF_DIR).collect()}
    filed = {r.doc_id: r for r in QUERIES["op9_token_files"](spark, SF_DIR).collect()}
    assert encoded.keys() == filed.keys() == texts.keys()
    start = 0
    for doc_id in sorted(texts):
        wanted = np.array(library.encode(texts[doc_id], add_special_tokens=False).ids, "<u4")
        row, file = encoded[doc_id], filed[doc_id]
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(wanted), brute.sha(wanted.tobytes()), brute.sha(texts[doc_id]))
        assert (file.start, file.n_tokens, file.ids_crc32) == (start, len(wanted) + 1, zlib.crc32(wanted.tobytes() + bytes(4)))
        start += len(wanted) + 1


@pytest.mark.parametrize("joined", [1, 2, 7, 100])
def test_new_words_are_joined_to_short_texts(monkeypatch, joined):
    monkeypatch.setattr(repair, "JOINED_WORDS", joined)
    library = Tokenizer.from_file(tokenizer_path())
    text = " ".join(f"word{i}" for i in range(15)) + "\nline\nbreaks\n'll they're\tодин\t two\u2003three x " + "\n".join(f"l{i}!" for i in range(15))
    for part in (text, "\nfirst", " ", "\t", "alone", "a\nb\nc\nd", ""):
        found = repair.library_encoder.__wrapped__(tokenizer_path()).encode(part)
        assert ids(found) == library.encode(part, add_special_tokens=False).ids, part


def test_overlapping_places():
    rng = np.random.default_rng(3)
    for _ in range(200):
        at = np.flatnonzero(rng.random(60) < 0.7)
        counts = rng.integers(1, 4, len(at))
        count = dict(zip(at.tolist(), counts.tolist()))
        best = [p for p in at.tolist() if count[p] >= max(count.get(p - 1, 0), count.get(p + 1, 0))]
        wanted: list[int] = []
        for p in best:
            if not wanted or wanted[-1] != p - 1:
                wanted.append(p)
        assert at[repair._best_places(at, counts)].tolist() == wanted


# --- token files ---


@pytest.mark.parametrize("seed", range(4))
def test_grammar_round_trip(seed):
    rng = np.random.default_rng(seed)
    data = rng.zipf(1.3, 30_000) % 500
    data[1_000:1_400] = 7  # a run of one id
    data[5_000:9_000] = np.tile(data[:400], 10)
    packed = repair.compress(data.astype("<u4"), 1 << 16)
    assert (repair.expand(*packed, 1 << 16) == data).all()
    assert len(packed[0]) < 0.9 * len(data) and len(packed[1]) == len(packed[2])
    for _ in range(30):
        a, b = sorted(rng.integers(0, len(data) + 1, 2).tolist())
        if a < b:
            assert (repair.expand_range(*packed, 1 << 16, a, b) == data[a:b]).all()


def pair_counts(symbols):
    """How often each pair could be replaced: overlapping ones of a run of equals count once."""
    counts, last = Counter(), {}
    for i, pair in enumerate(itertools.pairwise(symbols.tolist())):
        if last.get(pair) != i - 1:
            counts[pair] += 1
            last[pair] = i
        else:
            last.pop(pair)
    return counts


@pytest.mark.parametrize("seed", range(3))
def test_no_frequent_pair_is_left(seed):
    rng = np.random.default_rng(seed)
    phrase = rng.integers(0, 40_000, 400)
    data = np.concatenate([np.tile(phrase, 500), rng.zipf(1.2, 20_000) % 300, [7] * 1000, np.tile([1, 2, 1, 2, 3], 300)])
    symbols, rules, lengths = repair.compress(data.astype("<u4"), 1 << 16)
    assert max(pair_counts(symbols).values()) < repair.LEAST_COUNT
    assert (repair.expand(symbols, rules, lengths, 1 << 16) == data).all()
    assert lengths.max() >= 400 * 16  # the phrase, many times over
    repeated = repair.compress(np.tile(phrase, 500).astype("<u4"), 1 << 16)
    assert len(repeated[0]) < 40 and len(repeated[1]) < 500
    # The long way of expanding gives the same.
    assert (repair._replaced(symbols.astype(np.int64), rules, 1 << 16) == data).all()


def test_frequent_pairs_that_are_in_each_others_way():
    """Each pair is frequent, but so is each overlap."""
    ring = np.tile(np.arange(3), 17)
    symbols, rules, lengths = repair.compress(ring.astype("<u4"), 1 << 16)
    assert (repair.expand(symbols, rules, lengths, 1 << 16) == ring).all() and len(symbols) <= 17


@pytest.mark.parametrize("data", [[], [5], [5, 5], [1] * 100])
def test_small_grammars(data):
    packed = repair.compress(np.array(data, "<u4"), 1 << 16)
    assert repair.expand(*packed, 1 << 16).tolist() == data


def test_files_keep_order_and_odd_rows(spark, documents, library):
    path = scratch_folder(spark, "test_token_files")
    rows = [*ODD, *[(100 + i, f"text number {i} " * 5) for i in range(40)]]
    repair.write_token_files(documents(rows).repartition(6), path, tokenizer_path(), block_ids=500)
    found = sorted(repair.read_token_files(spark, path).collect(), key=lambda r: r.start)
    place = {(r.doc_id, tuple(ids(r.ids))): r.start for r in found}
    known = lambda r: (r[0], (*library.encode(r[1] or "", add_special_tokens=False).ids, 0))
    # Ascending by id; rows of one id may come in any order.
    wanted = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, place[known(r)]))
    assert [r.doc_id for r in found] == [i for i, _ in wanted]
    assert [r.start for r in found] == [sum(r.n_tokens for r in found[:k]) for k in range(len(found))]
    assert [ids(r.ids) for r in found] == [[*library.encode(t or "", add_special_tokens=False).ids, 0] for _, t in wanted]
    assert spark.read.parquet(path).count() > 1
    (alone,) = repair.read_document(spark, path, 120)
    assert alone.tolist() == [*library.encode("text number 20 " * 5, add_special_tokens=False).ids, 0]
    assert len(repair.read_document(spark, path, 7)) == 2 and repair.read_document(spark, path, 999) == []


def test_rows_of_one_id_are_dealt_to_many_tasks(spark, documents, conf):
    conf({"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    path = scratch_folder(spark, "test_token_files")
    rows = [(None, f"{'same' if i % 2 else 'text'} {i % 5}") for i in range(3000)] + [(5, "copy")] * 2000 + [(1, "first"), (9, "last")]
    repair.write_token_files(documents(rows).repartition(6), path, tokenizer_path(), block_ids=500)
    assert spark.read.parquet(path).select("shard").distinct().count() > 2
    found = sorted(repair.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [i for i, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))]
    assert len(repair.read_document(spark, path, 5)) == 2000 and len(repair.read_document(spark, path, 9)) == 1


def test_empty_table(spark, documents):
    assert repair.token_files(documents([]), tokenizer_path()).collect() == []
