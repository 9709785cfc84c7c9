"""Token ids on disk, compressed by a pair grammar per block (Re-Pair).

A block holds the ids of neighbouring documents. Frequent pairs of ids are replaced by new symbols, round after round; each
new symbol has a rule (its two parts) and an expansion length. The lengths tell where a document's ids start
among the symbols, so one document can be read without expanding the others.

File format: a Parquet table, one row per block, sorted by ``shard`` and ``block``; integers are little-endian::

    shard, block     long    place of the block; both ascend with the document id
    doc_ids          binary  signed 64-bit id per document, with has_id (one byte each, 0 where the id is null)
    doc_lengths      binary  unsigned 32-bit number of ids per document, end id included
    rules            binary  two unsigned 32-bit symbols per rule; rule r defines symbol ``first_symbol + r``
    rule_lengths     binary  unsigned 32-bit number of ids in the expansion of each rule
    symbols          binary  the compressed block, unsigned 32-bit
    first_symbol, n_ids long smallest new symbol, number of ids in the block
    first_id, last_id long   smallest and largest document id; null if the block has none
"""

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from stratalake.llm.bpe import TextEncoder, splitter
from stratalake.llm.common import id_and_text, text_slices
from stratalake.sources.scratch import scratch_folder, stage

END_ID = 0
BLOCK_IDS = 2_000_000
#: Pairs seen less often in a block are not replaced. A rule takes the room of three symbols, so one that is used less often than this
#: would gain nothing.
LEAST_COUNT, LEAST_USES = 16, 4
TABLE_BITS = 20
#: New words in a text for the tokenizers library, which takes longer for a word of a long text.
JOINED_WORDS = 100

SCHEMA = (
    "shard long, block long, doc_ids binary, has_id binary, doc_lengths binary, rules binary, rule_lengths binary, "
    "symbols binary, first_symbol long, n_ids long, first_id long, last_id long"
)


# --- grammar of one block ---


def compress(ids: np.ndarray, first_symbol: int, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, rules (two symbols each) and expansion lengths of the rules. No pair of the symbols is left ``least`` times or more.

    A round counts all pairs and gives each frequent one a rule; where frequent pairs overlap, the more frequent one is replaced.
    """
    symbols = ids.astype(np.uint32)
    rules, lengths = [np.empty((0, 2), np.uint32)], [np.empty(0, np.uint32)]
    next_symbol = first_symbol
    of_symbol = np.ones(first_symbol, np.uint32)
    # Only pairs with a new symbol, and frequent ones that were in the way of others, can be frequent in the next round.
    look = None
    while True:
        before, after = (symbols[:-1], symbols[1:]) if look is None else (symbols[look], symbols[look + 1])
        pairs = before.astype(np.uint64) << np.uint64(32) | after
        frequent, counts = _frequent_pairs(pairs, least)
        if not len(frequent):
            return symbols.astype("<u4"), np.concatenate(rules).astype("<u4"), np.concatenate(lengths).astype("<u4")
        found, rule = _places(pairs, frequent)
        at = found if look is None else look[found]
        taken = _best_places(at, counts[rule])
        worth = np.bincount(rule[taken], minlength=len(frequent)) >= LEAST_USES
        if not worth.any():
            # Frequent pairs in each other's way: the most frequent one alone is replaced at half of its places at least.
            worth[np.argmax(counts)] = True
            taken = np.flatnonzero(worth[rule])
            taken = taken[_every_second(at[taken])]
        taken = taken[worth[rule[taken]]]
        number = np.cumsum(worth) - 1
        chosen = frequent[worth]
        rules.append(np.stack([chosen >> np.uint64(32), chosen & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32))
        lengths.append(of_symbol[rules[-1][:, 0]] + of_symbol[rules[-1][:, 1]])
        of_symbol = np.concatenate([of_symbol, lengths[-1]])
        symbols[at[taken]] = next_symbol + number[rule[taken]]
        stay = np.ones(len(symbols), bool)
        stay[at[taken] + 1] = False
        symbols = symbols[stay]
        # Every place moves left by the symbols that were taken away before it.
        shift = np.zeros(len(at) + 1, np.int64)
        shift[taken + 1] = 1
        moved = at - np.cumsum(shift)[:-1]
        watched = np.zeros(len(symbols) + 1, bool)
        watched[moved[stay[at]]] = True
        # The place before the first one is -1, the end of the array, where nothing is looked for.
        watched[moved[taken] - 1] = True
        look = np.flatnonzero(watched[: max(len(symbols) - 1, 0)])
        next_symbol += len(chosen)


def _frequent_pairs(pairs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that occur at least so often, ascending, and how often."""
    ordered = np.sort(pairs)
    # Equal pairs are neighbours, so a frequent one is the same as the one ``least - 1`` places on.
    some = np.flatnonzero(ordered[least - 1 :] == ordered[: len(ordered) - least + 1]) if len(ordered) >= least else np.empty(0, np.int64)
    frequent = ordered[some]
    first = np.r_[True, frequent[1:] != frequent[:-1]] if len(frequent) else np.empty(0, bool)
    starts = np.flatnonzero(first)
    return frequent[first], np.diff(np.r_[starts, len(frequent)]) + least - 1


def _places(pairs: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a frequent pair stands, and which. Looked up in a table by hash; only pairs that share a place there are searched for."""
    hashed = lambda x: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int32)
    slots = hashed(frequent)
    table = np.full(1 << TABLE_BITS, -1, np.int32)
    table[slots] = np.arange(len(frequent), dtype=np.int32)
    slot = hashed(pairs)
    rule = table[slot]
    at = np.flatnonzero(rule >= 0)
    rule = rule[at]
    real = frequent[rule] == pairs[at]
    hidden = np.flatnonzero(table[slots] != np.arange(len(frequent)))
    if len(hidden):
        crowded = np.zeros(1 << TABLE_BITS, bool)
        crowded[slots[hidden]] = True
        ask = np.flatnonzero(~real & crowded[slot[at]])
        found = np.minimum(np.searchsorted(frequent, pairs[at[ask]]), len(frequent) - 1)
        good = frequent[found] == pairs[at[ask]]
        rule[ask[good]], real[ask[good]] = found[good], True
    return at[real], rule[real]


def _best_places(at: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of the ascending places ``at`` (as indexes), those whose pair is no less frequent than the ones that overlap it; of a run of equals
    every second."""
    overlap = at[1:] == at[:-1] + 1
    best = np.ones(len(at), bool)
    best[1:] = ~overlap | (counts[1:] >= counts[:-1])
    best[:-1] &= ~overlap | (counts[:-1] >= counts[1:])
    best = np.flatnonzero(best)
    return best[_every_second(at[best])]


def _every_second(at: np.ndarray) -> np.ndarray:
    """Which of the ascending places to take so that none follows another: in each run of neighbours every second one, from its left."""
    takes = np.ones(len(at), bool)
    # The places that follow another are few: only they are counted along their run.
    follows = np.flatnonzero(at[1:] == at[:-1] + 1) + 1
    if len(follows):
        fresh = np.r_[True, follows[1:] != follows[:-1] + 1]
        place = np.arange(len(follows))
        takes[follows[(place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0]] = False
    return np.flatnonzero(takes)


def _expansions(rules: np.ndarray, first_symbol: int) -> np.ndarray:
    """The ids behind all rules, one rule after the other."""
    return _replaced(np.arange(first_symbol, first_symbol + len(rules), dtype=np.int64), rules, first_symbol)


def _replaced(symbols: np.ndarray, rules: np.ndarray, first_symbol: int) -> np.ndarray:
    while len(symbols) and (compound := symbols >= first_symbol).any():
        at = np.cumsum(1 + compound) - (1 + compound)
        out = np.empty(len(symbols) + int(compound.sum()), np.int64)
        out[at] = symbols
        parts = rules[symbols[compound] - first_symbol]
        out[at[compound]], out[at[compound] + 1] = parts[:, 0], parts[:, 1]
        symbols = out
    return symbols.astype("<u4")


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, first_symbol: int) -> np.ndarray:
    """All ids behind some symbols. Each is a place and a length in the list of plain ids and expansions, unless all expansions
    together would be much longer than the ids that are asked for; then symbols are replaced by their parts again and again."""
    counts = np.concatenate([np.ones(first_symbol, np.int64), lengths.astype(np.int64)])
    asked = int(counts[symbols].sum())
    if int(lengths.sum(dtype=np.int64)) > 2 * asked + 1_000_000:
        return _replaced(symbols.astype(np.int64), rules, first_symbol)
    ids = np.concatenate([np.arange(first_symbol, dtype="<u4"), _expansions(rules, first_symbol)])
    starts = np.cumsum(counts) - counts
    counts = counts[symbols]
    before = np.cumsum(counts) - counts
    return ids[np.repeat(starts[symbols] - before, counts) + np.arange(asked)]


def expand_range(
    symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, first_symbol: int, start: int, end: int
) -> np.ndarray:
    """Ids ``start`` to ``end`` of a block; only the symbols that cover them are expanded."""
    of_symbol = np.concatenate([np.ones(first_symbol, np.int64), lengths.astype(np.int64)])
    ends = np.cumsum(of_symbol[symbols])
    a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, end, "left") + 1
    skipped = start - (int(ends[a - 1]) if a else 0)
    return expand(symbols[a:b], rules, lengths, first_symbol)[skipped : skipped + end - start]


# --- files ---


@lru_cache(maxsize=2)
def library_encoder(path: str) -> TextEncoder:
    """The tokenizers library encodes each distinct word once."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
    # In the byte alphabet, these characters stand for a space and a line break.
    starts_word = np.zeros(max(tokenizer.get_vocab().values()) + 1, bool)
    starts_word[[i for token, i in tokenizer.get_vocab().items() if token[0] in "\u0120\u010a"]] = True

    def encode_chunks(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words are joined to texts, behind a space of their own or a line break, and told apart by the tokens that start
        with these. What holds other white space is encoded alone."""
        single = np.array([c.split() == [c.lstrip(" ")] for c in chunks], bool)
        spaced = np.array([c[0] == " " for c in chunks], bool)
        order = np.concatenate([np.flatnonzero(single & spaced), np.flatnonzero(single & ~spaced), np.flatnonzero(~single)])
        n_spaced, n_single = int((single & spaced).sum()), int(single.sum())
        names = [chunks[i] for i in order.tolist()]
        words = names[:n_spaced] + [f"\n{c}" for c in names[n_spaced:n_single]]
        texts = ["".join(words[i : i + JOINED_WORDS]) for i in range(0, n_single, JOINED_WORDS)]
        found = [np.array(e.ids, np.uint32) for e in tokenizer.encode_batch_fast([*texts, *names[n_single:]], add_special_tokens=False)]
        ids = np.concatenate(found)
        rest = np.array([len(x) for x in found[len(texts) :]], np.int64)
        n_joined = len(ids) - int(rest.sum())
        own = np.flatnonzero(starts_word[ids[:n_joined]])
        ends_of_rest = n_joined + np.cumsum(rest)
        ends = np.concatenate([own[1:], [n_joined] if n_single else [], ends_of_rest]).astype(np.int64)
        starts = np.concatenate([own, ends_of_rest - rest])
        starts[n_spaced:n_single] += 1  # the line break
        back = np.argsort(order)
        starts, counts = starts[back], (ends - starts)[back]
        before = np.cumsum(counts) - counts
        return ids[np.repeat(starts - before, counts) + np.arange(int(counts.sum()))], counts

    return TextEncoder(encode_chunks, special, splitter(path))


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Writes the ids of all documents, ascending by id, each followed by ``end_id``, to token files in ``path``.

    A null text has only the end id. Documents without an id come last; equal ids are ordered by a hash of the text. An empty
    table writes files without blocks. Other columns are ignored. A block is written as soon as it holds ``block_ids`` ids, so no
    task holds a shard; and rows of one id, or of none, are dealt to as many tasks as they need, be they copies.
    """
    order = ["no_id", "doc_id", "digest", "nth"]
    sorted_docs = id_and_text(docs, id_column, text_column).withColumns(
        {
            "no_id": F.col("doc_id").isNull(),
            "digest": F.xxhash64("text"),
            # Copies may come in any order.
            "nth": F.monotonically_increasing_id(),
        }
    )
    sorted_docs = sorted_docs.repartitionByRange(*order).sortWithinPartitions(*order)
    first_symbol = 1 << 16

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        shard, block, held, names, parts = TaskContext.get().partitionId(), 0, 0, [], []
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            for a, b in text_slices(texts):
                for name, ids in zip(doc_ids.slice(a, b - a).to_pylist(), encoder.encode_all(texts.slice(a, b - a).to_pylist())):
                    names.append(name)
                    parts.append(ids + end)
                    held += len(parts[-1]) // 4
                    if held >= block_ids:
                        yield _block(shard, block, names, parts, first_symbol)
                        block, held, names, parts = block + 1, 0, [], []
        if names:
            yield _block(shard, block, names, parts, first_symbol)

    sorted_docs.select("doc_id", "text").mapInArrow(blocks, SCHEMA).write.parquet(path)


def _block(shard: int, block: int, names: list, parts: list[bytes], first_symbol: int) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(parts), "<u4")
    first_symbol = max(first_symbol, int(ids.max()) + 1)
    symbols, rules, lengths = compress(ids, first_symbol)
    row = {
        "shard": shard,
        "block": block,
        "doc_ids": np.array([n or 0 for n in names], "<i8").tobytes(),
        "has_id": np.array([n is not None for n in names], "u1").tobytes(),
        "doc_lengths": np.array([len(p) // 4 for p in parts], "<u4").tobytes(),
        "rules": rules.tobytes(),
        "rule_lengths": lengths.tobytes(),
        "symbols": symbols.tobytes(),
        "first_symbol": first_symbol,
        "n_ids": len(ids),
        "first_id": min((n for n in names if n is not None), default=None),
        "last_id": max((n for n in names if n is not None), default=None),
    }
    return pa.RecordBatch.from_pylist([row], schema=_ARROW)


_ARROW = pa.schema(
    [
        (name, pa.binary() if kind == "binary" else pa.int64())
        for name, kind in (field.split() for field in SCHEMA.split(", "))
    ]
)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``."""
    files = spark.read.schema(SCHEMA).parquet(path)
    # One small row per block; the order over all of them gives the blocks' places.
    before = W.orderBy("shard", "block").rowsBetween(W.unboundedPreceding, -1)
    starts = files.select("shard", "block", "n_ids").select(
        F.col("shard"), F.col("block"), F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("block_start")
    )
    # Stored, so that Spark knows its size and need not shuffle the blocks while it is small.
    starts = stage(starts, "token_block_starts")
    return files.join(starts, ["shard", "block"]).mapInArrow(
        _documents, "doc_id long, start long, n_tokens long, ids binary"
    )


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            lengths = np.frombuffer(row["doc_lengths"], "<u4").astype(np.int64)
            names, known = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["has_id"], "u1") == 0
            ids = expand(*_grammar(row))
            ends = np.cumsum(lengths)
            parts = [ids[e - n : e].tobytes() for e, n in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.int64(), mask=known),
                    pa.array(row["block_start"] + ends - lengths, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(parts, pa.binary()),
                ],
                ["doc_id", "start", "n_tokens", "ids"],
            )


def _grammar(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    return (
        np.frombuffer(row["symbols"], "<u4"),
        np.frombuffer(row["rules"], "<u4").reshape(-1, 2),
        np.frombuffer(row["rule_lengths"], "<u4"),
        row["first_symbol"],
    )


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of the documents with one id, each read alone out of its block. Blocks without it are left out by their first and last id."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                lengths = np.frombuffer(row["doc_lengths"], "<u4").astype(np.int64)
                ends = np.cumsum(lengths)
                own = (np.frombuffer(row["doc_ids"], "<i8") == doc_id) & (np.frombuffer(row["has_id"], "u1") == 1)
                places = zip((ends - lengths)[own].tolist(), ends[own].tolist())
                found = [expand_range(*_grammar(row), a, b).tobytes() for a, b in places]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["ids"])

    blocks = spark.read.schema(SCHEMA).parquet(path).where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    return [np.frombuffer(row["ids"], "<u4") for row in blocks.mapInArrow(find, "ids binary").toLocalIterator()]


def token_files(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Writes token files to the shared scratch folder and reads them back."""
    path = scratch_folder(docs.sparkSession, "token_files")
    write_token_files(docs, path, tokenizer_path, **options)
    return read_token_files(docs.sparkSession, path)
