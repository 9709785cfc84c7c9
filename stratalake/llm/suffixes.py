"""Removing repeated strings, found with a logarithmic family of suffix arrays.

Only matches of at least LENGTH bytes count, so suffixes are compared on their first LENGTH bytes, by an 88-bit fingerprint of
them, and a suffix array is the sorted list of the fingerprints of a batch of documents. Whatever task gathers a
part of the fingerprint range keeps a family of such arrays (``fingerprints.LevelIndex``): the array of a new batch is
scanned against every level, and levels of equal size are merged.

Not every suffix goes in. Any string of LENGTH bytes holds LENGTH - SEED + 1 seeds of SEED bytes, and the one with the smallest
hash is the same wherever the string occurs. Sampled suffixes, those that start with such a seed, are indexed
first; a string whose own seed is found nowhere else is unique, and only the others are indexed whole.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratalake.llm import fingerprints as fp
from stratalake.llm.common import id_and_text, mix, pack_text, unpack_texts
from stratalake.llm.cover import covered
from stratalake.sources.scratch import stage

LENGTH, SEED = 200, 150
SEEDS = LENGTH - SEED + 1
#: Starts that are hashed at once; longer texts are worked through piece by piece.
PIECE = 1 << 19
#: Seeds of the two independent hashes of a string.
FIRST, SECOND = 20_240_602, 20_240_604
#: Low bits that hold a seed's position in its piece while the smallest hash is looked for.
_PLACE = np.uint64((1 << 20) - 1)


@lru_cache
def _powers(seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte, and the powers of an odd base and of its inverse modulo 2**64."""
    random = np.random.default_rng(seed)
    base = int(random.integers(0, 2**64, dtype=np.uint64)) | 1
    n = PIECE + 2 * LENGTH
    powers, inverse = np.ones(n, np.uint64), np.ones(n, np.uint64)
    powers[1:], inverse[1:] = np.uint64(base), np.uint64(pow(base, -1, 2**64))
    return random.integers(0, 2**64, 256, dtype=np.uint64), np.cumprod(powers), np.cumprod(inverse)


def _prefix_sums(text: np.ndarray, seed: int = FIRST) -> np.ndarray:
    of_byte, powers, _ = _powers(seed)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(of_byte[text] * powers[: len(text)])])


def _hashes(sums: np.ndarray, length: int) -> np.ndarray:
    """Hash of each string of a length, by start: a polynomial of the bytes, so one subtraction gives it."""
    n = len(sums) - length
    return mix((sums[length:] - sums[:n]) * _powers(FIRST)[2][:n])


def _hashes_at(sums: np.ndarray, starts: np.ndarray, seed: int) -> np.ndarray:
    """Hash of the string of LENGTH bytes at some starts."""
    return mix((sums[starts + LENGTH] - sums[starts]) * _powers(seed)[2][starts])


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values, by doubling."""
    out, size = values, 1
    while 2 * size <= width:
        out, size = np.minimum(out[:-size], out[size:]), 2 * size
    rest = width - size
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def strings(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By piece of a text: its bytes, prefix sums, and for each start of a string its smallest seed, as hash (44 high bits) and place."""
    every = np.frombuffer(text, np.uint8)
    for start in range(0, max(0, len(every) - LENGTH + 1), PIECE):
        piece = every[start : start + PIECE + LENGTH - 1]
        sums = _prefix_sums(piece)
        seeds = _hashes(sums, SEED)
        seeds = seeds & ~_PLACE | np.arange(len(seeds), dtype=np.uint64)
        yield piece, sums, _smallest(seeds, SEEDS)


def _seeds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct seeds of a text, and whether the text has each at two places."""
    found = []
    for i, (_, _, smallest) in enumerate(strings(text)):
        sampled = smallest[np.r_[True, smallest[1:] != smallest[:-1]]]
        # Pieces overlap, so a seed at their border is found twice: tell places by their distance from the text's start.
        found.append(np.stack([sampled >> np.uint64(20), (sampled & _PLACE) + np.uint64(i * PIECE)]))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, bool)
    seeds, places = np.concatenate(found, axis=1)
    order = np.lexsort((places, seeds))
    seeds, places = seeds[order], places[order]
    fresh = np.r_[True, (seeds[1:] != seeds[:-1]) | (places[1:] != places[:-1])]
    values, counts = np.unique(seeds[fresh], return_counts=True)
    return _seed_hash(values), counts > 1


def _seed_hash(seeds: np.ndarray) -> np.ndarray:
    return mix(seeds)


def _candidates(text: bytes, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and fingerprints of the strings whose smallest seed is repeated."""
    starts, hashes = [np.empty(0, np.int64)], [fp.pair(*np.empty((2, 0), np.uint64))]
    for i, (piece, sums, smallest) in enumerate(strings(text)):
        at = np.flatnonzero(fp.contains(repeated, fp.low(_seed_hash(smallest >> np.uint64(20)), fp.ROUGH)))
        if len(at):
            starts.append(at + i * PIECE)
            hashes.append(fp.pair(_hashes_at(sums, at, FIRST), _hashes_at(_prefix_sums(piece, SECOND), at, SECOND)))
    return np.concatenate(starts), np.concatenate(hashes)


def remove_repeated_strings(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept`` (binary).

    Each byte goes that is covered by a string of LENGTH bytes that also starts anywhere else, in the same document or another;
    overlaps count. Strings are judged on the input. ``n_spans`` counts maximal runs of removed bytes.

    Texts are UTF-8; null ones are empty. Matches never cross documents. Repeated rows are documents of their own, so their
    texts of LENGTH bytes or more go. Null ids stay as they are; an empty table gives no rows; other columns are
    ignored.
    """
    texts = id_and_text(docs, id_column, text_column).select(
        F.xxhash64("doc_id", "text").alias("key"), F.col("text").cast("binary").alias("text"), "doc_id"
    )
    parts = fp.parts_of(texts)
    # Documents with the same text: every string is repeated. One of them speaks for it in the index.
    long = texts.where(F.octet_length("text") >= LENGTH).select("key", F.md5("text").alias("digest"))
    copies = stage(
        long.groupBy("digest").agg(F.count("key").alias("n"), F.min("key").alias("speaker")).where("n > 1"), "suffix_copies"
    )
    copied = stage(
        long.join(copies, "digest").select("key", (F.col("key") == F.col("speaker")).alias("speaks")).distinct(), "suffix_copied"
    )

    def send_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = fp.Gathered()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                gathered.add(key, 0, *_seeds(text.as_py()))
                if gathered.size >= fp.CHUNK:
                    yield from fp.pack_shared(gathered, parts, fp.ROUGH, tell=True)
                    gathered = fp.Gathered()
        if gathered.size:
            yield from fp.pack_shared(gathered, parts, fp.ROUGH, tell=True)

    seeds = texts.select("key", "text").mapInArrow(send_seeds, fp.PACKED)
    repeated = fp.exchange(seeds, parts, fp.ROUGH, fp.SHARED, "suffix_seeds")
    about = stage(repeated.join(copied, "key", "full"), "suffix_about")

    def send_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = fp.Gathered()
        for batch in batches:
            keys, answers, speaks = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for start, slice_ in unpack_texts(batch.column(1)):
                for i, text in enumerate(slice_, start):
                    _, hashes = _candidates(text, fp.unpack(answers[i], fp.ROUGH))
                    values, counts = fp.distinct(hashes)
                    gathered.add(keys[i], 0, values, (counts > 1) | bool(speaks[i]))
                    if gathered.size >= fp.CHUNK:
                        yield from fp.pack_shared(gathered, parts, fp.EXACT, tell=False)
                        gathered = fp.Gathered()
        if gathered.size:
            yield from fp.pack_shared(gathered, parts, fp.EXACT, tell=False)

    spoken = about.where("speaks is null or speaks")
    # Texts travel packed.
    packed = pack_text(texts, "text")
    sent = packed.join(spoken, "key").select("key", "text", "answers", "speaks").mapInArrow(send_strings, fp.PACKED)
    # Most candidates are repeated, so the answers name those that are not.
    single = fp.exchange(sent, parts, fp.EXACT, fp.UNSHARED, "suffix_strings").withColumnRenamed("answers", "single")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            answers, speaks, single = (batch.column(i).to_pylist() for i in (2, 3, 4))
            for start, slice_ in unpack_texts(batch.column(1)):
                rows += [_without(text, answers[i], speaks[i], single[i]) for i, text in enumerate(slice_, start)]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    known = about.join(single, "key", "left")
    joined = packed.join(known, "key", "left").select("doc_id", "text", "answers", "speaks", "single")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def _without(text: bytes, answers: bytes | None, speaks: bool | None, single: bytes | None) -> tuple[int, int, int, bytes]:
    """Bytes, removed bytes, removed runs, and what is left of a text. ``speaks`` is null if no other document has the same text."""
    gone = np.zeros(len(text), bool)
    if speaks is not None:
        gone[:] = True
    elif answers is not None:
        starts, hashes = _candidates(text, fp.unpack(answers, fp.ROUGH))
        at = np.zeros(max(0, len(text) - LENGTH + 1), bool)
        at[starts[~fp.contains(fp.unpack(single, fp.EXACT), hashes)]] = True
        gone = covered(at, LENGTH, len(text))
    spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(gone) else 0
    kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if spans else text
    return len(text), int(gone.sum()), spans, kept
