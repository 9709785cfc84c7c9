"""Removing repeated word sequences, found by difference-cover anchors.

A window is WINDOW consecutive words. Anchors are shorter runs, hashed only where the word's position modulo PERIOD lies in
COVER. Each distance modulo PERIOD is a difference of two members of COVER; so whatever the positions of two
equal windows, there is one shift below PERIOD at which both have an anchor, and the anchors are equal. Windows without
a repeated anchor are thus unique; the others extend their anchors to whole windows, and these are compared.
"""

import re
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratalake.llm import fingerprints as fp
from stratalake.llm.common import SplitTexts, id_and_text, mix, pack_text, run_hashes, text_slices, unpack_texts

WINDOW = 13
#: A perfect difference cover: 0, 1 and 3 differ by every distance modulo 7.
PERIOD, COVER = 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
#: Rank of documents without an id: after all others.
LAST = 2**63 - 1

#: Makes the second hash of a window another one.
_SECOND = np.uint64(0xA24BAED4963EE407)
_SPACE = re.compile(rb"([\x20\x09-\x0D]+)")
_BLANK = b" \t\n\r\x0b\x0c"


def _anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of a document; none if it has no window."""
    if len(words) < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes = run_hashes(words, ANCHOR)
    starts = np.arange(0, len(hashes), PERIOD)
    at = (starts[:, None] + np.array(COVER)).ravel()
    at = at[at < len(hashes)]
    return at, hashes[at]


def _candidates(words: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """Starts of the windows that hold a repeated anchor at one of their first PERIOD positions."""
    at, hashes = _anchors(words)
    n = len(words) - WINDOW + 1
    marked = np.zeros(n + PERIOD, np.int64)
    marked[at[fp.contains(repeated, fp.low(hashes, fp.ROUGH))]] = 1
    before = np.r_[0, np.cumsum(marked)]
    return np.flatnonzero(before[PERIOD : PERIOD + n] > before[:n])


def _windows(words: np.ndarray) -> np.ndarray:
    """The fingerprint of every window, by start."""
    return fp.pair(run_hashes(words, WINDOW), run_hashes(mix(words ^ _SECOND), WINDOW))


def _by_text(slices: Iterable[tuple[int, list[bytes]]]) -> Iterator[tuple[int, np.ndarray]]:
    """Row and word hashes of each text that has a window."""
    for start, texts in slices:
        split = SplitTexts(texts)
        for i, words in enumerate(split.by_text(split.hashes()), start):
            if len(words) >= WINDOW:
                yield i, words


def _plain(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    for start, end in text_slices(texts):
        yield start, texts.slice(start, end - start).to_pylist()


def remove_repeated_words(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep_layout: bool = False
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_text, text_hash``.

    Each word goes that is covered by a window whose words, in the same order, also start in a document with a smaller id. Windows
    are judged on the input. ``kept_text`` joins the words that stay by one space; with ``keep_layout`` words are
    followed by their own white space instead.

    Words are taken as they are. Null and empty texts have no words, shorter ones than WINDOW no windows. Rows without an id come
    after all ids. Rows that share an id, such as repeated rows, do not count as smaller than each other, so none of
    them loses words to another. An empty table gives no rows; other columns are ignored.
    """
    texts = id_and_text(docs, id_column, text_column).select(
        F.xxhash64("doc_id", "text").alias("key"),
        F.coalesce("doc_id", F.lit(LAST)).alias("rank"),
        F.col("text").cast("binary").alias("text"),
        "doc_id",
    )
    parts = fp.parts_of(texts)

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = fp.Gathered()
        for batch in batches:
            keys, ranks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, words in _by_text(_plain(batch.column(2))):
                gathered.add(keys[i], ranks[i], np.unique(_anchors(words)[1]))
                if gathered.size >= fp.CHUNK:
                    yield from fp.pack_shared(gathered, parts, fp.ROUGH, tell=True)
                    gathered = fp.Gathered()
        if gathered.size:
            yield from fp.pack_shared(gathered, parts, fp.ROUGH, tell=True)

    anchors = texts.select("key", "rank", "text").mapInArrow(send_anchors, fp.PACKED)
    repeated = fp.exchange(anchors, parts, fp.ROUGH, fp.SHARED, "cover_anchors")

    def send_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = fp.Gathered()
        for batch in batches:
            keys, ranks, answers = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for i, words in _by_text(unpack_texts(batch.column(2))):
                starts = _candidates(words, fp.unpack(answers[i], fp.ROUGH))
                gathered.add(keys[i], ranks[i], fp.distinct(_windows(words)[starts])[0])
                if gathered.size >= fp.CHUNK:
                    yield from fp.pack_first(gathered, parts, fp.EXACT)
                    gathered = fp.Gathered()
        if gathered.size:
            yield from fp.pack_first(gathered, parts, fp.EXACT)

    # Texts travel packed.
    sent = pack_text(texts.select("key", "rank", "text"), "text")
    windows = sent.join(repeated, "key").select("key", "rank", "text", "answers").mapInArrow(send_windows, fp.PACKED)
    earlier = fp.exchange(windows, parts, fp.EXACT, fp.NOT_FIRST, "cover_windows")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answers, rows = batch.column(2).to_pylist(), []
            for start, texts in unpack_texts(batch.column(1)):
                # Only documents that were told of a repeat are hashed again.
                told = [i for i in range(len(texts)) if answers[start + i] is not None]
                gone_in = {}
                for i, words in _by_text([(0, [texts[i] for i in told])]):
                    repeated = fp.contains(fp.unpack(answers[start + told[i]], fp.EXACT), _windows(words))
                    if repeated.any():
                        gone_in[told[i]] = covered(repeated, WINDOW, len(words))
                rows += [_without(text, gone_in.get(i), keep_layout) for i, text in enumerate(texts)]
            columns = zip(*rows) if rows else ((), (), ())
            types = (pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types)), batch.column(3)],
                ["doc_id", "n_words", "n_removed", "kept", "text_hash"],
            )

    hashed = texts.select("key", "doc_id", "text", F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    joined = pack_text(hashed, "text").join(earlier, "key", "left")
    out = joined.select("doc_id", "text", "answers", "text_hash").mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept binary, text_hash long")
    return out.select("doc_id", "n_words", "n_removed", F.col("kept").cast("string").alias("kept_text"), "text_hash")


def _without(text: bytes, gone: np.ndarray | None, keep_layout: bool) -> tuple[int, int, bytes]:
    """Words, removed words, and what is left of a text."""
    split = text.split()
    if gone is None:
        return len(split), 0, text if keep_layout else b" ".join(split)
    keeps = (~gone).tolist()
    if not keep_layout:
        return len(split), int(gone.sum()), b" ".join(compress(split, keeps))
    spaces = [*_SPACE.split(text.strip(_BLANK))[1::2], b""]
    return len(split), int(gone.sum()), b"".join(x for pair in compress(zip(split, spaces), keeps) for x in pair)


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Places covered by windows of a length, given whether one starts at each place that has one."""
    change = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(change, at, 1)
    np.add.at(change, at + length, -1)
    return np.cumsum(change[:-1]) > 0
