"""Finding equal fingerprints across a corpus without a row per fingerprint.

A task packs the fingerprints of its documents into one row per part of the hash range; a part meets in one task,
which answers to the documents. Before anything is sent, a task combines the documents it reads: of equal fingerprints it
sends one, on behalf of at most one document, and answers to the others itself where that is possible. So however
many documents share a passage, a task that gathers a part gets each fingerprint at most once from each sending task.
Only where ranks decide, and several different documents share the smallest one (those without an id do), each of them asks.

Fingerprints that only propose candidates are numbers of 64 bits, of which 48 are sent. Those that decide (:func:`pair`) hold 24
more bits, from a second hash that shares nothing with the first: of 2 * 10**13 windows that are sent some 10**7 pairs of different
ones would agree in 64 bits, and less than one in 88. Sorting goes by the first 64 bits and looks at the others only where these agree.

Documents are known by a 64-bit key here. Answers are about contents, so documents that share a key by chance are safe.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from stratalake.sources.scratch import stage

#: Fingerprints that a task gathers before it sends them.
CHUNK = 1_500_000
#: Owner of a fingerprint to which no answer is due.
NOBODY = -1

_PACKED = pa.schema(
    [("part", pa.int32()), ("answer", pa.bool_()), ("keys", pa.binary()), ("ranks", pa.binary()), ("counts", pa.binary()), ("hashes", pa.binary())]
)
PACKED = "part int, answer boolean, keys binary, ranks binary, counts binary, hashes binary"
_TOLD = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("hashes", pa.binary())])
_TOLD_DDL = "part int, keys binary, counts binary, hashes binary"
_ANSWERS = pa.schema([("key", pa.int64()), ("answers", pa.binary())])
#: Bytes of a fingerprint that are sent: eleven where equality decides, six where it only proposes candidates.
EXACT, ROUGH = 11, 6
_PAIR = np.dtype([("first", "<u8"), ("second", "<u4")])
#: Text that one part of the hash range stands for, and the most parts that the 16 bits which choose a part can tell apart.
PART_BYTES, MOST_PARTS = 256 << 20, 1 << 16


def pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Fingerprints that decide, from two independent hashes; of the second the low 24 bits count."""
    out = np.empty(len(first), _PAIR)
    out["first"], out["second"] = first, second & np.uint64(2**24 - 1)
    return out


def _first(hashes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(hashes["first"]) if hashes.dtype.names else hashes


def _order(hashes: np.ndarray, *then: np.ndarray) -> np.ndarray:
    """Stable order by fingerprint, then by other values."""
    first = _first(hashes)
    order = np.lexsort((*then[::-1], first)) if then else np.argsort(first, kind="stable")
    if hashes.dtype.names:
        a, second = first[order], hashes["second"][order]
        if ((a[1:] == a[:-1]) & (second[1:] != second[:-1])).any():
            order = np.lexsort((*then[::-1], hashes["second"], first))
    return order


def _find(level: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint the first place in a sorted array that holds it, and whether there is one."""
    if not len(level):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    sorted_first, first = _first(level), _first(wanted)
    at = np.searchsorted(sorted_first, first)
    while True:
        inside, place = at < len(level), np.minimum(at, len(level) - 1)
        same = inside & (level[place] == wanted)
        # Different fingerprints may agree in their first 64 bits.
        again = inside & ~same & (sorted_first[place] == first)
        if not again.any():
            return place, same
        at = at + again


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct fingerprints, and how often each occurs."""
    if not len(hashes):
        return hashes, np.empty(0, np.int64)
    ordered = hashes[_order(hashes)]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    return ordered[starts], np.diff(np.r_[starts, len(ordered)])


def to_bytes(hashes: np.ndarray, width: int) -> bytes:
    values = np.ascontiguousarray(hashes)
    return values.view("u1").reshape(-1, values.itemsize)[:, :width].tobytes()


def from_bytes(data: bytes, width: int) -> np.ndarray:
    kind = _PAIR if width > 8 else np.dtype("<u8")
    out = np.zeros((len(data) // width, kind.itemsize), "u1")
    out[:, :width] = np.frombuffer(data, "u1").reshape(-1, width)
    return out.reshape(-1).view(kind)


class Gathered:
    """Fingerprints of the documents of one chunk: each distinct one of a document once, with whether the document alone
    already answers for it (``settled``)."""

    def __init__(self) -> None:
        self.keys: list[int] = []
        self.ranks: list[int] = []
        self.hashes: list[np.ndarray] = []
        self.settled: list[np.ndarray] = []
        self.size = 0

    def add(self, key: int, rank: int, hashes: np.ndarray, settled: np.ndarray | None = None) -> None:
        if len(hashes):
            self.keys.append(key)
            self.ranks.append(rank)
            self.hashes.append(hashes)
            self.settled.append(np.zeros(len(hashes), bool) if settled is None else settled)
            self.size += len(hashes)

    def columns(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Documents' keys and ranks, sorted by rank and key, and the fingerprints with the document of each."""
        order = np.lexsort((np.array(self.keys, np.int64), np.array(self.ranks, np.int64))).tolist()
        keys = np.array([self.keys[i] for i in order], np.int64)
        ranks = np.array([self.ranks[i] for i in order], np.int64)
        docs = np.repeat(np.arange(len(order)), [len(self.hashes[i]) for i in order])
        return keys, ranks, docs, np.concatenate([self.hashes[i] for i in order]), np.concatenate([self.settled[i] for i in order])


def pack_shared(gathered: Gathered, parts: int, width: int, tell: bool) -> Iterator[pa.RecordBatch]:
    """Sends a chunk to find what occurs twice. With ``tell``, documents that share a fingerprint within the chunk hear so at
    once; else nobody is told, and answers go to fingerprints found nowhere else."""
    keys, ranks, docs, hashes, settled = gathered.columns()
    order = _order(hashes)
    hashes, docs, settled = hashes[order], docs[order], settled[order]
    first = np.r_[True, hashes[1:] != hashes[:-1]]
    group = np.cumsum(first) - 1
    shared = np.bincount(group) > 1
    shared |= np.bincount(group, settled) > 0
    if tell:
        yield from _pack(keys, ranks, docs[shared[group]], hashes[shared[group]], parts, width, answer=True)
    owners = np.where(shared, NOBODY, docs[first])
    yield from _pack(keys, ranks, owners, hashes[first], parts, width)


def pack_first(gathered: Gathered, parts: int, width: int) -> Iterator[pa.RecordBatch]:
    """Sends a chunk to find what occurs at a smaller rank. Documents that share a fingerprint with one of smaller rank in the
    chunk hear so at once; the fingerprint goes out for those of smallest rank, once for each of their keys."""
    keys, ranks, docs, hashes, _ = gathered.columns()
    order = _order(hashes)
    hashes, docs = hashes[order], docs[order]
    first = np.r_[True, hashes[1:] != hashes[:-1]]
    least = ranks[docs[first]][np.cumsum(first) - 1]
    later = ranks[docs] > least
    asks = ~later & (first | np.r_[True, keys[docs[1:]] != keys[docs[:-1]]])
    yield from _pack(keys, ranks, docs[later], hashes[later], parts, width, answer=True)
    yield from _pack(keys, ranks, docs[asks], hashes[asks], parts, width)


def _pack(
    keys: np.ndarray, ranks: np.ndarray, docs: np.ndarray, hashes: np.ndarray, parts: int, width: int, answer: bool = False
) -> Iterator[pa.RecordBatch]:
    """One row per part. The part comes from the top bits, as the low ones may be all that is sent."""
    part = ((_first(hashes) >> np.uint64(48)) % np.uint64(parts)).astype(np.int64)
    if answer:
        part = keys[docs] % parts  # where the document's answers meet in the end
    order = np.lexsort((docs, part))
    part, docs, hashes = part[order], docs[order], hashes[order]
    rows = []
    for start, end in _runs(part):
        of_docs = [(a, b) for a, b in _runs(docs[start:end])]
        names = docs[start:end][[a for a, _ in of_docs]]
        known = names != NOBODY
        rows.append(
            {
                "part": int(part[start]),
                "answer": answer,
                "keys": np.where(known, keys[names], 0).astype("<i8").tobytes(),
                "ranks": np.where(known, ranks[names], NOBODY).astype("<i8").tobytes(),
                "counts": (np.array([b - a for a, b in of_docs]) * np.where(known, 1, -1)).astype("<i4").tobytes(),
                "hashes": to_bytes(hashes[start:end], width),
            }
        )
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=_PACKED)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and end of each run of equal values."""
    if not len(values):
        return
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    yield from zip(starts.tolist(), [*starts[1:].tolist(), len(values)])


class LevelIndex:
    """Sorted arrays of fingerprints in levels. A new batch is scanned against every level for equal ones; levels of about
    the same size are merged, so there are few, and a fingerprint is merged a logarithmic number of times."""

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []  # sorted fingerprints
        self.places: list[np.ndarray] = []  # where each of them was added
        self.found: list[np.ndarray] = []  # for each fingerprint added, whether it was found again
        self.size = 0

    def add(self, hashes: np.ndarray, settled: np.ndarray) -> None:
        """``settled``: those that the sender has found twice already."""
        order = _order(hashes)
        hashes, found = hashes[order], settled[order].copy()
        for level, hits in zip(self.levels, self.found):
            at, same = _find(level, hashes)
            found |= same
            hits[at[same]] = True
        self.levels.append(hashes)
        self.places.append(self.size + order)
        self.found.append(found)
        self.size += len(hashes)
        while len(self.levels) > 1 and len(self.found[-2]) < 2 * len(self.found[-1]):
            self._merge()

    def _merge(self) -> None:
        """Merges the two smallest levels. Equal fingerprints stay side by side, each with its own owner, and have all been found."""
        level, places, found = (np.concatenate([x.pop(-2), x.pop()]) for x in (self.levels, self.places, self.found))
        order = _order(level)
        level, places, found = level[order], places[order], found[order]
        twice = level[1:] == level[:-1]
        if twice.any():
            group = np.cumsum(np.r_[True, ~twice]) - 1
            found |= (np.bincount(group) > 1)[group]
        self.levels.append(level)
        self.places.append(places)
        self.found.append(found)

    def answers(self) -> np.ndarray:
        """Whether each fingerprint, in the order of adding, occurs more than once."""
        while len(self.levels) > 1:
            self._merge()
        out = np.zeros(self.size, bool)
        if self.levels:
            out[self.places[0]] = self.found[0]
        return out


def _shared(hashes: list[np.ndarray], ranks: list[np.ndarray]) -> np.ndarray:
    index = LevelIndex()
    for h, r in zip(hashes, ranks):
        index.add(h, r == NOBODY)
    return index.answers()


def _unshared(hashes: list[np.ndarray], ranks: list[np.ndarray]) -> np.ndarray:
    return ~_shared(hashes, ranks)


def _not_first(hashes: list[np.ndarray], ranks: list[np.ndarray]) -> np.ndarray:
    """Whether an equal fingerprint has a smaller rank."""
    every, rank = np.concatenate(hashes), np.concatenate(ranks)
    order = _order(every, rank)
    h, r = every[order], rank[order]
    first = np.r_[True, h[1:] != h[:-1]]
    out = np.zeros(len(h), bool)
    out[order] = r > r[first][np.cumsum(first) - 1]
    return out


SHARED, UNSHARED, NOT_FIRST = _shared, _unshared, _not_first


def exchange(packed: DataFrame, parts: int, width: int, rule: Callable, purpose: str) -> DataFrame:
    """Brings each part together, applies the rule, and stores the answers: ``key, answers`` (packed fingerprints).

    Answers travel packed, too: one row for all documents whose keys fall in the same part.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ranks, hashes = [], [], []
        for batch in batches:
            told = batch.filter(batch.column("answer"))
            if told.num_rows:
                yield told.select(["part", "keys", "counts", "hashes"])
            for row in batch.filter(pa.compute.invert(batch.column("answer"))).to_pylist():
                counts = np.abs(np.frombuffer(row["counts"], "<i4"))
                keys.append(np.repeat(np.frombuffer(row["keys"], "<i8"), counts))
                ranks.append(np.repeat(np.frombuffer(row["ranks"], "<i8"), counts))
                hashes.append(from_bytes(row["hashes"], width))
        if not hashes:
            return
        hit = rule(hashes, ranks)
        key, rank, every = np.concatenate(keys), np.concatenate(ranks), np.concatenate(hashes)
        hit &= rank != NOBODY
        key, every = key[hit], every[hit]
        order = np.lexsort((key, key % parts))
        key, every = key[order], every[order]
        for start, end in _runs(key % parts):
            of_keys = list(_runs(key[start:end]))
            row = {
                "part": int(key[start] % parts),
                "keys": key[start:end][[a for a, _ in of_keys]].astype("<i8").tobytes(),
                "counts": np.array([b - a for a, b in of_keys], "<i4").tobytes(),
                "hashes": to_bytes(every[start:end], width),
            }
            yield pa.RecordBatch.from_pylist([row], schema=_TOLD)

    def deliver(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, hashes = [], []
        for batch in batches:
            for row in batch.to_pylist():
                keys.append(np.repeat(np.frombuffer(row["keys"], "<i8"), np.frombuffer(row["counts"], "<i4")))
                hashes.append(from_bytes(row["hashes"], width))
        if not keys:
            return
        key, every = np.concatenate(keys), np.concatenate(hashes)
        order = np.argsort(key, kind="stable")
        key, every = key[order], every[order]
        runs = list(_runs(key))
        for a in range(0, len(runs), 5_000):
            some = runs[a : a + 5_000]
            columns = [[int(key[s]) for s, _ in some], [to_bytes(every[s:e], width) for s, e in some]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ANSWERS.types)], schema=_ANSWERS)

    told = packed.repartitionById(parts, F.col("part")).mapInArrow(gather, _TOLD_DDL)
    return stage(told.repartitionById(parts, F.col("part")).mapInArrow(deliver, "key long, answers binary"), purpose)


def unpack(answers: bytes | None, width: int) -> np.ndarray:
    """The distinct fingerprints of a document's answers, sorted."""
    return distinct(from_bytes(answers or b"", width))[0]


def parts_of(texts: DataFrame) -> int:
    """Parts of the hash range: one for each PART_BYTES of text (a binary column), and at least the session's shuffle partitions, so
    that what a task gathers does not grow with the corpus."""
    held = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    usual = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MOST_PARTS, max(usual, -(-held // PART_BYTES)))


def low(hashes: np.ndarray, width: int) -> np.ndarray:
    """What is left of fingerprints after they were sent."""
    return hashes & np.uint64(2 ** (8 * width) - 1) if width < 8 else hashes


def contains(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    return _find(sorted_values, values)[1]
