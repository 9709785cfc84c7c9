"""Small helpers shared by the operators of this subpackage."""

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names; a null text is empty. Other columns cannot clash."""
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )


def ship_library(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, so that it need not be installed there."""
    context = spark.sparkContext
    if getattr(context, "_stratalake_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="stratalake-code-")) / "stratalake.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._stratalake_shipped = True


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def uniform(*parts: Column) -> Column:
    """A repeatable number in (0, 1) from the first 13 hexadecimal digits of an MD5 sum; null parts count as 'null'."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    digits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
    return (digits.cast("double") + F.lit(0.5)) / F.lit(float(16**13))


def salted_lookup(facts: DataFrame, dims: DataFrame, key: str, spread: list[str], salts: int = 64) -> DataFrame:
    """Inner join of facts, of which any number may share a key, with ``dims``, which have one row per key.

    Facts of one key are dealt into ``salts`` parts by the columns ``spread``; a key is sent once to each part that exists. So a hot
    key is ``salts`` tasks' work, without knowing which keys are hot. Both are read more than once: pass them stored.
    """
    salted = facts.withColumn("__salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    parts = salted.select(key, "__salt").distinct().join(dims, key)
    return salted.join(parts, [key, "__salt"]).drop("__salt")


def pack_text(rows: DataFrame, column: str) -> DataFrame:
    """Compresses a binary column, so that rows take less room while they are dealt out anew. :func:`unpack_texts` undoes it."""
    at = rows.columns.index(column)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = pa.array([squeeze(x) for x in batch.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([packed if i == at else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    return rows.mapInArrow(pack, rows.schema)


def unpack_texts(packed: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a packed column in slices of a few megabytes, each with the row that it starts with."""
    widen = zstandard.ZstdDecompressor().decompress
    start, texts, held = 0, [], 0
    for i, x in enumerate(packed):
        texts.append(widen(x.as_py()))
        held += len(texts[-1])
        if held >= 4_000_000:
            yield start, texts
            start, texts, held = i + 1, [], 0
    if texts:
        yield start, texts


class WordHashes(dict):
    """64-bit hash by word, computed once. Holds at most ``limit`` words, then starts anew."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: The first so many of eight bytes, read as a little-endian number.
_FIRST_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
#: Longer words are hashed one by one.
_LONG_WORD = 256


class SplitTexts:
    """The words of several texts as places in one array of bytes: ``starts`` and ``lengths`` of all, and how many each text has."""

    def __init__(self, texts: list[bytes]) -> None:
        #: Space around all texts, and enough at the end to read eight bytes from anywhere in a word.
        self.joined = b" " + b" ".join(texts) + b" " * 8
        self.bytes = np.frombuffer(self.joined, np.uint8)
        is_space = _IS_SPACE[self.bytes]
        edges = np.flatnonzero(is_space[1:] != is_space[:-1]) + 1
        self.starts, ends = edges[::2], edges[1::2]
        self.lengths = ends - self.starts
        begins = 1 + np.cumsum([0, *[len(t) + 1 for t in texts]])
        #: Number of the first word of each text, and of all words.
        self.bounds = np.searchsorted(self.starts, begins)

    def hashes(self) -> np.ndarray:
        return hash_ranges(self.joined, self.starts, self.lengths)

    def by_text(self, values: np.ndarray) -> list[np.ndarray]:
        """Values of all words, text by text."""
        return [values[a:b] for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist())]


def hash_ranges(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each range of bytes. At least eight bytes must follow the last start. Ranges of up to eight bytes and equal length never collide."""
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    out = mix((eight[starts] & _FIRST_BYTES[np.minimum(lengths, 8)]) ^ (lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    longer, at = np.flatnonzero(lengths > 8), 8
    while len(longer):
        if at >= _LONG_WORD:
            for i in longer.tolist():
                out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i] + lengths[i]])
            break
        left = lengths[longer] - at
        out[longer] = mix(out[longer] + (eight[starts[longer] + at] & _FIRST_BYTES[np.minimum(left, 8)]))
        longer, at = longer[left > 8], at + 8
    return out


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The 64-bit hash of every run of ``n`` word hashes, by start, from runs of powers of two."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    count = len(words) - n + 1
    out, taken, piece, width = np.zeros(count, np.uint64), 0, words, 1
    while taken < n:
        if n & width:
            out = mix(out * np.uint64(3) + piece[taken : taken + count])
            taken += width
        if taken < n:
            piece, width = mix(piece[:-width] * np.uint64(5) + piece[width:]), 2 * width
    return out


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The 64-bit hash of every run of ``n`` word hashes, by start."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    count = len(words) - n + 1
    out = np.zeros(count, np.uint64)
    for j in range(n):
        out = mix(out + words[j : j + count] + np.uint64(j))
    return out


def text_slices(texts: pa.Array, size: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Neighbouring rows that hold about ``size`` bytes of text together, as start and end."""
    start = held = 0
    for i, length in enumerate(pa.compute.binary_length(texts).to_pylist()):
        held += length or 0
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
