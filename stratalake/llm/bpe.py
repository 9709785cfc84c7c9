"""Byte-level BPE by trie traversal.

The encoding of a word is known from the *last token* of each of its prefixes: a token ``t`` ends the encoding of a
prefix exactly if it fits behind the last token of what is left of it. Prefixes that words share have the same last
tokens. So the distinct words are put in order, which is the order in which a depth-first walk meets the words of their
trie, and the last tokens along the current branch are kept on a stack: a word only adds the bytes by which it leaves
the branch of the word before.
"""

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from stratalake.llm.common import id_and_text, mix, text_slices

#: The split pattern of the byte-level tokenizer.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Characters outside these blocks may be classed by another Unicode version in the tokenizer's own splitter.
_OTHER_BLOCKS = re.compile("[^\x00-ԯ -⁯₠-₿]")

#: Text is encoded in pieces of about this many characters, so that memory does not grow with a document's length.
PIECE = 200_000
#: Bytes of text that are looked up at once.
BATCH = 1 << 20
#: Words whose encoding a Python worker remembers at most.
REMEMBER = 1_500_000


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens and merges of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        by_name = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (max([*by_name.values(), *self.special.values()]) + 1)
        self.id_of: dict[bytes, int] = {}
        for name, i in by_name.items():
            if name not in self.special:
                self.bytes_of[i] = bytes(alphabet[c] for c in name)
                self.id_of[self.bytes_of[i]] = i
        for name, i in self.special.items():
            self.bytes_of[i] = name.encode()
        self.rank: dict[tuple[int, int], int] = {}
        #: When a token is formed (its merge's rank, -1 for a byte), and from which two.
        self.formed, self.left, self.right = ([-1] * len(self.bytes_of) for _ in range(3))
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            x, y, z = by_name[a], by_name[b], by_name[a + b]
            self.rank.setdefault((x, y), rank)
            if self.formed[z] < 0:
                self.formed[z], self.left[z], self.right[z] = rank, x, y
        #: The length of the longest token with such last two bytes.
        self.longest: dict[bytes, int] = {}
        for token in self.id_of:
            self.longest[token[-2:]] = max(self.longest.get(token[-2:], 0), len(token))
        self.fits: dict[int, bool] = {}

    def fit(self, a: int, b: int) -> bool:
        """Whether the text of two tokens is encoded as just these two: no merge across their border comes first.

        Goes back in time from the two whole tokens: whichever neighbour of the border was formed last is split.
        """
        x, y = a, b
        x_gone = y_gone = len(self.rank)  # when the neighbour of the border becomes part of a longer token
        while True:
            rank = self.rank.get((x, y))
            if rank is not None and rank < x_gone and rank <= y_gone:
                return False
            if self.formed[x] > self.formed[y]:
                x_gone, x = self.formed[x], self.right[x]
            elif self.formed[y] >= 0:
                y_gone, y = self.formed[y], self.left[y]
            else:
                return True

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers, by depth-first trie traversal."""
        id_of, longest, fits, bytes_of = self.id_of, self.longest, self.fits, self.bytes_of
        found: dict[bytes, bytes] = {}
        branch = b""
        last: list[int] = [-1]  # last[n]: last token of the first n bytes of the branch
        for word in sorted(words):
            shared = len(os.path.commonprefix((branch, word)))
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                size = min(end, longest.get(word[max(0, end - 2) : end], 1))
                while True:
                    token = id_of.get(word[end - size : end])
                    if token is not None:
                        if size == end:
                            break
                        pair = last[end - size] << 20 | token
                        fit = fits.get(pair)
                        if fit is None:
                            if len(fits) > REMEMBER:
                                fits.clear()
                            fit = fits[pair] = self.fit(last[end - size], token)
                        if fit:
                            break
                    size -= 1
                last.append(token)
            branch = word
            ids = []
            end = len(word)
            while end:
                ids.append(last[end])
                end -= len(bytes_of[last[end]])
            found[word] = np.array(ids[::-1], "<u4").tobytes()
        return found

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class WordTable:
    """Ids by the hash of a word, for many words at once: open addressing in arrays. Starts anew when it is full."""

    def __init__(self) -> None:
        self.mask = np.uint64((1 << (2 * REMEMBER - 1).bit_length()) - 1)
        self.hashes = np.zeros(int(self.mask) + 1, np.uint64)
        self.starts = np.zeros(int(self.mask) + 1, np.int32)
        self.counts = np.zeros(int(self.mask) + 1, np.int32)
        self.clear()

    def clear(self) -> None:
        self.hashes[:] = 0
        self.n = self.used = 0
        self.ids = np.empty(1 << 20, np.uint32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 where it is unknown."""
        slots = hashes & self.mask
        places = np.where(self.hashes[slots] == hashes, slots.astype(np.int64), -1)
        open_ = np.flatnonzero((places < 0) & (self.hashes[slots] != 0))
        while len(open_):
            slots[open_] = (slots[open_] + np.uint64(1)) & self.mask
            there = self.hashes[slots[open_]]
            hit = there == hashes[open_]
            places[open_[hit]] = slots[open_[hit]]
            open_ = open_[~hit & (there != 0)]
        return places

    def add(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """New words: distinct hashes that were not found, their ids one after the other, and how many each has."""
        total = len(ids)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty(len(self.ids), np.uint32)])
        self.ids[self.used : self.used + total] = ids
        starts = self.used + np.cumsum(counts) - counts
        self.used += total
        self.n += len(hashes)
        slots, left = hashes & self.mask, np.arange(len(hashes))
        while len(left):
            free = left[self.hashes[slots[left]] == 0]
            self.hashes[slots[free]] = hashes[free]
            won = self.hashes[slots[left]] == hashes[left]
            self.starts[slots[left[won]]], self.counts[slots[left[won]]] = starts[left[won]], counts[left[won]]
            left = left[~won]
            slots[left] = (slots[left] + np.uint64(1)) & self.mask

    def ids_of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after the other, and how many ids each has."""
        counts = self.counts[places].astype(np.int64)
        before = np.cumsum(counts) - counts
        return self.ids[np.repeat(self.starts[places] - before, counts) + np.arange(int(counts.sum()))], counts


@lru_cache
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte, and the powers of an odd base and of its inverse modulo 2**64."""
    random = np.random.default_rng(20_240_604)
    base = int(random.integers(0, 2**64, dtype=np.uint64)) | 1
    powers, inverse = np.ones(BATCH, np.uint64), np.ones(BATCH, np.uint64)
    powers[1:], inverse[1:] = np.uint64(base), np.uint64(pow(base, -1, 2**64))
    return random.integers(0, 2**64, 256, dtype=np.uint64), np.cumprod(powers), np.cumprod(inverse)


class TextEncoder:
    """Encodes texts; each distinct word only once.

    A text is cut at single spaces and line breaks that no other white space precedes or follows: there, the split pattern
    always cuts, whatever stands around. The words between are hashed and looked up all at once. Texts with
    other white space next to a cut are split by the pattern as a whole. ``encode_chunks`` gives the ids of some words, one
    after the other, and how many each has.
    """

    def __init__(self, encode_chunks: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], special: dict[str, int], split: Callable[[str], list[str]]):
        self.encode_chunks, self.split, self.special = encode_chunks, split, special
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.known = WordTable()
        self.pieces: dict[str, bytes] = {}
        self.line_break = self.encode_chunks(["\n"])[0]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        plain: list[tuple[list[bytes], int, bytes]] = []
        size = 0
        for held, text in zip(out, texts):
            for part in self._parts(text):
                if part in self.special:
                    held.append(np.array([self.special[part]], "<u4").tobytes())
                    continue
                for piece in _cut(part):
                    data = piece.encode()
                    if not _is_plain(piece) or len(data) + 2 > BATCH:
                        held.append(self._encode_pieces(self.split(piece)))
                        continue
                    if size + len(data) + 2 > BATCH:
                        self._encode_plain(plain)
                        plain, size = [], 0
                    held.append(b"")
                    plain.append((held, len(held) - 1, data))
                    size += len(data) + 1
        self._encode_plain(plain)
        return [b"".join(held) for held in out]

    def _parts(self, text: str) -> list[str]:
        if self.at_special is None or not self.at_special.search(text):
            return [text]
        return self.at_special.split(text)

    def _encode_pieces(self, pieces: list[str]) -> bytes:
        unknown = [p for p in set(pieces) if p not in self.pieces]
        if len(self.pieces) + len(unknown) > REMEMBER // 8:
            self.pieces.clear()
            unknown = list(set(pieces))
        if unknown:
            ids, counts = self.encode_chunks(unknown)
            ends = np.cumsum(counts).tolist()
            self.pieces |= zip(unknown, (ids[e - n : e].astype("<u4").tobytes() for e, n in zip(ends, counts.tolist())))
        return b"".join(map(self.pieces.__getitem__, pieces))

    def _encode_plain(self, plain: list[tuple[list[bytes], int, bytes]]) -> None:
        """Puts the ids of each text in its place. Null characters separate the texts, which hold none."""
        if not plain:
            return
        data = b"\0" + b"\0".join(x for _, _, x in plain) + b"\0"
        every = np.frombuffer(data, np.uint8)
        cuts = np.flatnonzero((every == 32) | (every == 10) | (every == 0))
        starts, ends, before = cuts[:-1] + 1, cuts[1:], every[cuts[:-1]]
        of_byte, powers, inverse = _powers()
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(of_byte[every] * powers[: len(every)])])
        hashes = (sums[ends] - sums[starts]) * inverse[starts]
        hashes = mix(mix(hashes + (ends - starts).astype(np.uint64)) + (before == 32)) | np.uint64(1)
        empty = ends == starts

        places = self.known.find(hashes)
        new = np.flatnonzero((places < 0) & ~empty)
        if len(new):
            distinct, first = np.unique(hashes[new], return_index=True)
            if self.known.n + len(distinct) > REMEMBER:
                self.known.clear()
                new = np.flatnonzero(~empty)
                distinct, first = np.unique(hashes[new], return_index=True)
            at = new[first]
            words = [data[a - b : e].decode() for a, e, b in zip(starts[at].tolist(), ends[at].tolist(), (before[at] == 32).tolist())]
            self.known.add(distinct, *self.encode_chunks(words))
            places = self.known.find(hashes)

        # A line break before a word is one more piece, with the id or ids of the line break.
        ids, counts = self.known.ids_of(places[~empty])
        of_word = np.zeros(len(starts), np.int64)
        of_word[~empty] = counts
        breaks = np.flatnonzero(before == 10)
        if len(breaks):
            at = (np.cumsum(of_word) - of_word)[breaks]
            ids = np.insert(ids, np.repeat(at, len(self.line_break)), np.tile(self.line_break, len(breaks)))
            of_word[breaks] += len(self.line_break)
        ids = ids.astype("<u4", copy=False)
        last = np.cumsum(of_word)[np.flatnonzero(every[ends] == 0)].tolist()
        for (held, place, _), a, b in zip(plain, [0, *last[:-1]], last):
            held[place] = ids[a:b].tobytes()


#: White space after a space or line break, or one of them at the end.
_NOT_PLAIN = re.compile(r"[ \n]\s|[ \n]\Z")
#: White space other than space and line break: rare, and looked for faster than the above.
_ODD = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def _is_plain(text: str) -> bool:
    """Whether the text can be split word by word: a space starts a word, a line break is one."""
    if "\0" in text or any(x in text for x in ("  ", " \n", "\n ", "\n\n")) or text[-1:] in (" ", "\n"):
        return False
    return not (any(c in text for c in _ODD) and _NOT_PLAIN.search(text))


def _cut(text: str) -> Iterator[str]:
    """The text in pieces of about PIECE characters, cut before single spaces between other characters."""
    start = 0
    while len(text) - start > PIECE:
        cut = re.compile(r"(?<=\S) (?=\S)").search(text, start + PIECE)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def splitter(path: str) -> Callable[[str], list[str]]:
    """Splits a text by the pattern; by the library's own splitter where Unicode versions could differ."""
    from tokenizers import Tokenizer

    by_library = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str

    def split(text: str) -> list[str]:
        if _OTHER_BLOCKS.search(text):
            return [text[a:b] for _, (a, b) in by_library(text)]
        return SPLIT.findall(text)

    return split


@lru_cache(maxsize=2)
def trie_encoder(path: str) -> TextEncoder:
    vocabulary_, split = vocabulary(path), splitter(path)

    def encode_chunks(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = [[w.encode() for w in split(c)] for c in chunks]
        ids = vocabulary_.encode_words({w for ws in words for w in ws})
        found = [b"".join([ids[w] for w in ws]) for ws in words]
        return np.frombuffer(b"".join(found), "<u4"), np.array([len(x) // 4 for x in found])

    return TextEncoder(encode_chunks, vocabulary_.special, split)


def encode_documents(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit) and ``decoded``, the text read back.

    Special tokens in a text count as such. A null text is empty and has no ids; repeated rows and null ids stay as
    they are; an empty table gives no rows; other columns are ignored. Nothing is shuffled. A Python worker
    remembers the encodings of a bounded number of words.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, words = trie_encoder(tokenizer_path), vocabulary(tokenizer_path)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            for start, end in text_slices(texts):
                ids = encoder.encode_all(texts.slice(start, end - start).to_pylist())
                decoded = (words.decode(x).decode("utf-8", "replace") for x in ids)
                yield _record_batch(zip(doc_ids.slice(start, end - start).to_pylist(), (len(x) // 4 for x in ids), ids, decoded))

    return id_and_text(docs, id_column, text_column).mapInArrow(
        encode, "doc_id long, n_tokens long, ids binary, decoded string"
    )


def _record_batch(rows: Iterable[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.binary(), pa.string())
    names = ("doc_id", "n_tokens", "ids", "decoded")
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
