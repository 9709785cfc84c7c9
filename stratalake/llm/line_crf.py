"""Quality rules with a linear-chain conditional random field over lines.

Each line of a document is content or boilerplate. A line has yes/no features (its look, its repetition, its neighbours'
label through the chain); Viterbi decoding finds the most likely labels of all lines together, and the share of words in
content lines decides whether the document stays.

The model is trained here, on a bounded sample of labelled documents. Lines of documents labelled bad count as boilerplate. So do lines of
documents labelled good that are not their own: lines that the document repeats, and lines that several documents of the sample share
which have little else in common. All other lines of good documents count as content. So the chain sees both labels in one document, and
learns how they follow each other.
"""

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from stratalake.llm.common import id_and_text, text_slices

#: Labelled documents that training reads at most: those with the smallest hash of their id.
SAMPLE = 2_000
#: Long documents train as pieces of so many lines; decoding sees whole documents.
TRAIN_LINES = 40
CONTENT_SHARE = 0.5
#: A line of so many documents is boilerplate, if no two of them share more than this part of the lines of the shorter one.
SHARED_DOCUMENTS, SHARED_PART = 3, 0.5

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 3, 50, 50

LABELS = ("content", "boilerplate")
FEATURES = (
    "bias",
    "empty",
    "repeated line",
    "under 4 words",
    "over 12 words",
    "symbols over 2 %",
    "symbols over 10 %",
    "capitals over 30 %",
    "capitals over 70 %",
    "digits over 20 %",
    "exclamations over 3 %",
    "distinct words under 70 %",
    "distinct words under 40 %",
    "same word in a row",
    "ends a sentence",
    "starts with a capital",
    "link",
)


def split_lines(text: bytes) -> list[bytes]:
    return text.split(b"\n")


_UPPER, _LOWER = (bytes(range(a, a + 26)) for a in (65, 97))
_DIGITS = b"0123456789"


def _share(text: bytes, kept: bytes) -> float:
    return 1 - len(text.translate(None, kept)) / len(text)


def line_features(lines: list[bytes]) -> np.ndarray:
    """One row of 0/1 per line, in the order of FEATURES."""
    out = np.zeros((len(lines), len(FEATURES)), np.float32)
    seen: set[bytes] = set()
    for i, line in enumerate(lines):
        words = line.split()
        if not words:
            out[i, :2] = 1
            continue
        body = b"".join(words)
        distinct = len(set(words)) / len(words)
        symbols = _share(body, SYMBOLS.encode())
        upper, lower = _share(body, _UPPER), _share(body, _LOWER)
        capitals = upper / (upper + lower) if upper + lower else 0.0
        out[i] = (
            1,
            0,
            line in seen,
            len(words) < 4,
            len(words) > 12,
            symbols > 0.02,
            symbols > 0.1,
            capitals > 0.3,
            capitals > 0.7,
            _share(body, _DIGITS) > 0.2,
            _share(body, b"!") > 0.03,
            distinct < 0.7 and len(words) >= 10,
            distinct < 0.4 and len(words) >= 10,
            any(a == b for a, b in zip(words, words[1:])),
            body[-1:] in b".?!",
            body[:1] in _UPPER,
            b"://" in line or b"www." in line,
        )
        seen.add(line)
    return out


class LineCrf:
    """Weights of a chain with two labels: ``state`` (features x labels), ``step`` (label before x label)."""

    def __init__(self, state: np.ndarray, step: np.ndarray):
        self.state, self.step = state, step

    def decode(self, features: np.ndarray) -> np.ndarray:
        """Viterbi: whether each line is boilerplate, in the most likely labelling of all lines."""
        scores = (features @ self.state).tolist()
        (cc, cb), (bc, bb) = self.step.tolist()
        if not scores:
            return np.zeros(0, bool)
        best_c, best_b = scores[0]
        back: list[tuple[bool, bool]] = []
        for c, b in scores[1:]:
            from_b = (best_b + bc > best_c + cc, best_b + bb > best_c + cb)
            best_c, best_b = (
                c + (best_b + bc if from_b[0] else best_c + cc),
                b + (best_b + bb if from_b[1] else best_c + cb),
            )
            back.append(from_b)
        out = np.empty(len(scores), bool)
        out[-1] = best_b > best_c
        for i in range(len(scores) - 2, -1, -1):
            out[i] = back[i][int(out[i + 1])]
        return out


def train(sequences: list[tuple[np.ndarray, np.ndarray]], rounds: int = 150, rate: float = 0.15, decay: float = 1e-3) -> LineCrf:
    """Maximum likelihood by gradient ascent (Adam); gradients are observed minus expected feature counts.

    Without sequences of both labels, nothing can be learnt and every line is content.
    """
    n_features = len(FEATURES)
    if len({bool(y) for _, labels in sequences for y in labels}) < 2:
        return LineCrf(np.zeros((n_features, 2)), np.zeros((2, 2)))
    longest = max(len(y) for _, y in sequences)
    x = np.zeros((len(sequences), longest, n_features))
    y = np.zeros((len(sequences), longest), int)
    lengths = np.array([len(labels) for _, labels in sequences])
    for i, (features, labels) in enumerate(sequences):
        x[i, : len(labels)], y[i, : len(labels)] = features, labels
    here = np.arange(longest) < lengths[:, None]
    next_too = here[:, 1:]
    gold = np.eye(2)[y] * here[..., None]
    seen_state = np.einsum("slf,slk->fk", x, gold)
    seen_step = np.einsum("slj,slk->jk", gold[:, :-1], gold[:, 1:])

    weights = np.zeros(n_features * 2 + 4)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for n in range(1, rounds + 1):
        state, step = weights[:-4].reshape(n_features, 2), weights[-4:].reshape(2, 2)
        node, edge = _marginals(x @ state, step, lengths, here, next_too)
        gradient = np.concatenate(
            [(seen_state - np.einsum("slf,slk->fk", x, node)).ravel(), (seen_step - edge).ravel()]
        ) / len(sequences) - decay * weights
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        weights = weights + rate * (mean / (1 - 0.9**n)) / (np.sqrt(square / (1 - 0.99**n)) + 1e-8)
    return LineCrf(weights[:-4].reshape(n_features, 2), weights[-4:].reshape(2, 2))


def _marginals(
    scores: np.ndarray, step: np.ndarray, lengths: np.ndarray, here: np.ndarray, next_too: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all sequences at once: label probabilities by line, summed probabilities by step."""
    n, longest, _ = scores.shape
    forward, backward = np.empty_like(scores), np.zeros_like(scores)
    forward[:, 0] = scores[:, 0]
    for i in range(1, longest):
        forward[:, i] = scores[:, i] + np.logaddexp(forward[:, i - 1, :1] + step[0], forward[:, i - 1, 1:] + step[1])
    for i in range(longest - 2, -1, -1):
        ahead = scores[:, i + 1] + backward[:, i + 1]
        moved = np.logaddexp(ahead[:, :1] + step[:, 0], ahead[:, 1:] + step[:, 1])
        backward[:, i] = np.where(next_too[:, i, None], moved, 0.0)
    total = np.logaddexp(*forward[np.arange(n), lengths - 1].T)
    node = np.exp(forward + backward - total[:, None, None]) * here[..., None]
    joint = (
        forward[:, :-1, :, None] + step + (scores[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
    )
    return node, (np.exp(joint) * next_too[..., None, None]).sum(axis=(0, 1))


def train_on_labels(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> LineCrf:
    """Fits the model on at most ``sample`` labelled documents (``doc_id``, ``quality`` 0 or 1; null labels are left out).

    The sample is spread by hash of the id; its features, not its texts, come to the driver. Repeated labels count once.
    """
    picked = (
        labels.where("quality in (0, 1) and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # The sample is bounded by a parameter, so it can be broadcast.
    texts = id_and_text(docs).join(F.broadcast(picked), "doc_id").select("doc_id", F.col("text").cast("binary"), F.col("quality").cast("long"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text, quality in zip(*(batch.column(i).to_pylist() for i in range(3))):
                lines = split_lines(text)
                packed = np.packbits(line_features(lines).astype(bool), axis=1).tobytes()
                hashes = np.array([xxhash.xxh3_64_intdigest(line.strip()) if line.strip() else 0 for line in lines], "<u8").tobytes()
                yield pa.RecordBatch.from_pydict({"doc_id": [doc_id], "quality": [quality], "packed": [packed], "hashes": [hashes]})

    featured = texts.mapInArrow(features, "doc_id long, quality long, packed binary, hashes binary")
    least = F.min(F.struct("packed", "hashes")).alias("least")
    rows = featured.groupBy("doc_id", "quality").agg(least).select("doc_id", "quality", "least.*").orderBy("doc_id").collect()
    hashes = [np.frombuffer(bytes(row["hashes"]), "<u8") for row in rows]
    labels_of = line_labels(hashes, [row["quality"] == 1 for row in rows])
    sequences = []
    width = (len(FEATURES) + 7) // 8
    for row, found in zip(rows, labels_of):
        bits = np.unpackbits(np.frombuffer(bytes(row["packed"]), np.uint8).reshape(-1, width), axis=1)[:, : len(FEATURES)]
        for start in range(0, len(bits), TRAIN_LINES):
            sequences.append((bits[start : start + TRAIN_LINES], found[start : start + TRAIN_LINES]))
    return train(sequences)


def line_labels(documents: list[np.ndarray], good: list[bool]) -> list[np.ndarray]:
    """0 (content) or 1 (boilerplate) for each line of some documents, given as line hashes, 0 for a line without words.

    Copies of a document, and near copies, count as one where lines are counted over documents: else all lines of a text that
    many documents hold would pass for boilerplate.
    """
    sets = [set(lines.tolist()) - {0} for lines in documents]
    holders: dict[int, list[int]] = defaultdict(list)
    for i, lines in enumerate(sets):
        for line in lines:
            holders[line].append(i)

    def alike(a: int, b: int) -> bool:
        return len(sets[a] & sets[b]) > SHARED_PART * min(len(sets[a]), len(sets[b]))

    def is_shared(line: int) -> bool:
        different: list[int] = []
        for i in holders[line]:
            if not any(alike(i, j) for j in different):
                different.append(i)
                if len(different) >= SHARED_DOCUMENTS:
                    return True
        return False

    shared = {line for line, of in holders.items() if len(of) >= SHARED_DOCUMENTS and is_shared(line)}
    out = []
    for lines, is_good in zip(documents, good):
        if not is_good:
            out.append(np.ones(len(lines), np.int64))
            continue
        count = Counter(lines.tolist())
        out.append(np.array([int(x != 0 and (count[x] > 1 or x in shared)) for x in lines.tolist()], np.int64))
    return out


# --- documents ---


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text."""
    words = text.split()
    body = b"".join(words)
    # Bytes 0x80 to 0xBF continue a character.
    word_chars = len(body.translate(None, bytes(range(0x80, 0xC0))))
    n_symbols = len(body) - len(body.translate(None, SYMBOLS.encode()))
    lines = [line for line in split_lines(text) if line.strip(b" \t\n\r\x0b\x0c")]
    return len(words), word_chars, n_symbols, len(lines) - len(set(lines)), _repeat_words(words)


def _repeat_words(words: list[bytes]) -> int:
    """Words inside runs of WINDOW words that occur at least twice in the text."""
    runs = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(runs)) == len(runs):
        return 0
    count = Counter(runs)
    total = covered_to = 0
    for i, run in enumerate(runs):
        if count[run] > 1:
            total += i + WINDOW - max(i, covered_to)
            covered_to = i + WINDOW
    return total


def content_share(text: bytes, model: LineCrf) -> float:
    """Share of the words that stand in content lines; 0 without words."""
    lines = split_lines(text)
    words = np.array([len(line.split()) for line in lines])
    if not words.sum():
        return 0.0
    return float(words[~model.decode(line_features(lines))].sum() / words.sum())


def quality_rules(
    docs: DataFrame,
    model: LineCrf,
    least_share: float = CONTENT_SHARE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id``, base counts, ``base_failed``, ``content_share``, ``kept``.

    A document is kept if it passes the base rules and at least ``least_share`` of its words stand in content lines. Null and
    empty texts have no words and fail. Repeated rows and null ids stay as they are; an empty table gives no rows; other
    columns are ignored. Nothing is shuffled; the model has a fixed size.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            for start, end in text_slices(texts):
                rows = []
                for text in texts.slice(start, end - start).to_pylist():
                    counts = base_counts(text)
                    n_words, n_repeat_words = counts[0], counts[-1]
                    failed = n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words
                    share = content_share(text, model)
                    rows.append((*counts, failed, share, not failed and share >= least_share))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)]
                yield pa.RecordBatch.from_arrays([doc_ids.slice(start, end - start), *columns], _NAMES)

    return (
        id_and_text(docs, id_column, text_column)
        .select("doc_id", F.col("text").cast("binary"))
        .mapInArrow(
            judge,
            "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "base_failed boolean, content_share double, kept boolean",
        )
    )


_TYPES = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
_NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept"]
