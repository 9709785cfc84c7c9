"""Quality classifier by importance resampling.

Two generative models of hashed n-grams are counted: one of the target text (documents labelled good and not toxic), one
of all raw text. A document's importance weight is the ratio of its probabilities under both. Documents are then drawn
without replacement in proportion to their weights, by the Gumbel top-k trick: log weight plus Gumbel noise, the k
largest stay.

A third and a fourth model judge toxicity: in how many documents labelled toxic, and in how many labelled not toxic, each hashed
word occurs. A document is as toxic as its TOXIC_WORDS most telling words, however long it is; documents above the
cut have no chance to be drawn.

The raw model counts every document, and so does the search for the k-th largest. The other models are fitted on at most
TARGET_SAMPLE labelled documents of each kind, whose ids can so be broadcast: no text is shuffled. Only the models come to the
driver: BUCKETS or WORD_BUCKETS numbers each, whatever the input.
"""

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratalake.llm.common import SplitTexts, hash_ranges, id_and_text, mix, text_slices, uniform
from stratalake.sources.scratch import stage

BUCKETS = 1 << 16
#: Labelled documents of each kind that are counted at most: those with the smallest hash of their id.
TARGET_SAMPLE = 200_000
#: The target model starts from the raw one, as if it had seen so many n-grams of each bucket where the raw model would expect
#: them. Rarely seen buckets so tell little.
PRIOR = 5.0
#: Share of the target documents whose weight lies above the cut that sets the number of kept documents.
TARGET_KEPT = 0.995
#: Buckets of the words that tell toxic documents. Single words matter here, so few of them may share a bucket.
WORD_BUCKETS = 1 << 20
#: Words of a document whose log ratios add up to its toxicity: those with the largest ones.
TOXIC_WORDS = 3
#: Documents that a word is taken to have been seen in besides those counted, in both models alike.
WORD_PRIOR = 1.0
#: Share of the target documents that may lie above the cut for toxicity.
CLEAN_LOST = 0.005
#: Kinds of labelled documents: good and not toxic, toxic, neither.
TARGET, TOXIC, OTHER = 1, 2, 3
#: Bins of one round of the search for the k-th largest key, and keys that may come to the driver at its end.
SEARCH_BINS = 4096


_CLASSES = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b
    for b in range(256)
)
_CLASS_OF = np.frombuffer(_CLASSES, np.uint8)
_IS_PUNCTUATION = np.isin(np.arange(256), list(string.punctuation.encode()))


def _shape_hashes(texts: SplitTexts) -> np.ndarray:
    """Hash of each word's shape: letters as A or a, digits as 0, runs of the same character as one."""
    classes = _CLASS_OF[texts.bytes]
    # A word follows white space, so its first character is never the one before.
    new = np.r_[True, classes[1:] != classes[:-1]]
    place = np.cumsum(new) - 1
    starts, last = place[texts.starts], place[texts.starts + texts.lengths - 1]
    return mix(hash_ranges(classes[new].tobytes() + bytes(8), starts, last - starts + 1))


def _plain_hashes(texts: SplitTexts) -> np.ndarray:
    """Hash of each word with A-Z in lower case and without punctuation around it, unless it is nothing else."""
    letters = np.flatnonzero(~_IS_PUNCTUATION[texts.bytes])
    ends = texts.starts + texts.lengths
    first, after = np.searchsorted(letters, texts.starts), np.searchsorted(letters, ends)
    some = after > first
    starts = np.where(some, letters[np.minimum(first, len(letters) - 1)], texts.starts)
    stops = np.where(some, letters[after - 1] + 1, ends)
    return mix(hash_ranges(texts.joined.lower(), starts, stops - starts) + np.uint64(1))


class Ngrams:
    """Buckets of the n-grams of some texts: words, word pairs, word shapes, pairs of shapes, and whether a word repeats the one before;
    and, apart, the buckets of their distinct words."""

    def __init__(self, texts: list[bytes]) -> None:
        self.texts = SplitTexts(texts)

    def buckets(self) -> list[np.ndarray]:
        """Text by text."""
        words, shapes = self.texts.hashes(), _shape_hashes(self.texts)
        # Of the whole slice; the pair of the last word of a text and the first of the next is left out below.
        after = [np.r_[x[1:], np.zeros(1, np.uint64)][: len(x)] for x in (words, shapes)]
        pairs = [mix(x * np.uint64(3) + y + np.uint64(i)) for i, (x, y) in enumerate(zip((words, shapes), after))]
        again = mix((words == after[0]).astype(np.uint64))
        own, paired = ([(x % np.uint64(BUCKETS)).astype(np.int64) for x in some] for some in ((words, shapes), (*pairs, again)))
        out = []
        for a, b in zip(self.texts.bounds[:-1].tolist(), self.texts.bounds[1:].tolist()):
            out.append(np.concatenate([*[x[a:b] for x in own], *[x[a : max(a, b - 1)] for x in paired]]))
        return out

    def distinct_words(self) -> list[np.ndarray]:
        places = (_plain_hashes(self.texts) % np.uint64(WORD_BUCKETS)).astype(np.int64)
        return [np.unique(x) for x in self.texts.by_text(places)]


class Models:
    """What is counted: n-grams of all rows and of the target, and rows that hold a word among the toxic and the clean ones."""

    def __init__(self) -> None:
        self.raw, self.target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        self.toxic, self.clean = np.zeros(WORD_BUCKETS, np.int32), np.zeros(WORD_BUCKETS, np.int32)
        self.n_toxic = self.n_clean = 0


def count_ngrams(texts: DataFrame) -> Models:
    """Counts over all rows of (``text`` binary, ``label``). A task sends BUCKETS and WORD_BUCKETS rows at most, and
    as many sums come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Models()
        for batch in batches:
            for start, end in text_slices(batch.column(0), 1_000_000):
                texts, labels = (batch.column(i).slice(start, end - start).to_pylist() for i in (0, 1))
                found = Ngrams(texts).buckets()
                own.raw += np.bincount(np.concatenate(found), minlength=BUCKETS)
                good = [x for x, label in zip(found, labels) if label == TARGET]
                if good:
                    own.target += np.bincount(np.concatenate(good), minlength=BUCKETS)
                known = [(text, label) for text, label in zip(texts, labels) if label is not None]
                for words, (_, label) in zip(Ngrams([text for text, _ in known]).distinct_words(), known):
                    (own.toxic if label == TOXIC else own.clean)[words] += 1
                own.n_toxic += labels.count(TOXIC)
                own.n_clean += labels.count(TARGET) + labels.count(OTHER)
        # The numbers of rows go where no bucket is.
        words = [np.r_[own.toxic, own.n_toxic].astype(np.int64), np.r_[own.clean, own.n_clean].astype(np.int64)]
        for of_words, (x, y) in ((False, (own.raw, own.target)), (True, words)):
            seen = np.flatnonzero(x + y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seen), of_words)), *(pa.array(c) for c in (seen, x[seen], y[seen]))],
                ["of_words", "bucket", "x", "y"],
            )

    counted = texts.mapInArrow(count, "of_words boolean, bucket long, x long, y long")
    sums = counted.groupBy("of_words", "bucket").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).toArrow()
    of_words, bucket, x, y = (c.to_numpy() for c in sums.columns)
    models = Models()
    ngrams, words, rows = ~of_words, of_words & (bucket < WORD_BUCKETS), of_words & (bucket == WORD_BUCKETS)
    models.raw[bucket[ngrams]], models.target[bucket[ngrams]] = x[ngrams], y[ngrams]
    models.toxic[bucket[words]], models.clean[bucket[words]] = x[words], y[words]
    models.n_toxic, models.n_clean = int(x[rows].sum()), int(y[rows].sum())
    return models


def log_ratio(buckets: np.ndarray, target: np.ndarray, raw: np.ndarray, is_target: bool) -> float:
    """Log of target over raw probability of a text. Its own n-grams are taken out of the counts that hold them: the
    raw ones, and those of the target if it belongs there."""
    if not len(buckets) or not target.any():
        return 0.0
    at, n = np.unique(buckets, return_counts=True)
    of_raw = np.maximum(raw[at] - n, 0) / max(raw.sum() - n.sum(), 1)
    own = n if is_target else np.zeros_like(n)
    expected = of_raw * max(target.sum() - own.sum(), 0)
    return float(n @ np.log((np.maximum(target[at] - own, 0) + PRIOR) / (expected + PRIOR)))


def toxic_ratio(words: np.ndarray, models: Models, label: int | None) -> float:
    """Sum of the TOXIC_WORDS largest log ratios of the share of toxic to that of clean documents that hold a word. The text itself
    is taken out of the counts that hold it."""
    own_toxic, own_clean = int(label == TOXIC), int(label in (TARGET, OTHER))
    n_toxic, n_clean = models.n_toxic - own_toxic, models.n_clean - own_clean
    if not len(words) or n_toxic <= 0 or n_clean <= 0:
        return 0.0
    expected = (models.clean[words] - own_clean) * (n_toxic / n_clean)
    ratios = np.log((models.toxic[words] - own_toxic + WORD_PRIOR) / (expected + WORD_PRIOR))
    return float(np.sort(ratios)[-TOXIC_WORDS:].sum())


def _labelled(labels: DataFrame, sample: int) -> DataFrame:
    """``doc_id, label``: ``sample`` documents of each kind at most. Of several labels of a document the worst counts."""
    kind = F.when(F.col("toxic") == 1, TOXIC).when(F.col("toxic") == 0, F.when(F.col("quality") == 1, TARGET).otherwise(OTHER))
    worst = (
        labels.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    )
    every = stage(worst.select(F.col("doc_id").cast("long").alias("doc_id"), kind.alias("label")), "importance_labels")
    some = [every.where(F.col("label") == x).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for x in (TARGET, TOXIC, OTHER)]
    return stage(some[0].union(some[1]).union(some[2]), "importance_target")


def importance(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = TARGET_SAMPLE
) -> DataFrame:
    """One row per input row: ``doc_id, text_hash, is_target, n_ngrams, log_weight, toxic_ratio``, stored in the scratch folder.

    The target are documents whose labels say quality 1 and toxic 0 (a null toxic counts as 0), ``sample`` at most. No
    document is weighed by its own n-grams, or those of the target would weigh more than others alike. Without a
    target, and for texts without words, the log weight is 0. ``toxic_ratio`` compares documents labelled toxic with
    those labelled not toxic, ``sample`` at most of each kind; without one of them, and for texts without words, it is 0.
    """
    # The sample is bounded by a parameter, so it can be broadcast.
    labelled = F.broadcast(_labelled(labels, sample))
    texts = id_and_text(docs, id_column, text_column).join(labelled, "doc_id", "left")
    texts = texts.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.col("label") == TARGET, F.lit(False)).alias("is_target"),
        F.col("text").cast("binary").alias("text"),
        "label",
    )
    models = count_ngrams(texts.select("text", "label"))
    raw, target = models.raw.astype(float), models.target.astype(float)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in text_slices(batch.column(3), 1_000_000):
                rows = batch.slice(start, end - start)
                ngrams = Ngrams(rows.column(3).to_pylist())
                found = ngrams.buckets()
                ratios = [log_ratio(x, target, raw, own) for x, own in zip(found, rows.column(2).to_pylist())]
                labelled = zip(ngrams.distinct_words(), rows.column(4).to_pylist())
                toxic = [toxic_ratio(words, models, label) for words, label in labelled]
                yield pa.RecordBatch.from_arrays(
                    [
                        *rows.columns[:3],
                        pa.array([len(x) for x in found], pa.int64()),
                        pa.array(ratios, pa.float64()),
                        pa.array(toxic, pa.float64()),
                    ],
                    ["doc_id", "text_hash", "is_target", "n_ngrams", "log_weight", "toxic_ratio"],
                )

    schema = "doc_id long, text_hash long, is_target boolean, n_ngrams long, log_weight double, toxic_ratio double"
    return stage(texts.mapInArrow(weigh, schema), "importance")


def kth_largest(rows: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a column, exactly: the range that holds it is cut into bins again and again."""
    values = rows.select(F.col(column).alias("v")).where("v is not null")
    low, high, n = values.agg(F.min("v"), F.max("v"), F.count("v")).first()
    if not n or k >= n:
        return low if low is not None else float("-inf")
    rank = k
    while low < high and n > SEARCH_BINS:
        width = (high - low) / SEARCH_BINS
        if not low + width > low:
            break
        place = F.least(F.floor((F.col("v") - low) / width), F.lit(SEARCH_BINS - 1))
        inside = values.where(F.col("v").between(low, high))
        bins = inside.groupBy(place.alias("b")).agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        for row in sorted(bins.collect(), key=lambda r: -r["b"]):
            if rank <= row["n"]:
                low, high, n = row["low"], row["high"], row["n"]
                break
            rank -= row["n"]
    if low == high:
        return low
    # Few rows, or a range that cannot be cut, in which there are few different values.
    found = values.where(F.col("v").between(low, high)).groupBy("v").agg(F.count("v").alias("n")).collect()
    for row in sorted(found, key=lambda r: -r["v"]):
        if rank <= row["n"]:
            return row["v"]
        rank -= row["n"]
    return low


def resample(
    docs: DataFrame,
    labels: DataFrame,
    k: int | None = None,
    seed: int = 42,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, text_hash, n_ngrams, log_weight, toxic_ratio, key, kept``.

    Toxic documents are rejected first: those whose ``toxic_ratio`` is larger than that of all but ``CLEAN_LOST`` of the target.
    Their ``key`` is minus infinity, and they are not kept even if fewer than ``k`` others are left.

    ``key`` is else the log weight plus Gumbel noise; the ``k`` largest keys are kept, and rows that tie with the k-th, such as repeated
    rows. Without ``k`` it is the number of documents that are not rejected and weigh at least as much as all but the lightest
    ``1 - TARGET_KEPT`` of the target; without a target, all, and none is rejected. Noise depends on id and text only, so reruns
    agree. Rows with null ids take part; an empty table gives no rows; other columns are ignored.
    """
    weighed = importance(docs, labels, id_column, text_column)
    of_target = weighed.where("is_target")
    n_target = of_target.count()
    most = kth_largest(of_target, "toxic_ratio", int(n_target * CLEAN_LOST) + 1) if n_target else float("inf")
    toxic = F.col("toxic_ratio") > most
    u = uniform(F.lit(seed), F.col("doc_id"), F.col("text_hash"))
    keyed = weighed.withColumn("key", F.when(toxic, F.lit(float("-inf"))).otherwise(F.col("log_weight") - F.log(-F.log(u))))
    if k is None:
        if n_target:
            cut = kth_largest(of_target, "log_weight", max(1, round(n_target * TARGET_KEPT)))
            k = weighed.where((F.col("log_weight") >= cut) & ~toxic).count()
        else:
            k = weighed.count()
    least = kth_largest(keyed.where(~toxic), "key", k) if k > 0 else float("inf")
    kept = (F.col("key") >= least) & ~toxic
    return keyed.select("doc_id", "text_hash", "n_ngrams", "log_weight", "toxic_ratio", "key", kept.alias("kept"))
