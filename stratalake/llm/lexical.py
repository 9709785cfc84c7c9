"""Ranked lexical search by the Best Position Algorithm.

Texts are cut into terms once. What is kept of a document is its length and how often the asked terms occur in it, so a search reads no text
a second time. Tasks take documents in shards of bounded size. In a shard each term has its impact list: the documents that hold the term,
by falling share of the score, and a way to look a document up in it. For an item, the lists of its terms are read from the top in
parallel. Each document that is met is looked up in all lists, so its score is complete, and *all* places where it was found count as
seen. A list's best position is the last one up to which all are seen. No unseen document can score more than the impacts at
the best positions add up to; as soon as that is strictly below the score of the k-th document so far, the item is done. (At an equal
score a smaller id could still come.) A task carries the k best from shard to shard, so later shards stop sooner.
"""

from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stratalake.sources.scratch import stage

#: All ASCII characters but digits and letters separate terms.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A pass over the documents serves items with so many terms together. One item is not split.
PASS_TERMS = 500_000
#: A shard is full with so many documents, or documents and terms.
SHARD_DOCUMENTS, SHARD_ENTRIES = 32_768, 2_000_000
#: How many places of each list are read at first, and at most, before the stopping rule is asked again.
FIRST_READ, LAST_READ = 16, 2048

_NO_TERM = bytes(c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122))
_CLEAN = bytes.maketrans(_NO_TERM + bytes(range(65, 91)), b" " * len(_NO_TERM) + bytes(range(97, 123)))

_HIT = "doc_id long, length long, terms array<int>, counts array<int>"
_HIT_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("length", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))]
)
_BEST = "item int, doc_id long, score long, accesses long"
_BEST_ARROW = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64()), ("accesses", pa.int64())])


def split_terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, A-Z in lower case."""
    return text.translate(_CLEAN).split()


def term_weights(documents: int, frequencies: Mapping[int, int]) -> dict[int, int]:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) by term."""
    return {t: int(np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1)))) for t, df in frequencies.items()}


def impacts(weight: np.ndarray, count: np.ndarray, damping: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * count) // (1000 * count + 8 * damping))


@dataclass
class ImpactList:
    """The documents of a shard that hold a term. ``by_rank`` lists places in the other arrays, best impact first."""

    documents: np.ndarray
    impact: np.ndarray
    by_rank: np.ndarray
    rank: np.ndarray

    @classmethod
    def of(cls, documents: np.ndarray, impact: np.ndarray) -> "ImpactList":
        by_rank = np.argsort(-impact, kind="stable")
        rank = np.empty_like(by_rank)
        rank[by_rank] = np.arange(len(by_rank))
        return cls(documents, impact, by_rank, rank)


class _Cursor:
    """How far an impact list has been read for one item."""

    def __init__(self, of: ImpactList) -> None:
        self.list, self.read, self.best = of, 0, 0
        self.seen = np.zeros(len(of.documents), bool)

    def next_documents(self, n: int) -> np.ndarray:
        places = self.list.by_rank[self.read : self.read + n]
        self.seen[self.read : self.read + n] = True
        self.read = min(self.read + n, len(self.seen))
        return self.list.documents[places]

    def look_up(self, documents: np.ndarray) -> np.ndarray:
        """The impacts of the documents, 0 where the term does not occur. Marks their places."""
        at = np.minimum(np.searchsorted(self.list.documents, documents), len(self.seen) - 1)
        found = self.list.documents[at] == documents
        self.seen[self.list.rank[at[found]]] = True
        return np.where(found, self.list.impact[at], 0)

    def limit(self) -> int:
        """The impact at the best position, and 0 once all is seen: no unseen document has more."""
        if self.best < len(self.seen):
            ahead = self.seen[self.best :]
            step = int(np.argmin(ahead))
            self.best = len(self.seen) if ahead[step] else self.best + step
        if self.best >= len(self.seen):
            return 0
        return int(self.list.impact[self.list.by_rank[max(self.best - 1, 0)]])


class Best:
    """The k best documents so far: higher score, then smaller id, no id last."""

    def __init__(self, k: int) -> None:
        self.k, self.rows = k, []

    def add(self, ids: list, scores: np.ndarray) -> None:
        if len(self.rows) >= self.k:
            worth = np.flatnonzero(scores >= -self.rows[-1][0])
        else:
            worth = np.flatnonzero(scores > 0)
        self.rows += [(-int(scores[i]), ids[i] is None, ids[i] or 0) for i in worth]
        self.rows = sorted(self.rows)[: self.k]

    def beats(self, limit: int) -> bool:
        """Can no document of at most this score come in? An equal one might, by its id."""
        return limit <= 0 or (len(self.rows) >= self.k and -self.rows[-1][0] > limit)

    def documents(self) -> Iterator[tuple[int | None, int]]:
        for score, no_id, doc_id in self.rows:
            yield (None if no_id else doc_id), -score


def best_positions(lists: list[ImpactList], ids: list, best: Best) -> int:
    """Searches a shard: ``ids`` are the document ids by place. Returns how many places of lists were read in order."""
    cursors = [_Cursor(x) for x in lists]
    scored = np.zeros(len(ids), bool)
    width = FIRST_READ
    while cursors:
        fresh = np.unique(np.concatenate([c.next_documents(width) for c in cursors]))
        fresh = fresh[~scored[fresh]]
        scored[fresh] = True
        if len(fresh):
            total = np.zeros(len(fresh), np.int64)
            for c in cursors:
                total += c.look_up(fresh)
            best.add([ids[i] for i in fresh.tolist()], total)
        if best.beats(sum(c.limit() for c in cursors)):
            break
        width = min(2 * width, LAST_READ)
    return sum(c.read for c in cursors)


def search_terms(items: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """``item_id`` and ``term``, once each. Rows of one id (or of none) are one item; an item without terms has no row."""
    lowered = F.translate(F.col(text_column), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.array_distinct(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0)))
    return items.select(F.col(id_column).alias("item_id"), F.explode(terms).alias("term")).distinct()


def lexical_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score`` (over 0).

    A document's score sums, over the item's terms, w * (10^9 tf div (1000 tf + 8 m)), with w = floor(1000 ln((2 N + 2) / (2 df + 1))) and
    m = 10 + 90 n N div L: tf is the term's count in the document, n the document's terms, N the documents with a term, L the terms of all,
    df the documents with the term. Equal scores go by smaller id; documents without id come last. Rows of one id are documents of
    their own, and so are copies. A null or empty text has no terms and is no document; an item without terms, or whose terms occur nowhere, has no
    row. Empty tables give none. Other columns are ignored.

    Texts are read once per ``PASS_TERMS`` terms of items, whatever their number, and never shuffled. One task holds a shard of at most
    ``SHARD_DOCUMENTS`` documents and hands on ``k`` rows per item.
    """
    spark = docs.sparkSession
    asked = stage(search_terms(items, item_column, item_text_column), "asked_terms")
    passes = 1 + asked.count() // PASS_TERMS
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    found = None
    for i in range(passes):
        part = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == i)
        best = _search_pass(spark, texts, part, k)
        found = best if found is None else found.unionByName(best)
    ranked = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )


def _search_pass(spark: SparkSession, texts: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    # At most PASS_TERMS rows, or one item's terms.
    pairs = asked.collect()
    term_of: dict[bytes, int] = {}
    item_of: dict = {}
    terms_of = defaultdict(list)
    for row in pairs:
        item = item_of.setdefault(row["item_id"], len(item_of))
        terms_of[item].append(term_of.setdefault(row["term"].encode(), len(term_of)))

    hits = stage(texts.mapInArrow(_counter(term_of), _HIT), "term_counts")
    totals = hits.agg(F.count(F.lit(1)), F.sum("length")).first()
    documents, length = totals[0], totals[1] or 0
    held = hits.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    weights = term_weights(documents, {r["term"]: r["n"] for r in held.collect()})

    tasks = max(spark.sparkContext.defaultParallelism, -(-documents // SHARD_DOCUMENTS))
    best = hits.coalesce(tasks).mapInArrow(_searcher(dict(terms_of), weights, documents, length, k), _BEST)
    type_of = asked.schema["item_id"].dataType.simpleString()
    ids = spark.createDataFrame([(n, i) for i, n in item_of.items()], f"item int, item_id {type_of}")
    return best.join(F.broadcast(ids), "item").select("item_id", "doc_id", "score")


def _counter(term_of: dict[bytes, int]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Length and asked terms of each text that has a term."""
        get = term_of.get
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = split_terms(text.as_py() or b"")
                if words:
                    counts = Counter(map(get, words))
                    counts.pop(None, None)
                    rows.append((doc_id, len(words), list(counts), list(counts.values())))
            if rows:
                columns = zip(zip(*rows, strict=True), _HIT_ARROW, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=_HIT_ARROW)

    return count


def _searcher(terms_of: dict[int, list[int]], weights: dict[int, int], documents: int, length: int, k: int):
    weight = np.zeros(1 + max(weights, default=0), np.int64)
    weight[list(weights)] = list(weights.values())

    def lists_of(terms: np.ndarray, counts: np.ndarray, places: np.ndarray, damping: np.ndarray) -> dict[int, ImpactList]:
        order = np.argsort(terms, kind="stable")
        terms, places = terms[order], places[order]
        impact = impacts(weight[terms], counts[order].astype(np.int64), damping[places])
        cuts = np.flatnonzero(np.diff(terms)) + 1
        starts = np.concatenate([[0], cuts]) if len(terms) else []
        return {
            int(terms[a]): ImpactList.of(places[a:b], impact[a:b]) for a, b in zip(starts, [*cuts.tolist(), len(terms)], strict=False)
        }

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {item: Best(k) for item in terms_of}
        read = Counter()
        for ids, lengths, terms, counts, per_document in _shards(batches):
            damping = np.array([10 + (90 * n * documents) // length for n in lengths], np.int64)
            lists = lists_of(terms, counts, np.repeat(np.arange(len(ids)), per_document), damping)
            for item, wanted in terms_of.items():
                read[item] += best_positions([lists[t] for t in wanted if t in lists], ids, best[item])
        rows = [(item, doc_id, score, read[item]) for item, b in best.items() for doc_id, score in b.documents()]
        for a in range(0, len(rows), 10_000):
            columns = zip(zip(*rows[a : a + 10_000], strict=True), _BEST_ARROW, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=_BEST_ARROW)

    return search


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Ids, lengths, all terms, all counts and the number of terms of each document, for documents up to the size of a shard."""
    held, documents, entries = [], 0, 0

    def joined() -> tuple:
        ids = [i for b in held for i in b.column("doc_id").to_pylist()]
        lengths = [n for b in held for n in b.column("length").to_pylist()]
        terms, counts = (
            np.concatenate([b.column(c).flatten().to_numpy(zero_copy_only=False) for b in held]) for c in ("terms", "counts")
        )
        per = np.concatenate([b.column("terms").value_lengths().to_numpy(zero_copy_only=False) for b in held])
        return ids, lengths, terms, counts, per

    for batch in batches:
        for a in range(0, batch.num_rows, 2048):
            held.append(piece := batch.slice(a, 2048))
            documents += piece.num_rows
            entries += len(piece.column("terms").flatten())
            if documents >= SHARD_DOCUMENTS or entries >= SHARD_ENTRIES:
                yield joined()
                held, documents, entries = [], 0, 0
    if held:
        yield joined()
