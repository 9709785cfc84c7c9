"""Near-duplicate documents by MinHash.

1. Documents with the same shingle set form a class; all work below is done once per class, so copies cost nothing.
2. A class has PERMUTATIONS minima of universal hash functions, cut into bands. Classes that agree in a band share a bucket.
3. Candidates of a bucket are compared with a pivot, not with each other: first by their signatures, then on full shingle
   sets. Links join classes to components.
4. What is left are pairs in a bucket whose components differ. Classes outside the largest component of a bucket are sent to it,
   in blocks, and compared there with its members and with each other on full sets. So every pair in a bucket is either
   compared or already joined by links, no bucket has a limit, and no pair becomes a row but a link.
5. Components come from alternating large-star and small-star.

At a similarity of 0.8, 30 bands of 5 miss one pair in 150,000; the signature filter less than one in a billion.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from stratalake.llm.common import WordHashes, id_and_text, mix, ngram_hashes
from stratalake.llm.components import connected_components
from stratalake.sources.scratch import stage

SHINGLE, PERCENT = 5, 80
BANDS, ROWS = 30, 5
PERMUTATIONS = BANDS * ROWS
#: Pairs whose signatures agree in fewer places cannot, for all practical purposes, reach the similarity asked for.
SLACK = 0.2
#: Size of the filter that keeps unwanted texts out of a shuffle.
FILTER_BUCKETS = 1 << 20
#: Classes of a component, and classes sent to it, that one task compares at a time.
BLOCK = 512


def shingle_set(text: bytes, n: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``n`` words, A-Z in lower case; fewer words count as one run."""
    found = words.of(text.lower().split())
    if not len(found):
        return np.empty(0, np.uint64)
    return np.unique(ngram_hashes(found, min(n, len(found))) + np.uint64(min(n, len(found))))


@lru_cache
def _functions() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and addends of the universal hash functions ``(a * x + b) >> 32``."""
    random = np.random.default_rng(20_240_601)
    a, b = random.integers(0, 2**64, (2, PERMUTATIONS, 1), dtype=np.uint64)
    return a | np.uint64(1), b


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set."""
    a, b = _functions()
    out = np.full(PERMUTATIONS, 2**32, np.uint64)
    for start in range(0, len(shingles), 2048):
        part = shingles[None, start : start + 2048]
        np.minimum(out, ((a * part + b) >> np.uint64(32)).min(axis=1), out=out)
    return out


def bands(values: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in values.reshape(BANDS, ROWS).T:
        keys = mix(keys + column)
    return keys.view(np.int64)


def _signatures(texts: DataFrame, n: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, cls, bands, signature`` per row; without words, ``cls`` is null and nothing is hashed."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            sizes, classes, keys, signatures = [], [], [], []
            for text in batch.column(1):
                found = shingle_set(text.as_py(), n, words)
                sizes.append(len(found))
                if len(found):
                    values = minima(found)
                    classes.append(xxhash.xxh3_128_digest(found.tobytes()))
                    keys.append(bands(values).tolist())
                    signatures.append(values.astype("<u2").tobytes())
                else:
                    classes.append(None), keys.append(None), signatures.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(signatures, pa.binary()),
                ],
                ["doc_id", "text_hash", "n_shingles", "cls", "bands", "signature"],
            )

    return texts.select("doc_id", F.col("text").cast("binary"), "text_hash").mapInArrow(
        sign, "doc_id long, text_hash long, n_shingles long, cls binary, bands array<long>, signature binary"
    )


def _similar_signatures(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Signature verification of candidate pairs (``a, b``)."""
    least = int(PERMUTATIONS * (percent / 100 - SLACK))
    of = lambda side: classes.select(F.col("cls").alias(side), F.col("signature").alias(f"signature_{side}"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (
                    np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, PERMUTATIONS) for i in (2, 3)
                )
                yield batch.select([0, 1]).filter(pa.array((x == y).sum(axis=1) >= least))

    joined = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "signature_a", "signature_b")
    return joined.mapInArrow(compare, "a binary, b binary")


def _similar_sets(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Confirms pairs on their full shingle sets. Rows of the same ``a`` come together, so its set is made once."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last, set_a = WordHashes(), None, None
        for batch in batches:
            keep = []
            for a, text_a, text_b in zip(batch.column(0), batch.column(2), batch.column(3)):
                if a.as_py() != last:
                    last, set_a = a.as_py(), shingle_set(text_a.as_py(), n, words)
                set_b = shingle_set(text_b.as_py(), n, words)
                common = len(np.intersect1d(set_a, set_b, assume_unique=True))
                keep.append(100 * common >= percent * (len(set_a) + len(set_b) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    of = lambda side: texts.select(F.col("cls").alias(side), F.col("text").alias(f"text_{side}"))
    joined = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(compare, "a binary, b binary")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept, text_hash, root``.

    Two documents are linked if their sets share at least ``percent`` % of all their shingles. ``component_id`` is the smallest
    id that links reach from the document, itself included; ``kept`` says whether it is the document's own.
    Texts without words (null, empty, white space) are linked with nothing. Rows with the same id are documents of their own, so
    repeated rows are copies that share a component; all rows with its smallest id are kept. Rows without an
    id take part; their component is null, and they are kept, if it holds no id. ``root`` names the component whatever
    ids it holds; it is null for texts without words. An empty table gives no rows; other columns are ignored.
    """
    texts = id_and_text(docs, id_column, text_column).withColumn("text_hash", F.xxhash64("text"))
    signed = stage(_signatures(texts, shingle), "minhash_signatures")
    classes = stage(
        signed.where("cls is not null")
        .groupBy("cls")
        .agg(
            F.min(F.struct("doc_id", "text_hash")).alias("least"),
            F.first("bands").alias("bands"),
            F.first("signature").alias("signature"),
        )
        .select("cls", "least.doc_id", "least.text_hash", "bands", "signature"),
        "minhash_classes",
    )

    # Buckets with at least two classes, and the texts of their classes.
    rows = classes.select("cls", F.explode("bands").alias("bucket"))
    shared = stage(
        rows.groupBy("bucket").agg(F.count("cls").alias("n"), F.min("cls").alias("pivot")).where("n > 1"), "minhash_shared"
    )
    members = stage(rows.join(shared, "bucket").select("bucket", "cls", "pivot"), "minhash_members")
    near = members.where("cls <> pivot").select(F.col("pivot").alias("a"), F.col("cls").alias("b")).distinct()
    near = stage(_similar_signatures(near, classes, percent), "minhash_near")
    candidates = stage(_texts_of(members.select("cls").distinct(), classes, texts), "minhash_texts")
    links = stage(_similar_sets(near, candidates, shingle, percent), "minhash_links")

    roots = stage(connected_components(links), "minhash_roots")
    links = links.union(_cross_links(members, roots, candidates, shingle, percent))
    return _label(signed, connected_components(links))


def _texts_of(wanted: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """``cls, text`` (binary): for the wanted classes, the text of their document with the smallest id and hash.

    Most texts are not wanted. They are left out before the shuffle by a filter of bounded size: whether any wanted row falls
    in the same of FILTER_BUCKETS buckets. The wanted rows themselves grow with the corpus and are never broadcast.
    """
    bucket = lambda doc_id, text_hash: F.pmod(F.xxhash64(doc_id, text_hash), F.lit(FILTER_BUCKETS)).cast("int")
    chosen = classes.select("cls", "doc_id", "text_hash").join(wanted, "cls", "left_semi")
    chosen = stage(chosen.withColumnsRenamed({"doc_id": "of_doc", "text_hash": "of_hash"}), "minhash_chosen")
    filled = F.broadcast(chosen.select(bucket("of_doc", "of_hash").alias("bucket")).distinct())
    likely = texts.withColumn("bucket", bucket("doc_id", "text_hash")).join(filled, "bucket", "left_semi")
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_hash"))
    found = likely.join(chosen.hint("merge"), same).select("cls", F.col("text").cast("binary").alias("text"))
    return found.dropDuplicates(["cls"])


def _cross_links(members: DataFrame, roots: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Links between classes of one bucket that belong to different components so far.

    In each bucket, classes outside its largest component visit that component. It receives its own members and all its visitors
    as targets, and the visitors again to ask which targets are similar. A visitor gets one link to each component.
    """
    rooted = members.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    rooted = stage(rooted.select("bucket", "cls", F.coalesce("root", "cls").alias("root")), "minhash_rooted")
    per_root = rooted.groupBy("bucket", "root").agg(F.count("cls").alias("n"))
    per_bucket = per_root.groupBy("bucket").agg(
        F.max(F.struct("n", "root")).alias("largest"), F.sum("n").alias("n"), F.count("n").alias("roots")
    )
    # Two classes in a bucket have been compared: one is the pivot.
    mixed = stage(per_bucket.where("roots > 1 and n > 2").select("bucket", F.col("largest.root").alias("home")), "minhash_mixed")
    visitors = stage(rooted.join(mixed, "bucket").where("root <> home").select("home", "cls", "root").distinct(), "minhash_visitors")
    homes = visitors.select("home").distinct()
    owners = roots.select("root", F.col("node").alias("cls")).join(homes.withColumnRenamed("home", "root"), "root")
    lonely = homes.join(roots.select(F.col("root").alias("home")), "home", "left_anti")
    alone = lonely.select("home", F.col("home").alias("cls"), F.col("home").alias("root"))
    own = owners.select(F.col("root").alias("home"), "cls", "root").union(alone)
    targets = stage(own.union(visitors), "minhash_targets")

    sizes = targets.groupBy("home").agg(F.count("cls").alias("n_targets"))
    sizes = stage(sizes.join(visitors.groupBy("home").agg(F.count("cls").alias("n_visitors")), "home"), "minhash_sizes")
    blocks = lambda count: F.ceil(F.col(count) / BLOCK).cast("int")
    block_of = lambda count: F.pmod(F.xxhash64("cls"), blocks(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), blocks(count) - 1))
    asked = targets.join(sizes, "home").select(
        "home", "cls", "root", F.lit(False).alias("asks"), block_of("n_targets").alias("block"), every("n_visitors").alias("asking")
    )
    asking = visitors.join(sizes, "home").select(
        "home", "cls", "root", F.lit(True).alias("asks"), every("n_targets").alias("block"), block_of("n_visitors").alias("asking")
    )

    def compare(rows: pa.Table) -> pa.Table:
        found = _links_in_block(rows, n, percent)
        return pa.table([pa.array(x, pa.binary()) for x in (zip(*found) if found else ((), ()))], names=["a", "b"])

    rows = asked.union(asking).join(texts, "cls").select("home", "block", "asking", "asks", "cls", "root", "text")
    compared = rows.groupBy("home", "block", "asking").applyInArrow(compare, "a binary, b binary")
    return stage(compared.distinct(), "minhash_cross_links")


def _links_in_block(rows: pa.Table, n: int, percent: int) -> list[tuple[bytes, bytes]]:
    """Links from the rows that ask to similar rows of other components, one to each component. Counts what sets share by an
    inverted index of the targets' shingles."""
    words = WordHashes()
    asks = np.array(rows["asks"].to_pylist(), bool)
    classes, roots = rows["cls"].to_pylist(), rows["root"].to_pylist()
    sets = [shingle_set(text.as_py(), n, words) for text in rows["text"]]
    targets = np.flatnonzero(~asks)
    sizes = np.array([len(sets[i]) for i in targets], np.int64)
    shingles, of_target = np.concatenate([sets[i] for i in targets]), np.repeat(np.arange(len(targets)), sizes)
    order = np.argsort(shingles, kind="stable")
    shingles, of_target = shingles[order], of_target[order]
    found = []
    for i in np.flatnonzero(asks).tolist():
        starts, ends = np.searchsorted(shingles, sets[i], "left"), np.searchsorted(shingles, sets[i], "right")
        counts = ends - starts
        places = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        common = np.bincount(of_target[places], minlength=len(targets))
        reached = {roots[i]}
        for j in targets[100 * common >= percent * (len(sets[i]) + sizes - common)].tolist():
            if roots[j] not in reached:
                reached.add(roots[j])
                found.append((classes[i], classes[j]))
    return found


def _label(signed: DataFrame, roots: DataFrame) -> DataFrame:
    rooted = signed.select("doc_id", "text_hash", "n_shingles", "cls").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    rooted = stage(rooted.withColumn("root", F.coalesce("root", "cls")).drop("cls"), "minhash_rooted")
    smallest = stage(
        rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("smallest")), "minhash_smallest"
    )
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    labelled = rooted.join(smallest, "root", "left").withColumn("component_id", component)
    return labelled.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"),
        "text_hash",
        "root",
    )
