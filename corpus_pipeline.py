"""From raw documents to token ids: five stages, each of which works on all rows that the one before kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it as Parquet to the shared folder named in
``spark.checkpoint.dir`` and hands it, read again, to the next stage. All but the last return the columns of ``docs``,
extra ones included. Nulls are fine in every column, and empty tables stay empty. Rows that agree in id and text are one
document that comes repeatedly: the near-duplicate stage keeps one of them, the mix repeats rows on purpose.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.llm.bpe import encode_documents
from stratalake.llm.common import read, ship_library
from stratalake.llm.cover import remove_repeated_words
from stratalake.llm.importance import resample
from stratalake.llm.minhash import near_duplicates
from stratalake.llm.mixing import mix_sources
from stratalake.llm.queries import tokenizer_path
from stratalake.sources.scratch import scratch_folder, stage

def _free(columns: list[str], name: str) -> str:
    """A name that none of the columns has, whatever they are called."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


class _Rows:
    """The rows of a stage, named as the operators name them: by id and a hash of the text. Added columns never clash with given ones."""

    def __init__(self, docs: DataFrame) -> None:
        self.columns = docs.columns
        self.id, self.hash = self.name("row_id"), self.name("row_text_hash")
        text = F.coalesce(F.col("text"), F.lit(""))
        self.keyed = docs.withColumns({self.id: F.col("doc_id").cast("long"), self.hash: F.xxhash64(text)})

    def name(self, name: str) -> str:
        return _free(self.columns, name)

    def join(self, rows: DataFrame, decided: DataFrame, how: str = "inner", also: tuple[str, ...] = ()) -> DataFrame:
        """``rows`` with an operator's result, which is stored: the columns of the latter get names of their own. ``also`` names columns
        besides id and hash that must agree."""
        named = stage(decided.select([F.col(c).alias(self.name(f"decided_{c}")) for c in decided.columns]), "pipeline_decided")
        same = F.col(self.id).eqNullSafe(F.col(self.name("decided_doc_id"))) & (F.col(self.hash) == F.col(self.name("decided_text_hash")))
        for c in also:
            same = same & F.col(c).eqNullSafe(F.col(self.name(f"decided_{c}")))
        return rows.join(named, same, how)

    def one_of_each(self, rows: DataFrame, *also: str) -> DataFrame:
        """Of rows that agree in id, text (and ``also``) the one whose other columns come first when they are written as JSON."""
        others = F.to_json(F.struct(*[F.col(c) for c in self.columns if c != "text"]), {"ignoreNullFields": "false"})
        whole, order = self.name("whole_row"), self.name("order_of_row")
        packed = rows.select(self.id, self.hash, *also, F.struct(*rows.columns).alias(whole), others.alias(order))
        return packed.groupBy(self.id, self.hash, *also).agg(F.min_by(whole, order).alias(whole)).select(f"{whole}.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling rejects go. Rows without labels take part like all others."""
    ship_library(spark)
    rows = _Rows(docs)
    judged = resample(docs, read(spark, sf_dir, "labels"))
    kept = judged.where("kept").select("doc_id", "text_hash").distinct()
    return rows.join(rows.keyed, kept, "left_semi").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8) stays: that with the smallest id, rows without an id last.

    Of rows of the group that share this id, or have none, the one with the smallest hash of its text stays; of those that also share the
    text, the one whose other columns come first as JSON. Rows that share an id but are not similar are different groups. Of texts
    without words, one row of each id and text stays.
    """
    ship_library(spark)
    rows = _Rows(docs)
    found = near_duplicates(docs)
    wordless = F.col("root").isNull()
    groups = found.groupBy("root", F.when(wordless, F.col("doc_id")).alias("of_id"), F.when(wordless, F.col("text_hash")).alias("of_text"))
    least = groups.agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("least"))
    kept = rows.join(rows.keyed, least.select("least.doc_id", "least.text_hash"), "left_semi")
    return rows.one_of_each(kept).select(docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words or more that a document with a smaller id has too go from the text; all rows stay.

    Texts that lose nothing stay as they are. ``n_chars``, if there is one, follows the text.
    """
    ship_library(spark)
    rows = _Rows(docs)
    cut = remove_repeated_words(docs, keep_layout=True).where("n_removed > 0").select("doc_id", "text_hash", "kept_text")
    # Rows of one id and text lose the same.
    joined = rows.join(rows.keyed, cut.dropDuplicates(["doc_id", "text_hash"]), "left")
    kept = rows.name("decided_kept_text")
    changed = {"text": F.coalesce(kept, "text")}
    if "n_chars" in docs.columns:
        length = F.length(kept).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col(kept).isNotNull(), length).otherwise(F.col("n_chars"))
    return joined.withColumns(changed).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row comes as often as the mix takes it: not at all, or up to three times. A text taken in part comes whole.

    Rows that agree in id, text and source come together as often as all of them are taken, with the other columns of the one that comes
    first as JSON.
    """
    ship_library(spark)
    rows = _Rows(docs)
    taken = mix_sources(docs).groupBy("doc_id", "text_hash", "source").agg(F.sum("copies").cast("int").alias("copies"))
    once = rows.join(rows.one_of_each(rows.keyed, "source"), taken.where("copies > 0"), also=("source",))
    repeated = F.explode(F.sequence(F.lit(1), F.col(rows.name("decided_copies"))))
    return once.select(*docs.columns, repeated.alias(rows.name("copy"))).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row; ids are little-endian unsigned 32-bit integers."""
    ship_library(spark)
    return encode_documents(docs, tokenizer_path()).select("doc_id", "n_tokens", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix", mix),
    ("encode", encode),
]

#: Neither the trained classifier nor BPE can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        path = scratch_folder(spark, f"pipeline_{name}")
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
