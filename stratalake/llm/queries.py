"""The registered queries of this subpackage: each applies an operator to its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.llm.ann import nearest_neighbours
from stratalake.llm.bpe import encode_documents
from stratalake.llm.chat import format_chats, read_loss_texts, read_turns
from stratalake.llm.common import read, ship_library
from stratalake.llm.cover import remove_repeated_words
from stratalake.llm.importance import resample
from stratalake.llm.lexical import lexical_search
from stratalake.llm.line_crf import quality_rules, train_on_labels
from stratalake.llm.minhash import near_duplicates
from stratalake.llm.mixing import mix_sources
from stratalake.llm.prefix_trie import describe_turns, prefix_trie, share_heads
from stratalake.llm.repair import token_files
from stratalake.llm.secrets import base_spans, count_kind, find_secrets, told
from stratalake.llm.suffixes import remove_repeated_strings
from stratalake.sources.scratch import stage

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"), shingle=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeated_strings(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_documents(read(spark, sf_dir, "documents"), tokenizer_path())
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_rules(docs, train_on_labels(docs, read(spark, sf_dir, "labels")))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    table = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(control).alias("text"),
    )
    chats = format_chats(table.unionByName(own))
    turns = chats.select(
        "conv_id",
        read_turns(F.col("formatted")).alias("turns"),
        F.array_join(read_loss_texts(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeated_words(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.where("vec_id % 20 = 0"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files(read(spark, sf_dir, "documents"), tokenizer_path())
    return files.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return kept.select("doc_id", "n_ngrams", "log_weight", "key", "kept")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    return find_secrets(read(spark, sf_dir, "documents")).select(
        "doc_id",
        *[count_kind(spans, kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(told(base_spans(spans)), 256).alias("base_sha256"),
        told(spans).alias("spans"),
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = stage(describe_turns(read(spark, sf_dir, "conversations")), "described_turns")
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return prefix_trie(share_heads(described)).select(*columns)


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_library(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    name: _shipped(query)
    for name, query in {
        "op1_minhash_dedup": op1_minhash_dedup,
        "op2_mix_sources": op2_mix_sources,
        "op3_suffix_array_dedup": op3_suffix_array_dedup,
        "op4_bpe_encoding": op4_bpe_encoding,
        "op5_quality_rules": op5_quality_rules,
        "op6_chat_formatting": op6_chat_formatting,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_nearest_neighbours": op8_nearest_neighbours,
        "op9_token_files": op9_token_files,
        "op10_importance_resampling": op10_importance_resampling,
        "op11_secret_scan": op11_secret_scan,
        "op12_lexical_search": op12_lexical_search,
        "op13_prefix_trie": op13_prefix_trie,
    }.items()
}
