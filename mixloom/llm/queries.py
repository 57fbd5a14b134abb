"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixloom.llm import attribution, chat, decontaminate, language, mixing, nearest, negatives, packing, prefixes, shards, simhash, token_files, urls
from mixloom.llm.base import shared_path

Query = Callable[[SparkSession, str], DataFrame]

RULES = [
    urls.rule("allow", "org/"),
    urls.rule("block", "example.org/es/"),
    urls.rule("block", "example.org/en/1"),
    urls.rule("allow", "com/fr/"),
    urls.rule("block", "com/de/"),
]


def tokenizer(name: str) -> str:
    """A public tokenizer's definition."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("</s>[INST] ok [/INST]").alias("content")
    messages = F.array(*[F.struct(F.lit(role).alias("role"), said) for role in ("user", "assistant")])
    added = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), messages.alias("messages"))
    given = chat.conversations(table(spark, sf_dir, "conversations"))
    formatted = chat.format_chats(given.unionByName(chat.conversations(added)))
    return chat.digest_chats(chat.read_chats(formatted))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_words", "covered", "coverage", F.size("tiles").alias("n_tiles"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"), RULES)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"), 40)


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_words(table(spark, sf_dir, "documents"))


def op8_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-ids")
    token_files.write(table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"))
    return token_files.read_documents(spark, path)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.attribute(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), ["text"])


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    definition = tokenizer("byte_bpe_50k.json")
    packed = packing.pack(table(spark, sf_dir, "documents"), definition)
    return packing.digest_pieces(packing.sequences(packed, packing.id_width(definition)))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh label is taken for the next one, so that labels and neighbours disagree."""
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", relabelled)
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations begin with up to five turns of the first one of their hundred."""
    conv_id = F.col("conv_id")
    heads = (F.crc32(conv_id.cast("string")) % 6).cast("int")
    placed = prefixes.turns(table(spark, sf_dir, "conversations"))
    return prefixes.trie(*prefixes.rebuilt(placed, conv_id - conv_id % 100, heads, most=5))


QUERIES: dict[str, Query] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_url_filters": op3_url_filters,
    "op4_sharding": op4_sharding,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_source_mixing": op7_source_mixing,
    "op8_token_id_files": op8_token_id_files,
    "op9_language_id": op9_language_id,
    "op10_token_counts": op10_token_counts,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversation_prefix_trie": op13_conversation_prefix_trie,
}
