"""The registered queries of this subpackage: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, fingerprint, jaccard, language, licences, negatives, packing, pieces, quality, sharding, spelling, substring


def tokenizer_path(spark: SparkSession, name: str) -> str:
    """A vocabulary file: in the folder of the session's ``harrier.tokenizers.dir``, else in the installed package."""
    folder = spark.conf.get("harrier.tokenizers.dir", None)
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # a row without an id has no remainder: it is not held out
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = language.fit(docs.where(~held_out & F.col("lang").isNotNull()))
    return language.predict(docs, model).withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.digests(chat.format_conversations(turns.union(more)))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path(spark, "byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = packing.tokenised(docs, tokenizer_path(spark, "word_bpe_49k.json"))
    return packing.pack(pieces, packing.bucket_count(docs)).drop("ids")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeats(table(spark, sf_dir, "documents"))


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_likeness(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    label = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(negatives.usable(table(spark, sf_dir, "embeddings"), vec_id, label, F.col("embedding")), F.col("id") % 100 == 0)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents")))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path(spark, "piece_bpe_32k.model")
    coded = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), path), path)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_language_id,
        op2_chat_formatting,
        op3_bpe,
        op4_harmonic_packing,
        op5_substring_dedup,
        op6_licence_scan,
        op7_jaccard_join,
        op8_sharding,
        op9_fingerprints,
        op10_quality_rules,
        op11_hard_negatives,
        op12_spelling_variants,
        op13_sentencepiece,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op2_chat_formatting": chat.ORACLE, "op6_licence_scan": licences.ORACLE, "op11_hard_negatives": negatives.ORACLE}
