"""One registered query for each operator, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import (
    arrow_sequences,
    byte_codec,
    conversation_repair,
    embedding_dedup,
    filter_audit,
    language_mixture,
    line_dedup,
    mixing,
    ordinal_quality,
    quality_rules,
    sentencepiece_codec,
    simhash,
    token_counts,
)

# Fixed values of the mixing query: number of domains, weights of nodes of the tree, epochs, share of all words.
DOMAINS = 4
WEIGHTS = {
    ("domain0",): 2.0,
    ("domain3",): 0.5,
    ("domain0", "en"): 3.0,
    ("domain1", "en"): 2.0,
    ("domain1", "de", "src1"): 4.0,
}
EPOCHS, SHARE = 2, 0.8


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def domain(source: str = "source") -> Column:
    """Domain of a source: the number in its name, modulo DOMAINS; 'other' without a number."""
    number = F.regexp_extract(source, r"(\d+)$", 1).try_cast("bigint")
    return F.coalesce(F.concat(F.lit("domain"), (number % DOMAINS).cast("string")), F.lit("other"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(quality_rules.ledger(documents(spark, sf_dir)))


def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_mixture.learn_and_predict(documents(spark, sf_dir))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the labels, predicted for all documents."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", ordinal_quality.grade_of().alias("grade"))
    return ordinal_quality.predict(docs, ordinal_quality.fit(docs, labels))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = line_dedup.dedup_lines(documents(spark, sf_dir), short=True)
    return rest.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.length("text").cast("bigint").alias("n_left"),
        F.sha2("text", 256).alias("left_sha256"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("domain", domain())
    mixed = mixing.mix(docs, weights=WEIGHTS, epochs=EPOCHS, share=SHARE)
    named = [F.get("path", i).alias(c) for i, c in enumerate(mixing.LEVELS)]
    return mixed.select("doc_id", *named, "n_tokens", "epochs")


def op9_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrow_sequences.round_trip(
        spark, documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1
    )


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.codec_digests(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_codec.codec_digests(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with the faults that the query plants by a checksum of their ids and turns."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = conversations.select(
        "conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")],
        (F.crc32(F.concat_ws(":", *shown)) % 20).alias("fault"),
    )
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.filter("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    report = conversation_repair.Repair(damaged(conversations)).report
    every = conversations.select(F.col("conv_id").alias("id")).distinct()
    full = every.join(report, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    return full.select(
        F.col("id").alias("conv_id"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in conversation_repair.COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_language_mixture,
        op3_embedding_dedup,
        op4_ordinal_quality,
        op5_line_dedup,
        op6_simhash,
        op7_token_counts,
        op8_mixing,
        op9_arrow_sequences,
        op10_sentencepiece,
        op11_byte_bpe,
        op12_filter_audit,
        op13_conversation_repair,
    )
}
