"""The queries of the operators of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.llm import (
    centroids,
    divergence,
    embedding_dedup,
    language_id,
    line_dedup,
    mixing,
    packing,
    quality,
    secret_scan,
    sentencepiece_bpe,
    simhash,
    substring_dedup,
    toxicity,
)
from logtally.llm.common import held_out
from logtally.llm.oracles import ORACLES  # noqa: F401
from logtally.session import ensure_checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def learnable(labels: DataFrame) -> DataFrame:
    """The labels that may be learned from; the others do not even steer the sample."""
    return labels.filter(~held_out("doc_id"))


def tokenizer_path() -> str:
    """The vocabulary file that the queries use; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir).select("doc_id", "text", "lang", held_out("doc_id").alias("held_out"))
    model = language_id.train(docs.filter(~F.col("held_out")))
    return language_id.identify(docs.drop("lang"), model).drop("text")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir)).drop("row")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir)).select("doc_id", "source", "size", "source_size", "target", "taken")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_near_dedup(table(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir).select("doc_id", "text", held_out("doc_id").alias("held_out"))
    model = toxicity.train(docs.filter(~F.col("held_out")), learnable(table(spark, sf_dir, "labels")))
    return toxicity.classify(docs, model).drop("text")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = line_dedup.line_dedup(table(spark, sf_dir).select("doc_id", "text", "source"))
    return clean.select(
        "doc_id",
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_kept"),
        F.size("removed_lines").cast("long").alias("n_removed"),
        F.array_join(F.col("removed_lines").cast("array<string>"), ",").alias("removed"),
        F.sha2("text", 256).alias("clean_sha256"),
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_scan(table(spark, sf_dir), repository=F.concat_ws("/", "source", "lang"))
    of = lambda field, value: F.size(F.filter("base", lambda s: s[field] == value)).cast("long")
    return found.select(
        "doc_id",
        *(of("kind", k).alias(f"n_{kind.name}") for k, kind in enumerate(secret_scan.KINDS)),
        F.sha2(secret_scan.written(F.col("base")), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"),
        of("standing", "live").alias("n_live"),
        of("standing", "example").alias("n_example"),
    )


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_near_dedup(table(spark, sf_dir, "embeddings"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_filter(table(spark, sf_dir).select("doc_id", "text")).drop("text")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir).select("doc_id", "text")
    return sentencepiece_bpe.round_trip(docs, tokenizer_path()).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    pieces = packing.pack(table(spark, sf_dir).select("doc_id", "text"), path, pattern)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.centroid_clustering(table(spark, sf_dir, "embeddings"))
    return found.withColumn("centroid_sha256", centroids.written(F.col("centroid"))).drop("centroid")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergences(table(spark, sf_dir))


def queries() -> dict[str, Query]:
    every = (
        op1_language_id,
        op2_substring_dedup,
        op3_mixing,
        op4_simhash_near_dedup,
        op5_toxicity,
        op6_line_dedup,
        op7_secret_scan,
        op8_embedding_near_dedup,
        op9_quality_rules,
        op10_sentencepiece,
        op11_packing,
        op12_centroid_clustering,
        op13_source_divergence,
    )
    return {f.__name__: f for f in every}
