"""A corpus from raw documents to tokens: filter, clean, deduplicate, mix, encode.

Each stage takes the rows its predecessor kept, with the columns of ``documents``, and all but the last return
those columns. ``run`` writes the result of a stage below the shared folder and reads it for the next,
so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.llm import line_dedup, mixing, queries, sentencepiece_bpe, simhash, toxicity
from logtally.llm.common import held_out, join_on, stored
from logtally.session import ensure_checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labelled rows that are not held out."""
    learn = docs.filter(~held_out("doc_id"))
    model = toxicity.train(learn, queries.learnable(queries.table(spark, sf_dir, "labels")))
    return toxicity.classify(docs, model, score="_score", predicted="_toxic").filter("_toxic = 0").drop("_score", "_toxic")


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sources go, but for their first occurrence; lengths are counted anew."""
    clean = line_dedup.line_dedup(docs, removed="_removed")
    chars = F.when(F.size("_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", chars).drop("_removed")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of smallest id, null last, and of these the one of smallest digest.

    Ids may be null or repeated, so a row is known by its id and a digest of its other columns.
    """
    others = [F.col(c) for c in docs.columns if c != "doc_id"]
    keyed = docs.withColumn("_digest", F.xxhash64(*others, *(c.isNull() for c in others)))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_digest")
    groups = simhash.simhash_near_dedup(keyed.select(row.alias("_row"), "text"), "_row")
    key = ["doc_id", "_digest"]
    first = groups.filter(F.col("_row") == F.col("component_id")).select(*(F.col(f"_row.{c}").alias(c) for c in key)).distinct()
    return join_on(keyed, first, key, "left_semi").dropDuplicates(key).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source at its target weight: whole documents repeat or go."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids with an end id, and a digest of the text that they decode to."""
    coded = sentencepiece_bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), queries.tokenizer_path(), decoded="_decoded")
    return coded.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("_decoded", 256).alias("decoded_sha256")
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", tokenize),
]

# A classifier, XXH64 and a tokenizer cannot be written in SQL; the tests hold brute force against it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
