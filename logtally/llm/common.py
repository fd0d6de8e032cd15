"""What several operators share: word pattern, the held-out fold, scratch tables, Arrow slices."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.session import shared_folder

#: A word, as a Java regular expression: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_BATCH_ROWS, _BATCH_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
#: Keys that are dealt out over several tasks at most, and rows of a key from which on it may be.
HOT_KEYS, HOT_ROWS = 4096, 10_000
#: Characters of text that one step of a Python worker holds at a time (a single longer text is one step).
SLICE_CHARS = 8_000_000


def held_out(doc_id: str) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0. A null id is held out too: nothing is learned from it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table below the shared folder and read it again.

    Cuts the lineage like ``checkpoint()``, but computes the rows once and keeps them compressed.
    The folder goes when the driver's JVM ends.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def _small_batches(spark: SparkSession) -> None:
    """Rows of documents are long: 10,000 of them take tens of MB in the JVM and as much again in each worker.

    So where the session has Spark's default of 10,000 rows a batch, it is set to 1,000, and a batch's bytes to 8 MB.
    """
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "1000")
    if spark.conf.get(_BATCH_BYTES, None) in (None, "67108864", "64MB", "64m"):
        spark.conf.set(_BATCH_BYTES, "8m")


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow(run, schema)``, with small batches. A worker that has finished a task gives back what its buffers took."""
    _small_batches(df.sparkSession)

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(released, schema)


def of_column(spark: SparkSession, run: Callable[[Iterator[pa.Array]], Iterator[pa.Array]], kind: str) -> Callable[[str], Column]:
    """A column computed by batches from another one: only that goes to the workers, only the result comes back."""
    _small_batches(spark)

    def released(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return F.arrow_udf(released, kind)


def slices(batch: pa.RecordBatch, column: str, chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``chars`` bytes at most."""
    lengths = pc.binary_length(batch.column(column)).to_pylist()
    start = total = 0
    for row, length in enumerate(lengths):
        length = length or 0
        if row > start and total + length > chars:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += length
    if start < batch.num_rows:
        yield batch.slice(start)


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which null keys are equal; the right side's keys are left out."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    joined = left.join(renamed, functools.reduce(Column.__and__, same), how)
    # A semi-join has the left side's columns only; dropping what is not there does nothing.
    return joined.drop(*(f"_right_{k}" for k in keys))


def join_hot(
    left: DataFrame, right: DataFrame, keys: list[str], counts: DataFrame, spread: list[str], how: str = "inner", counted: bool = False
) -> DataFrame:
    """:func:`join_on` where some keys may hold a large part of the left side, and the right has a row per key.

    ``counts`` has the keys and, as ``n``, the rows that the left side has of each. At most ``HOT_KEYS``
    keys can have over a ``HOT_KEYS``-th of all rows, so these are few enough to broadcast. Their rows are dealt out in
    parts of about that many, by a hash of the ``spread`` columns, and their right row is repeated for each part.
    All parts together are twice ``HOT_KEYS`` at most, whatever the sizes of the keys. Where the right side is
    ``counted``, it has ``n`` too, and needs no join to know its parts; ``n`` is left out of the result.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    most = max(HOT_ROWS, total // HOT_KEYS)
    parts = F.ceil(F.col("n") / most).cast("int")
    hot = F.broadcast(counts.filter(F.col("n") > most).select(*keys, parts.alias("_parts")).checkpoint())
    salt = F.pmod(F.xxhash64(*spread), F.col("_parts")).cast("int")
    salted = join_on(left, hot, keys, "left").withColumn("_salt", F.coalesce(salt, F.lit(0))).drop("_parts")
    every = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    parted = right.withColumn("_parts", parts).drop("n") if counted else join_on(right, hot, keys, "left")
    repeated = parted.withColumn("_salt", F.explode(every)).drop("_parts")
    return join_on(salted, repeated, [*keys, "_salt"], how).drop("_salt")
