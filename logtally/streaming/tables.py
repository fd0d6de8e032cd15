"""Tables that a stream adds to micro-batch by micro-batch, readable at any time.

Every micro-batch writes a subfolder of its own, so one that is repeated replaces what it wrote. Now and
then the subfolders are merged. A merge counts once its marker is written, last of all; what it replaces
stays until the next merge, so a DataFrame made before a merge can be read after it. Should it be
kept for longer than that, reading fails for a missing file; it never returns less.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Micro-batches after which a table is merged.
MERGE_EVERY = 100
METRIC_SCHEMA = "metric string, key string, count bigint"


def _file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def mark(spark: SparkSession, path: str) -> None:
    """Write an empty file, to say that something beside it is whole."""
    system, hadoop_path = _file_system(spark, path)
    system.create(hadoop_path, True).close()


def is_marked(spark: SparkSession, path: str) -> bool:
    system, hadoop_path = _file_system(spark, path)
    return system.exists(hadoop_path)


def _numbers(spark: SparkSession, folder: str, kind: str) -> list[int]:
    """The numbers of the entries ``<kind>=<number>`` of a folder, in order."""
    system, pattern = _file_system(spark, f"{folder}/{kind}=*")
    return sorted(int(s.getPath().getName().split("=")[1]) for s in system.globStatus(pattern) or [])


def newest_of(keys: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Keeps the row of the last micro-batch for every key."""

    def combine(rows: DataFrame) -> DataFrame:
        values = [c for c in rows.columns if c not in (*keys, "batch")]
        newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_newest"))
        # Without keys there is a row even of nothing.
        return newest.filter(F.col("_newest").isNotNull()).select(*keys, "_newest.*")

    return combine


@dataclass(frozen=True)
class BatchTable:
    """Rows by micro-batch below ``folder``.

    ``combine`` makes one table of the rows of several micro-batches, which have their number as
    ``batch`` (a merged one -1), and is applied on merging and on reading. Without it all rows are kept
    as they are, and a merge only makes few files of many.
    """

    folder: str
    schema: str
    combine: Callable[[DataFrame], DataFrame] | None = None
    merge_every: int = MERGE_EVERY

    def write(self, rows: DataFrame, number: int) -> None:
        """Write the rows of a micro-batch; merge the earlier ones if it is time."""
        rows.write.mode("overwrite").parquet(f"{self.folder}/batch={number}")
        if number > 0 and number % self.merge_every == 0:
            self._merge(rows.sparkSession, number)

    def read(self, spark: SparkSession) -> DataFrame:
        """What all micro-batches so far add up to; empty before the first."""
        merges = _numbers(spark, self.folder, "_merged")
        since = merges[-1] if merges else None
        folders = [f"merged={n}" for n in (merges[-1:] if self.combine else merges)]
        return self._read(spark, folders + self._batches(spark, since, None))

    def of_batch(self, spark: SparkSession, number: int) -> DataFrame:
        """What a single micro-batch has written; it is there until the next merge but one."""
        return spark.read.schema(self.schema).parquet(f"{self.folder}/batch={number}")

    def _batches(self, spark: SparkSession, since: int | None, until: int | None) -> list[str]:
        numbers = _numbers(spark, self.folder, "batch")
        return [f"batch={n}" for n in numbers if (since is None or n >= since) and (until is None or n < until)]

    def _read(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], self.schema)
        rows = spark.read.schema(self.schema).parquet(*(f"{self.folder}/{name}" for name in folders))
        if self.combine is None:
            return rows
        return self.combine(rows.withColumn("batch", _batch_number(F.col("_metadata.file_path"))))

    def _merge(self, spark: SparkSession, number: int) -> None:
        """Merge the micro-batches before that number, then remove what the merge before has replaced."""
        merges = _numbers(spark, self.folder, "_merged")
        before = max((n for n in merges if n < number), default=None)
        if number not in merges:
            own = [f"merged={before}"] if self.combine and before is not None else []
            rows = self._read(spark, own + self._batches(spark, before, number))
            rows.write.mode("overwrite").parquet(f"{self.folder}/merged={number}")
            mark(spark, f"{self.folder}/_merged={number}")
        if before is None:
            return
        old = self._batches(spark, None, before)
        if self.combine:
            # The marker goes before its folder.
            earlier = [n for n in _numbers(spark, self.folder, "merged") if n < before]
            old += [f"_merged={n}" for n in earlier] + [f"merged={n}" for n in earlier]
        for name in old:
            system, path = _file_system(spark, f"{self.folder}/{name}")
            system.delete(path, True)


def _batch_number(path: Column) -> Column:
    number = F.regexp_extract(path, r"/batch=(\d+)/[^/]*$", 1)
    return F.when(number == "", F.lit(-1)).otherwise(number.try_cast("bigint")).cast("bigint")
