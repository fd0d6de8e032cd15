"""Chronological order without a second parse: ranges fitted by quantile sketches instead of by a sample.

A sort of parsed lines first samples its input to find its ranges, and so parses every line twice. Here the
entries are written once; sketches of their times, which read that column alone, give the ranges.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtally.session import shared_folder

#: Stored bytes of a range, if no number of ranges is given.
RANGE_BYTES = 128 << 20
#: Items that a sketch keeps per range, and the limits of Spark's sketches. The largest sketch takes some hundred kB.
_PER_RANGE, _LEAST_K, _MOST_K = 8, 200, 65_535
#: Items of the sketches of line numbers: one for each file that has a frequent time.
_LINES_K = 800
#: Tasks that merge sketches before the last one does.
_MERGERS = 256
#: Ranges that are made unless a number is given: beyond that a sketch cannot tell them apart.
MOST_RANGES = _MOST_K // _PER_RANGE

_BOUNDS = "array<struct<untimed: boolean, time: bigint, file: string, line: bigint>>"


def _micros(entries: DataFrame) -> Column:
    """Microseconds that sort as ``ts`` does; of a time without a zone, by its fields, so that no zone shifts it."""
    ts = F.col("ts")
    if entries.schema["ts"].dataType == T.TimestampType():
        return F.unix_micros(ts)
    seconds = F.unix_date(F.to_date(ts)).cast("long") * 86_400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.expr("extract(SECOND FROM ts)") * 1_000_000).cast("long")


def _place(bounds: list[tuple], key: Column) -> Column:
    """How many of the ascending bounds are not above the key, by bisection."""
    if not bounds:
        return F.lit(0)
    names = ("untimed", "time", "file", "line")
    listed = F.from_json(F.lit(json.dumps([dict(zip(names, b, strict=True)) for b in bounds])), _BOUNDS)
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))))
    # A place past the end is null, which is not below the key either.
    further = lambda low, step: F.when(F.get(listed, low + step - 1) <= key, low + step).otherwise(low)
    return F.aggregate(steps, F.lit(0), further)


def _quantiles(kept: DataFrame, ranges: int) -> tuple[int, int, list[int]]:
    """All rows, those with a time, and times that part these into pieces of about a range's rows."""
    sketch = F.kll_sketch_agg_bigint("_time", F.lit(min(_MOST_K, max(_LEAST_K, _PER_RANGE * ranges)))).alias("times")
    of_tasks = kept.select("_time", (F.spark_partition_id() % _MERGERS).alias("merger")).groupBy("merger")
    sketches = of_tasks.agg(F.count("*").alias("rows"), F.count("_time").alias("timed"), sketch)
    merged = sketches.agg(F.sum("rows").alias("rows"), F.sum("timed").alias("timed"), F.kll_merge_agg_bigint("times").alias("times"))
    seen = merged.first()
    rows, timed = seen["rows"] or 0, seen["timed"] or 0
    parts = math.ceil(ranges * timed / rows) if rows else 0
    if parts < 2:
        return rows, timed, []
    shares = F.array(*(F.lit(i / parts) for i in range(1, parts)))
    at = kept.sparkSession.range(1).select(F.kll_sketch_get_quantile_bigint(F.lit(bytes(seen["times"])), shares))
    return rows, timed, at.first()[0]


def _cuts(kept: DataFrame, times: list[int], rows: int, ranges: int) -> list[tuple]:
    """Keys that cut the rows of frequent times, and those without one, into pieces of about a range's rows.

    Rows are counted by time and file first; a task then adds up the files of one time. Only files that hold a cut come to the
    driver, so no more than ``ranges`` cuts do.
    """
    some = kept.filter(F.col("_time").isin(times) | F.col("_time").isNull())
    lines = F.kll_sketch_agg_bigint(F.col("line_number").cast("long"), F.lit(_LINES_K)).alias("lines")
    files = some.groupBy("_time", "source_file").agg(F.count("*").alias("n"), F.count("line_number").alias("numbered"), lines)
    until = F.sum("n").over(Window.partitionBy("_time").orderBy("source_file"))
    files = files.withColumn("before", until - F.col("n"))
    size = rows / ranges
    first, last = F.floor(F.col("before") / size) + 1, F.floor((F.col("before") + F.col("n") - 1) / size)
    cut = files.withColumn("first", first).withColumn("last", last).filter("last >= first AND numbered > 0")
    # Quantiles are taken at fixed shares only; the nearest of them serves.
    at = F.kll_sketch_get_quantile_bigint("lines", F.array(*(F.lit(i / ranges) for i in range(ranges + 1))))
    share = lambda j: F.least(F.lit(ranges), F.round((j * size - F.col("before")) / F.col("n") * ranges).cast("int"))
    found = cut.withColumn("at", at).select(
        "_time", "source_file", F.explode(F.transform(F.sequence("first", "last"), lambda j: F.get("at", share(j)))).alias("line")
    )
    return [(r["_time"] is None, r["_time"], r["source_file"], r["line"]) for r in found.distinct().collect()]


def _in_order(bound: tuple) -> tuple:
    """A key in the order of Spark's: nulls come first; text goes by its bytes."""
    untimed, time, file, line = bound
    return untimed, (time is not None, time or 0), (file is not None, (file or "").encode()), (line is not None, line or 0)


def chronological_once(entries: DataFrame, ranges: int | None = None) -> DataFrame:
    """What :func:`chronological` gives, for lines that are parsed only once.

    Entries come in as many ordered ranges, by time, file and line, those without a time last. A time that fills
    several ranges, or the missing time, is cut by file and line; only rows that agree in all three stay together. Without
    a number, a range has 128 MB of stored entries, and there are ``MOST_RANGES`` at most. The stored entries go when the
    driver's JVM ends. Empty input gives no rows.
    """
    spark, folder = entries.sparkSession, shared_folder(entries.sparkSession, "entries")
    timed = entries.withColumn("_time", _micros(entries))
    timed.write.parquet(folder)
    kept = spark.read.schema(timed.schema).parquet(folder)
    if ranges is None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        stored = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
        ranges = min(MOST_RANGES, max(math.ceil(stored / RANGE_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows, with_time, quantiles = _quantiles(kept, ranges)
    frequent = sorted({a for a, b in zip(quantiles, quantiles[1:], strict=False) if a == b})
    bounds: set[tuple] = {(False, time, None, None) for time in quantiles}
    if with_time < rows:
        bounds.add((True, None, None, None))
    if frequent or (rows - with_time) * ranges > rows:
        bounds.update(_cuts(kept, frequent, rows, ranges))
    ordered = sorted(bounds, key=_in_order)
    untimed, line = F.col("_time").isNull().alias("untimed"), F.col("line_number").cast("long").alias("line")
    key = F.struct(untimed, F.col("_time").alias("time"), F.col("source_file").alias("file"), line)
    dealt = kept.repartitionById(len(ordered) + 1, _place(ordered, key))
    return dealt.sortWithinPartitions(F.col("ts").asc_nulls_last(), "source_file", "line_number").drop("_time")
