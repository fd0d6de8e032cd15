"""Log files as DataFrames: one row per line."""

from __future__ import annotations

import logging
import posixpath
import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logtally.session import ensure_checkpoint_dir

log = logging.getLogger(__name__)

# Line counts of file blocks are broadcast if they take up to this many bytes (several millions of blocks).
BROADCAST_BYTES = 256 << 20
_BLOCK_BYTES = 64
_GLOB = "\\[]{}*?"


def _literal(path: str) -> str:
    """A pattern that only the path itself matches."""
    return "".join(f"\\{c}" if c in _GLOB else c for c in path)


def existing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths, or patterns, that lead to something; the others are warned about.

    A path that exists is taken literally, whatever characters its name has. Raises if none is left, and
    for names that Spark would pass over in silence.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        if posixpath.basename(path.rstrip("/")).startswith(("_", ".")):
            raise ValueError(f"Spark skips files whose name starts with '_' or '.': {path}")
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        system = hadoop_path.getFileSystem(conf)
        if system.exists(hadoop_path):
            found.append(_literal(path))
        elif system.globStatus(hadoop_path):
            found.append(path)
        else:
            log.warning("file not found: %s", path)
    if not found:
        raise FileNotFoundError(f"no log files among {list(paths)}")
    return found


def vanished(spark: SparkSession, listed: Sequence[str]) -> list[str]:
    """Which of the listed files (``DataFrame.inputFiles()``) are not there any more; warns about them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def gone(path: str) -> bool:
        hadoop_path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
        return not hadoop_path.getFileSystem(conf).exists(hadoop_path)

    found = [path for path in listed if gone(path)]
    if found:
        log.warning("%d files vanished: %s", len(found), found[:20])
    return found


def _unescaped(text: Column) -> Column:
    """The text that a URI's escapes stand for; a plus sign stands for itself."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def _source_name(has_folder: bool) -> Column:
    """The name in a ``source_file=...`` folder, as it is written there, else the base name of the file."""
    if not has_folder:
        return _unescaped(F.col("_metadata.file_name"))
    # The reader guesses a type for a folder's value and would read 007 as a number. What the writer
    # has escaped in a folder's name is escaped once more in the path.
    return _unescaped(_unescaped(F.regexp_extract(F.col("_metadata.file_path"), "/source_file=([^/]*)/", 1)))


def name_of(path: str) -> str:
    """The ``source_file`` of a listed path, see :func:`_source_name`."""
    folder = re.search("/source_file=([^/]*)/", path)
    return unquote(unquote(folder[1])) if folder else unquote(posixpath.basename(path))


def _named(lines: DataFrame) -> DataFrame:
    """Name the line ``raw`` and add its ``file_path`` and, as ``source_file``, the base name of it.

    A folder ``source_file=...`` that already gives a name goes first.
    """
    name, path = _source_name("source_file" in lines.columns), F.col("_metadata.file_path")
    return lines.select(F.col("value").alias("raw"), name.alias("source_file"), path.alias("file_path"))


def scan_logs(spark: SparkSession, paths: Sequence[str], skip_corrupt: bool = False) -> DataFrame:
    """``raw``, ``source_file`` and ``file_path`` of every line in the given files, folders or patterns.

    Lines end with ``\\n``, ``\\r`` or ``\\r\\n``. Files with the same base name count as one, and
    a path given twice counts twice. A file that vanishes before it is read, or cannot be read on, fails the
    scan; with ``skip_corrupt`` it is left out from there (see :func:`vanished`).
    """
    reader = spark.read.option("ignoreMissingFiles", skip_corrupt).option("ignoreCorruptFiles", skip_corrupt)
    return _named(reader.text(existing_paths(spark, paths)))


def stream_logs(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The lines of files as they turn up in a folder; a file must not change once it is there."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _named(reader.load(folder))


def invalid_utf8(raw: Column) -> Column:
    """True for a line whose bytes are not valid UTF-8; scans keep such bytes as they are."""
    return ~F.is_valid_utf8(raw)


def scan_numbered_logs(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Like :func:`scan_logs`, with the 1-based ``line_number`` of each line in its file.

    The parts of a ``source_file=...`` folder are numbered through, in the order of their names.
    Within a block of a file the scan yields lines in order, so a line's number is its position in
    the block plus the lines in earlier blocks. The blocks are counted first and the counts are
    joined back: no file passes through one task, and the lines are neither sorted nor, up to several
    millions of blocks, shuffled. A path given twice is read once.

    Both scans have to deal the blocks out to tasks alike. Each block's lines must come at the very
    positions that they were counted at; if the settings that govern this change between the call
    and the reading of its result, or a file does, reading fails rather than number wrongly.
    """
    reader = spark.read.text(existing_paths(spark, list(dict.fromkeys(paths))))
    by_part = "source_file" in reader.columns
    path = F.col("_metadata.file_path")
    lines = reader.select(
        F.col("value").alias("raw"),
        _source_name(by_part).alias("source_file"),
        path.alias("file_path"),
        F.xxhash64(path).alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    blocks = lines.groupBy("source_file", "file_path", "_path", "_start").agg(
        F.min("_id").alias("_first"), F.max("_id").alias("_last"), F.count("*").alias("_lines")
    )
    # A block read twice, by overlapping patterns, is not one run of positions.
    in_one_run = F.assert_true(
        F.col("_last") - F.col("_first") + 1 == F.col("_lines"), F.lit("a file is read by several of the paths")
    )
    earlier = Window.partitionBy("source_file" if by_part else "file_path")
    earlier = earlier.orderBy("file_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_lines").over(earlier), F.lit(0))
    ensure_checkpoint_dir(spark)
    counted = blocks.select("file_path", "_path", "_start", "_first", "_last", before.alias("_before"), in_one_run.alias("_checked"))
    counted = counted.checkpoint().drop("_checked")
    number_of, paths_of, hashes_of = counted.agg(
        F.count("*"), F.count_distinct("file_path"), F.count_distinct("_path")
    ).first()
    # Paths are joined by a hash, unless two of them have the same.
    key = ["_path", "_start"] if paths_of == hashes_of else ["file_path", "_start"]
    bases = counted.select(*key, "_first", "_last", "_before")
    if number_of * _BLOCK_BYTES <= BROADCAST_BYTES and paths_of == hashes_of:
        bases = F.broadcast(bases)
    in_place = F.col("_id").between(F.col("_first"), F.col("_last"))
    number = F.when(in_place, F.col("_id") - F.col("_first") + F.col("_before") + 1).otherwise(
        F.raise_error(F.lit("the files were dealt out or split differently on re-reading")).cast("bigint")
    )
    return lines.join(bases, key, "left").select("raw", "source_file", "file_path", number.alias("line_number"))


def write_logs(lines: DataFrame, folder: str, *order: str) -> None:
    """Write ``raw`` lines to ``folder/source_file=<name>/``, in the given order.

    Range partitioning splits a large file over several parts, whose names sort like their lines.
    """
    keys = ["source_file", *order]
    ordered = lines.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.select("source_file", "raw").write.mode("overwrite").partitionBy("source_file").text(folder)
