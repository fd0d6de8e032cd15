"""The queries of this repository and, for each, a DuckDB statement of its result.

The log lines are written out from the ``events`` table (``logtally.sources.events``). Queries
about files and streams write these lines to text files below the shared folder first.
"""

from __future__ import annotations

import functools
import importlib
import os
import shutil
import tempfile
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import logtally as lt
from logtally.functions.levels import fallback_level, normalize_level
from logtally.functions.patterns import BASELINE_RULES
from logtally.functions.timestamps import parse_timestamp
from logtally.session import shared_folder, tune
from logtally.streaming.tables import METRIC_SCHEMA
from oracles import (
    FILE_NAMES,
    GENERATED_FILES,
    KEYWORDS,
    ORACLES,
    SEED,
    SHORT_PATTERN,
    STAMPS,
    TIME_FORMATS,
    TOKENS,
    WRITTEN_TIMES,
)


def _optional(name: str):
    """A module that an installation may lack, or that needs one that it lacks; any other error in it is one."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as error:
        missing = error.name or ""
        if name == missing or name.startswith(f"{missing}."):
            return None
        if missing.split(".")[0] in ("logtally", "corpus_pipeline"):
            raise
        warnings.warn(f"{name} is left out, as {missing} is not installed", stacklevel=2)
        return None


corpus = _optional("logtally.llm.queries")
pipeline = _optional("corpus_pipeline") if corpus else None
# Bytes of a table per core up to which a scan may have fewer tasks than there are cores.
SMALL_SPLIT = 16 << 20
ENTRY_COLUMNS = ("source_file", "line_number", "ts", "level", "thread", "logger", "message", "raw", "malformed", "hour")
ID = ("source_file", "line_number")
Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events. The small tables are one row group, which one task would read: those are dealt out."""
    path = f"{sf_dir}/events.parquet"
    events, cores = tune(spark).read.parquet(path), spark.sparkContext.defaultParallelism
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(hadoop_path).getLength()
    return events.repartition(cores) if size < cores * SMALL_SPLIT else events


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lt.log_lines_from_events(_events(spark, sf_dir))


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lt.parse_logs(_lines(spark, sf_dir))


def _on_lines(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_lines(spark, sf_dir))


def _on_entries(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_entries(spark, sf_dir))


def _files(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> str:
    """Write the lines as text files, in order, and return their folder."""
    folder = shared_folder(spark, "lines")
    lt.write_logs(_lines(spark, sf_dir) if lines is None else lines, folder, "line_number")
    return folder


def scan_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lt.scan_logs(spark, [_files(spark, sf_dir)]).select("source_file", "raw")


def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lt.scan_numbered_logs(spark, [_files(spark, sf_dir)]).select("source_file", "line_number", "raw")


def normalize_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = spark.sql(TOKENS, events=_events(spark, sf_dir))
    return tokens.withColumn("level", normalize_level(F.col("token")))


def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamps = spark.sql(STAMPS, events=_events(spark, sf_dir))
    return stamps.withColumn("ts", parse_timestamp(F.col("text")))


def dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line twice, as if its file had been given twice; each remains once and is parsed once."""
    lines = _lines(spark, sf_dir)
    return lt.parse_logs(lt.dedupe_entries(lines.unionByName(lines))).select(*ENTRY_COLUMNS)


def baseline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = lt.all_metrics(_entries(spark, sf_dir), BASELINE_RULES, KEYWORDS)
    return metrics.filter(F.col("metric") != "malformed")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lt.analyze_lines(_lines(spark, sf_dir), lt.Options(keywords=KEYWORDS)).report


def generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated record per event, spread over the files."""
    event = F.col("event_id")
    records = _events(spark, sf_dir).select(
        (event % GENERATED_FILES + 1).alias("file"), F.floor(event / GENERATED_FILES).alias("record")
    )
    return lt.write_records(records, SEED)


def _run(spark: SparkSession, running: DataFrame, schema: str = METRIC_SCHEMA, merge_every: int = 100) -> DataFrame:
    """Run a stream over what is there and return its last state."""
    folder = shared_folder(spark, "updates")
    update = lt.update_table(folder, merge_every=merge_every)
    lt.start_updates(running, shared_folder(spark, "state"), update, poll_ms=None).awaitTermination()
    return lt.latest(spark, folder, schema)


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a stream that takes the files a few at a time."""
    stream = lt.stream_logs(spark, _files(spark, sf_dir), max_files_per_trigger=8)
    return lt.add_up(_run(spark, lt.running_metrics(lt.parse_logs(stream), keywords=KEYWORDS)))


def stream_merged_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a table that is merged every other micro-batch, read as it was made before the merges."""
    stream = lt.stream_logs(spark, _files(spark, sf_dir), max_files_per_trigger=2)
    return lt.add_up(_run(spark, lt.running_metrics(lt.parse_logs(stream), keywords=KEYWORDS), merge_every=2))


def stream_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time range from a table that is merged several times."""
    stream = lt.stream_logs(spark, _files(spark, sf_dir), max_files_per_trigger=2)
    return _run(spark, lt.running_time_range(lt.parse_logs(stream)), lt.TIME_RANGE_SCHEMA, merge_every=2)


def stream_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per hour of a stream, of the hours that its watermark has closed."""
    stream = lt.parse_logs(lt.stream_logs(spark, _files(spark, sf_dir)))
    table = lt.BatchTable(shared_folder(spark, "hours"), "hour string, count bigint")
    writer = lt.windowed_hours(stream, "6 hours").writeStream.outputMode("append").foreachBatch(table.write)
    writer.option("checkpointLocation", shared_folder(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    return table.read(spark)


def stream_expiring_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a stream whose state drops its keys after a second."""
    stream = lt.stream_logs(spark, _files(spark, sf_dir), max_files_per_trigger=8)
    running = lt.running_metrics(lt.parse_logs(stream), keywords=KEYWORDS, expire="1 second")
    return lt.add_up(_run(spark, running, lt.EPOCH_SCHEMA))


def stream_distinct_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries with a time of two tails of the same files; each line counts once."""
    pattern = _tail_files(spark, sf_dir)
    tail = lambda: lt.tail_logs(spark, pattern, "beginning")
    entries = lt.distinct_lines(lt.parse_logs(_with_name(tail().unionByName(tail()))), delay="3650 days")
    table = lt.BatchTable(shared_folder(spark, "lines"), "source_file string, level string, raw string")
    writer = entries.select("source_file", "level", "raw").writeStream.foreachBatch(table.write)
    writer.option("checkpointLocation", shared_folder(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    return table.read(spark)


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = lt.stream_logs(spark, _files(spark, sf_dir))
    folder = shared_folder(spark, "alerts")
    lt.start_alerts(lt.parse_logs(stream), shared_folder(spark, "state"), folder, poll_ms=None).awaitTermination()
    return lt.read_alerts(spark, folder)


def _followed(spark: SparkSession, sf_dir: str) -> lt.Monitor:
    """One file is analysed as a batch; a stream of the others carries its results on, in two runs."""
    lines = _lines(spark, sf_dir)
    in_batch, options = F.col("source_file") == "app_1.log", lt.Options(keywords=KEYWORDS)
    batch = lt.analyze_lines(lines.filter(in_batch), options)
    files, folder = _files(spark, sf_dir, lines.filter(~in_batch)), shared_folder(spark, "monitor")
    for most in (2, None):
        stream = lt.stream_logs(spark, files, max_files_per_trigger=most)
        live = lt.follow(stream, folder, options, batch, poll_ms=None, merge_every=2)
        live.query.awaitTermination()
    return live


def stream_after_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _followed(spark, sf_dir).metrics()


def stream_after_batch_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _followed(spark, sf_dir).overview()


def _tail_files(spark: SparkSession, sf_dir: str) -> str:
    return f"{_files(spark, sf_dir)}/*/part-*"


def _with_name(lines: DataFrame) -> DataFrame:
    return lines.withColumn("source_file", F.regexp_extract("file_path", "source_file=([^/]+)", 1))


def tail_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a tail over the files from their beginning, in many byte ranges."""
    stream = lt.tail_logs(spark, _tail_files(spark, sf_dir), start="beginning", rangeBytes=str(256 << 10))
    return lt.add_up(_run(spark, lt.running_metrics(lt.parse_logs(_with_name(stream)), keywords=KEYWORDS)))


def monitor_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of the first half of each file, and a monitor that goes on where the batch ended."""
    pattern, options = _tail_files(spark, sf_dir), lt.Options(keywords=KEYWORDS)
    halves = {}
    for path, end in lt.finished_positions(pattern).items():
        with open(path, "rb") as file:
            file.seek(end // 2)
            file.readline()
            halves[path] = file.tell()
    batch = lt.analyze_lines(_with_name(lt.read_until(spark, halves)), options)
    rest = _with_name(lt.tail_logs(spark, pattern, halves))
    live = lt.follow(rest, shared_folder(spark, "monitor"), options, batch, poll_ms=None)
    live.query.awaitTermination()
    return live.metrics()


def monitor_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last report of a monitor that reads a backlog of files in a dozen micro-batches and more."""
    pattern, options = _tail_files(spark, sf_dir), lt.Options(keywords=KEYWORDS)
    backlog = sum(lt.finished_positions(pattern).values())
    lines = lt.tail_logs(spark, pattern, "beginning", maxBytesPerBatch=str(backlog // 12 + 1))
    live = lt.follow(_with_name(lines), shared_folder(spark, "monitor"), options, poll_ms=0)
    live.process_available()
    return live.stop()


def tail_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines, appended bit by bit to a file that is renamed, hidden, cut short and made anew, with a restart in between.

    Another file of the folder may have the inode that the removed one had; it is none of the pattern's.
    """
    parts = sorted(lt.finished_positions(_tail_files(spark, sf_dir)))
    folder = tempfile.mkdtemp(prefix="tail-")
    path, away, state = f"{folder}/app.log", f"{folder}/away", shared_folder(spark, "state")
    table = lt.BatchTable(shared_folder(spark, "tailed"), "raw string, source_file string")
    os.mkdir(away)

    def append(step: int, to: str = path) -> None:
        """Add a tenth of the written parts to a file, as they are."""
        with open(to, "ab") as file:
            for part in parts[len(parts) * step // 10 : len(parts) * (step + 1) // 10]:
                with open(part, "rb") as lines:
                    shutil.copyfileobj(lines, file)

    def start():
        stream = lt.tail_logs(spark, path, start="beginning", rangeBytes=str(256 << 10)).select("raw", "source_file")
        writer = stream.writeStream.option("checkpointLocation", state).foreachBatch(table.write)
        return writer.trigger(processingTime="50 milliseconds").start()

    try:
        append(0)
        query = start()
        query.processAllAvailable()
        append(1)
        os.rename(path, f"{path}.1")  # rotated, with a rest that may not have been read
        append(2, f"{path}.1")
        append(3)
        query.processAllAvailable()
        os.rename(path, f"{away}/app.log")  # not there for a while
        query.processAllAvailable()
        os.rename(f"{away}/app.log", path)
        append(4)
        query.processAllAvailable()
        query.stop()
        append(5)
        query = start()
        query.processAllAvailable()
        os.truncate(path, 0)
        append(6)
        query.processAllAvailable()
        os.truncate(path, 0)  # cut short, and longer than before soon after
        for step in (7, 8):
            append(step)
        query.processAllAvailable()
        os.remove(path)
        append(0, f"{folder}/unrelated.txt")
        query.processAllAvailable()
        append(1, f"{folder}/unrelated.txt")
        query.processAllAvailable()
        append(9)
        query.processAllAvailable()
        query.stop()
    finally:
        shutil.rmtree(folder, ignore_errors=True)
    return table.read(spark)


def named_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per file where names look like numbers, dates or patterns; one of the paths does not exist."""
    lines = _lines(spark, sf_dir)
    names = F.array(*map(F.lit, FILE_NAMES))
    renamed = lines.withColumn("source_file", F.get(names, (F.col("line_number") % len(FILE_NAMES)).cast("int")))
    folder = _files(spark, sf_dir, renamed)
    return lt.file_counts(lt.scan_logs(spark, [folder, f"{folder}/missing.log"]))


def written_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the report as they stand in the file it is written to."""
    output = shared_folder(spark, "report")
    lt.analyze_lines(_lines(spark, sf_dir), lt.Options(keywords=KEYWORDS, output=output))
    return spark.read.text(output).select(F.col("value").alias("line")).filter("line != ''")


def short_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries by a pattern of three groups: no logger and no message of their own."""
    return lt.parse_logs(_lines(spark, sf_dir), SHORT_PATTERN).select("source_file", "line_number", "ts", "level", "thread", "logger", "message")


def any_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in formats with optional sections, fields of variable width and month names."""
    written = spark.sql(WRITTEN_TIMES, events=_events(spark, sf_dir))
    return written.withColumn("ts", parse_timestamp(F.col("text"), TIME_FORMATS))


def queries() -> dict[str, Query]:
    """Name to ``(spark, sf_dir) -> DataFrame``."""
    hits = functools.partial(lt.keyword_hits, keywords=KEYWORDS)
    own = {
        "scan_logs": scan_files,
        "line_numbers": line_numbers,
        "parse_logs": _on_entries(lambda e: e.select(*ENTRY_COLUMNS)),
        "fallback_level": _on_lines(lambda d: d.select(*ID, fallback_level(F.col("raw")).alias("level"))),
        "normalize_level": normalize_levels,
        "parse_timestamps": parse_timestamps,
        "entry_display": _on_entries(lambda e: lt.entry_display(e).select(*ID, "display")),
        "error_entries": _on_entries(lambda e: lt.error_entries(e).select(*ENTRY_COLUMNS)),
        "keyword_lines": _on_lines(lambda d: lt.keyword_lines(d, KEYWORDS).select(*ID, "raw")),
        "keyword_search": _on_lines(lambda d: lt.keyword_search(d, KEYWORDS).select(*ID, "raw", "keyword")),
        "error_pattern_rows": _on_entries(lambda e: lt.error_pattern_rows(e).select(*ID, "pattern")),
        "overview": _on_entries(lt.overview),
        "level_counts": _on_entries(lt.level_counts),
        "error_patterns": _on_entries(lt.error_patterns),
        "baseline_patterns": _on_entries(lt.baseline_patterns),
        "baseline_metrics": baseline_metrics,
        "top_error_patterns": _on_entries(lambda e: lt.top_error_patterns(lt.error_patterns(e))),
        "heavy_error_patterns": _on_entries(lt.heavy_error_patterns),
        "keyword_hits": _on_lines(lambda d: lt.ranked(hits(d), "keyword")),
        "hourly_activity": _on_entries(lambda e: lt.hourly_activity(e).orderBy("hour")),
        "file_counts": _on_lines(lambda d: lt.ranked(lt.file_counts(d), "source_file")),
        "level_distribution": _on_entries(lambda e: lt.level_distribution(lt.level_counts(e))),
        "hourly_profile": _on_entries(lambda e: lt.hourly_profile(lt.hourly_activity(e))),
        "chronological": _on_entries(lambda e: lt.chronological(e).select(*ID, "ts", "level")),
        "chronological_once": _on_entries(lambda e: lt.chronological_once(e).select(*ID, "ts", "level")),
        "dedupe_entries": dedupe,
        "all_metrics": _on_entries(lambda e: lt.all_metrics(e, keywords=KEYWORDS)),
        "report_lines": report,
        "stream_metrics": stream_metrics,
        "stream_merged_metrics": stream_merged_metrics,
        "stream_time_range": stream_time_range,
        "stream_alerts": stream_alerts,
        "stream_hours": stream_hours,
        "stream_expiring_metrics": stream_expiring_metrics,
        "stream_distinct_lines": stream_distinct_lines,
        "stream_after_batch": stream_after_batch,
        "stream_after_batch_overview": stream_after_batch_overview,
        "tail_metrics": tail_metrics,
        "tail_events": tail_events,
        "monitor_report": monitor_report,
        "monitor_metrics": monitor_metrics,
        "named_files": named_files,
        "written_report": written_report,
        "short_pattern": short_pattern,
        "any_format": any_format,
        "generate_logs": generate,
    }
    if corpus:
        own |= corpus.queries()
    if pipeline:
        own["pipeline"] = pipeline.run
    return own


def oracle_sql() -> dict[str, str]:
    """Name to the DuckDB statement with the same result."""
    own = dict(ORACLES)
    if corpus:
        own |= corpus.ORACLES
    if pipeline and pipeline.ORACLE_SQL:
        own["pipeline"] = pipeline.ORACLE_SQL
    return own


def entry(spark: SparkSession) -> DataFrame:
    """All metrics of the smallest data set."""
    return queries()["all_metrics"](spark, "/root/testdata/sf0.001")
