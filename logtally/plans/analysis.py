"""From log files to report in one call."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logtally.functions.matching import DEFAULT_PATTERN
from logtally.functions.patterns import DEFAULT_KEYWORDS, ERROR_RULES, Rule
from logtally.functions.timestamps import DEFAULT_FORMATS
from logtally.operators.parse import parse_logs
from logtally.plans.metrics import COUNTED_COLUMNS, metrics_of, overview_of, summarize
from logtally.plans.report import report_lines, write_report
from logtally.session import ensure_checkpoint_dir, tune
from logtally.sources.files import invalid_utf8, name_of, scan_logs, vanished
from logtally.sources.tail import finished_positions, read_until

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Options:
    """What a run looks for and where its report goes."""

    keywords: Sequence[str] = DEFAULT_KEYWORDS
    pattern: str = DEFAULT_PATTERN
    timestamp_formats: Sequence[str] = DEFAULT_FORMATS
    rules: Sequence[Rule] = ERROR_RULES
    top: int = 10
    output: str | None = None
    #: Go on past files that cannot be read on, or vanish before they are read, instead of failing.
    skip_corrupt: bool = False


@dataclass(frozen=True)
class Analysis:
    """Result of a run: small tables that no longer depend on the log files."""

    #: ``metric, key, count, earliest, latest``: all counts and the time range (``plans.metrics``).
    summary: DataFrame
    metrics: DataFrame
    overview: DataFrame
    report: DataFrame = field(repr=False)
    #: ``lines``, ``malformed`` and ``invalid_utf8`` lines, observed in the same pass.
    observed: dict[str, int] = field(default_factory=dict)
    #: Where broken and missing files are skipped: the lines that were read of each listed file (of all of its name).
    lines_read: dict[str, int] = field(default_factory=dict)
    #: Listed files that were gone when they were to be read, where those are skipped.
    vanished: list[str] = field(default_factory=list)
    #: Where the analysis ended in each file, as a start for a monitor.
    positions: dict[str, int] | None = None


def observed_counts() -> list[Column]:
    """What is observed of the entries on their way to the counts."""
    return [
        F.count("*").alias("lines"),
        F.count_if("malformed").alias("malformed"),
        F.count_if(invalid_utf8(F.col("raw"))).alias("invalid_utf8"),
    ]


def analyze_lines(lines: DataFrame, options: Options = Options()) -> Analysis:
    """Analyse a DataFrame with ``raw`` and ``source_file``; reads it once.

    The summary of that one pass is checkpointed, and everything else derives from it. Malformed and invalid
    lines are observed beside it, without a pass of their own.
    """
    spark = tune(lines.sparkSession)
    ensure_checkpoint_dir(spark)
    reading = Observation("reading")
    entries = parse_logs(lines, options.pattern, options.timestamp_formats).select(*COUNTED_COLUMNS)
    entries = entries.observe(reading, *observed_counts())
    summary = summarize(entries, options.rules, options.keywords).checkpoint()
    metrics = metrics_of(summary)
    overview = overview_of(summary)
    report = report_lines(metrics, overview, options.top)
    write_report(report, options.output)
    observed = reading.get
    if observed["invalid_utf8"]:
        log.warning("%d of %d lines are not UTF-8", observed["invalid_utf8"], observed["lines"])
    return Analysis(summary, metrics, overview, report, observed)


def analyze(spark: SparkSession, paths: Sequence[str], options: Options = Options()) -> Analysis:
    """Analyse log files; missing ones are skipped with a warning.

    A file that vanishes or breaks off while it is read fails the run, or, with ``skip_corrupt``, is
    left out from there; the result then lists those that vanished, and how many lines each file gave.
    """
    lines = scan_logs(spark, paths, options.skip_corrupt)
    result = analyze_lines(lines, options)
    if not options.skip_corrupt:
        return result
    listed = lines.inputFiles()
    files = result.summary.filter(F.col("metric") == "file").select("key", "count").toLocalIterator()
    counts = {row["key"]: row["count"] for row in files}
    read = {path: counts.get(name_of(path), 0) for path in listed}
    if nothing := [path for path, count in read.items() if not count]:
        log.warning("%d files gave no line: %s", len(nothing), nothing[:20])
    return replace(result, vanished=vanished(spark, listed), lines_read=read)


def analyze_until_now(spark: SparkSession, path: str, options: Options = Options()) -> Analysis:
    """Analyse the finished lines of a mounted file, or the files of a pattern, as they are now.

    The result says where it ended in each file, so that a monitor can go on right there.
    """
    ends = finished_positions(path)
    return replace(analyze_lines(read_until(spark, ends), options), positions=ends)
