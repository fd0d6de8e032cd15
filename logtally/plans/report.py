"""The analysis report as rows, and where it goes."""

from __future__ import annotations

import logging

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtally.functions.levels import REPORT_ORDER
from logtally.functions.literal import literal_rows
from logtally.functions.render import HOUR_BAR, LEVEL_BAR, bar
from logtally.operators.counts import share, top_error_patterns

log = logging.getLogger(__name__)

# Rules and headings of the report.
DOUBLE_RULE = "═" * 70
RULE = "─" * 70
TITLE = "   LOG ANALYSIS REPORT"
HEADINGS = (
    "▶ OVERVIEW",
    "▶ LOG LEVEL DISTRIBUTION",
    "▶ TOP ERROR PATTERNS",
    "▶ KEYWORD SEARCH RESULTS",
    "▶ HOURLY ACTIVITY",
    "▶ PER-FILE STATISTICS",
)
# How the lines of the report are formatted.
TOTAL_FORMAT = "  Total Lines Read   : %,d"
PROCESSED_FORMAT = "  Parsed Entries     : %,d"
MALFORMED_FORMAT = "  Malformed Lines    : %,d"
EARLIEST_FORMAT = "  Earliest Timestamp : %s"
LATEST_FORMAT = "  Latest Timestamp   : %s"
LEVEL_FORMAT = "  %-8s : %,7d  (%5.1f%%)  %s"
PATTERN_FORMAT = "  %2d. %-40s  %,d occurrences"
NO_ERRORS = "  (no errors detected)"
KEYWORD_FORMAT = "  %-25s : %,d hits"
HOUR_FORMAT = "  %s  %,6d  %s"
FILE_FORMAT = "  %-40s  %,d lines"

OVERVIEW, LEVEL, PATTERN, KEYWORD, HOUR, FILE, END = range(1, 8)

# Section, place in the section (heading, rule, lines, blank), then rank and key among its lines.
ORDER = ("section", "place", "rank", "key")
LINES, BLANK = 2, 3


def _lines(rows: DataFrame, section: int, rank: Column, key: Column, line: Column) -> DataFrame:
    return rows.select(
        F.lit(section).alias("section"),
        F.lit(LINES).alias("place"),
        rank.cast("bigint").alias("rank"),
        key.alias("key"),
        line.alias("line"),
    )


def report_lines(metrics: DataFrame, overview: DataFrame, top: int = 10) -> DataFrame:
    """Lines of the report with the columns that order them (``ORDER``).

    Both inputs are read several times, so hand over materialized ones: one row of facts about the
    metrics is fetched here to choose the sections. No section is collected or numbered as a whole;
    files and hours sort by columns, whatever their number.
    """
    counted = metrics.filter(F.col("count") > 0)
    count, key, zero = F.col("count"), F.col("key"), F.lit(0)

    def of(metric: str) -> DataFrame:
        return counted.filter(F.col("metric") == metric).select("key", "count")

    facts = counted.agg(
        F.expr("coalesce(max(count) FILTER (WHERE metric = 'processed'), 0) AS total"),
        F.expr("max(count) FILTER (WHERE metric = 'hour') AS busiest"),
        *[F.expr(f"count(*) FILTER (WHERE metric = '{m}') AS {m}s") for m in ("pattern", "keyword", "hour", "file")],
    ).first()
    # Keywords and hours show only if there are any, files only if there are several.
    hidden = {KEYWORD: facts.keywords == 0, HOUR: facts.hours == 0, FILE: facts.files < 2}

    frame = [(0, 0, 0, "", ""), (0, 0, 1, "", DOUBLE_RULE), (0, 0, 2, "", TITLE), (0, 0, 3, "", DOUBLE_RULE)]
    frame += [(0, BLANK, 0, "", ""), (END, 0, 0, "", DOUBLE_RULE)]
    for section, heading in enumerate(HEADINGS, start=OVERVIEW):
        if not hidden.get(section):
            frame += [(section, 0, 0, "", heading), (section, 1, 0, "", RULE), (section, BLANK, 0, "", "")]
    if facts.patterns == 0:
        frame.append((PATTERN, LINES, 0, "", NO_ERRORS))

    def stamp(name: str) -> Column:
        return F.substring_index(F.col(name).cast("string"), ".", 1)

    overview_lines = [
        F.format_string(TOTAL_FORMAT, "total"),
        F.format_string(PROCESSED_FORMAT, "processed"),
        F.format_string(MALFORMED_FORMAT, "malformed"),
        F.when(F.col("earliest").isNotNull(), F.format_string(EARLIEST_FORMAT, stamp("earliest"))),
        F.when(F.col("latest").isNotNull(), F.format_string(LATEST_FORMAT, stamp("latest"))),
    ]
    overview_rows = overview.select(F.posexplode(F.array(*overview_lines)).alias("rank", "line"))
    overview_rows = overview_rows.filter(F.col("line").isNotNull())

    pct = share(count, F.lit(facts.total))
    level_rank = F.array_position(F.array(*map(F.lit, REPORT_ORDER)), key)
    patterns = top_error_patterns(of("pattern").withColumnRenamed("key", "pattern"), top)
    sections = [
        _lines(overview_rows, OVERVIEW, F.col("rank"), F.lit(""), F.col("line")),
        _lines(
            of("level"), LEVEL, level_rank, key,
            F.format_string(LEVEL_FORMAT, key, count, pct, bar(pct, LEVEL_BAR)),
        ),
        _lines(
            patterns, PATTERN, F.col("rank"), F.col("pattern"),
            F.format_string(PATTERN_FORMAT, "rank", "pattern", "count"),
        ),
        _lines(of("keyword"), KEYWORD, -count, key, F.format_string(KEYWORD_FORMAT, key, count)),
    ]
    if not hidden[HOUR]:
        hour_bar = bar(count * F.lit(100.0) / F.lit(facts.busiest), HOUR_BAR)
        sections.append(_lines(of("hour"), HOUR, zero, key, F.format_string(HOUR_FORMAT, key, count, hour_bar)))
    if not hidden[FILE]:
        sections.append(_lines(of("file"), FILE, -count, key, F.format_string(FILE_FORMAT, key, count)))
    rows = literal_rows(metrics.sparkSession, ", ".join((*ORDER, "line")), frame)
    for part in sections:
        rows = rows.unionByName(part)
    return rows


def write_report(lines: DataFrame, path: str | None) -> None:
    """Write the report as text, over an earlier one.

    A blank path means no file. Where the report cannot be written, that is a warning; a failure
    to compute it is an error like any other.
    """
    if not path or not path.strip():
        return
    try:
        lines.orderBy(*ORDER).select("line").write.mode("overwrite").text(path)
    except Py4JJavaError as error:
        if not is_instance_of(lines.sparkSession.sparkContext._gateway, error.java_exception, "java.io.IOException"):
            raise
        log.warning("could not write the report to %s: %s", path, error.java_exception.getMessage())


def print_report(lines: DataFrame) -> None:
    """Print the report; the driver holds one partition of it at a time."""
    for row in lines.orderBy(*ORDER).select("line").toLocalIterator():
        print(row.line)
