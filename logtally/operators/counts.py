"""Single counts over lines and entries, and their rankings and shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtally.functions.levels import REPORT_ORDER
from logtally.functions.literal import literal_rows
from logtally.functions.patterns import BASELINE_RULES, DEFAULT_KEYWORDS, ERROR_RULES, Rule
from logtally.functions.render import HOUR_BAR, LEVEL_BAR, bar
from logtally.functions.timestamps import hour_label, hour_number
from logtally.operators.select import error_pattern_rows, keyword_search


def overview(entries: DataFrame) -> DataFrame:
    """One row: total, processed and malformed lines, earliest and latest time."""
    return entries.agg(
        F.count("*").alias("total"),
        F.count("*").alias("processed"),
        F.count_if("malformed").alias("malformed"),
        F.min("ts").alias("earliest"),
        F.max("ts").alias("latest"),
    )


def level_counts(entries: DataFrame) -> DataFrame:
    """Lines per level, all seven levels present."""
    levels = literal_rows(entries.sparkSession, "ordinal, level", list(enumerate(REPORT_ORDER)))
    # At most seven rows on either side.
    counts = F.broadcast(entries.groupBy("level").count())
    return levels.join(counts, "level", "left").select(
        "level", F.coalesce("count", F.lit(0)).alias("count"), "ordinal"
    )


def error_patterns(entries: DataFrame, rules: Sequence[Rule] = ERROR_RULES) -> DataFrame:
    """Hits per error pattern."""
    return error_pattern_rows(entries, rules).groupBy("pattern").count()


def baseline_patterns(entries: DataFrame) -> DataFrame:
    """Hits per error pattern with the shorter rule list of the baseline analysis."""
    return error_patterns(entries, BASELINE_RULES)


def keyword_hits(lines: DataFrame, keywords: Sequence[str] = DEFAULT_KEYWORDS) -> DataFrame:
    """Hits per keyword; a keyword without hits has no row."""
    return keyword_search(lines.select("raw"), keywords).groupBy("keyword").count()


def hourly_activity(entries: DataFrame) -> DataFrame:
    """Lines per hour; an hour without lines has no row."""
    ts = F.col("ts")
    # Entries without a time form a group of count 0. A filter in front would read every time twice.
    hours = entries.groupBy(hour_number(ts).alias("_hour")).agg(F.count(ts).alias("count"))
    return hours.filter(F.col("count") > 0).select(hour_label(F.col("_hour")).alias("hour"), "count")


def file_counts(lines: DataFrame) -> DataFrame:
    """Lines per file."""
    return lines.groupBy("source_file").count()


def ranked(counts: DataFrame, key: str) -> DataFrame:
    """Largest count first, ties by name."""
    return counts.orderBy(F.desc("count"), key)


def top_error_patterns(patterns: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent patterns, numbered from 1."""
    order = (F.desc("count"), F.asc("pattern"))
    # The window sees the n rows that are left.
    return patterns.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def share(count: Column, whole: Column) -> Column:
    """Percentage; 0 of nothing."""
    return F.when(whole > 0, count * F.lit(100.0) / whole).otherwise(F.lit(0.0))


def level_distribution(levels: DataFrame) -> DataFrame:
    """Share and bar of every level that occurs, most severe first."""
    whole = F.sum("count").over(Window.partitionBy())  # of seven rows
    shares = levels.withColumn("pct", share(F.col("count"), whole)).filter(F.col("count") > 0)
    return shares.withColumn("bar", bar(F.col("pct"), LEVEL_BAR)).orderBy("ordinal")


def hourly_profile(hours: DataFrame) -> DataFrame:
    """Every hour in order, with its share of the busiest hour and a bar."""
    busiest = hours.agg(F.max("count")).scalar()
    shares = hours.withColumn("pct", F.col("count") * F.lit(100.0) / busiest)
    return shares.withColumn("bar", bar(F.col("pct"), HOUR_BAR)).orderBy("hour")
