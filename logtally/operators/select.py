"""Filters, row expansion, ordering and identity over parsed entries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.functions.levels import is_error_level
from logtally.functions.patterns import (
    DEFAULT_KEYWORDS,
    ERROR_RULES,
    Rule,
    error_patterns_of,
    keywords_of,
)
from logtally.functions.text import contains_ignore_case
from logtally.operators.once import evaluate_once


def error_entries(entries: DataFrame) -> DataFrame:
    """Entries of level ERROR or FATAL."""
    return entries.filter(is_error_level(F.col("level")))


def keyword_lines(lines: DataFrame, keywords: Sequence[str] = DEFAULT_KEYWORDS) -> DataFrame:
    """Lines that hold at least one keyword, whatever its case."""
    tests = [contains_ignore_case(F.col("_lower"), kw) for kw in keywords]
    lines = evaluate_once(lines, "_lower", F.lower("raw"))
    return lines.filter(reduce(lambda a, b: a | b, tests, F.lit(False))).drop("_lower")


def keyword_search(lines: DataFrame, keywords: Sequence[str] = DEFAULT_KEYWORDS) -> DataFrame:
    """One row per line and list item found in it; an item listed twice counts twice."""
    lines = lines.withColumn("_lower", F.lower("raw"))
    return lines.select("*", F.explode(keywords_of(F.col("_lower"), keywords)).alias("keyword")).drop("_lower")


def error_pattern_rows(entries: DataFrame, rules: Sequence[Rule] = ERROR_RULES) -> DataFrame:
    """One row per error entry and pattern found in its message."""
    patterns = error_patterns_of(F.col("message"), rules)
    return error_entries(entries).select("*", F.explode(patterns).alias("pattern"))


def chronological(entries: DataFrame) -> DataFrame:
    """Entries by time, those without a time last.

    File and line break ties. That also lets the range partitioning of the sort split a time, or
    the missing time, that very many lines share.
    """
    return entries.orderBy(F.col("ts").asc_nulls_last(), "source_file", "line_number")


def dedupe_entries(entries: DataFrame) -> DataFrame:
    """One entry per file and line number: the one whose raw text sorts first.

    Takes lines that are not parsed yet as well, which is cheaper: less to move, less to parse.
    """
    keys = ["source_file", "line_number"]
    rest = ["raw", *(c for c in entries.columns if c not in (*keys, "raw"))]
    # An aggregate rather than a window, so that repeats are dropped before the shuffle.
    first = entries.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_first"))
    return first.select(*keys, "_first.*").select(*entries.columns)
