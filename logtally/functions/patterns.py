"""Error categories and keywords: rules as data, matched per line with column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from logtally.functions.text import contains_ignore_case

Rule = tuple[str, str]

# Name of the category, and what to find in the message, whatever its case.
ERROR_RULES: tuple[Rule, ...] = (
    ("NullPointerException", r"NullPointerException"),
    ("OutOfMemoryError", r"OutOfMemoryError"),
    ("Timeout/TimedOut", r"timeout|timed.?out"),
    ("Connection Failure", r"connection.?(refused|reset|closed)"),
    ("SQL/Deadlock", r"SQLException|deadlock"),
)
# The shorter list of the baseline analysis.
BASELINE_RULES: tuple[Rule, ...] = ERROR_RULES[:2]
# The first word that ends in Exception or Error, case-sensitive. The look-around
# is \b with ASCII word characters on every Java version.
EXCEPTION_NAME = r"(?<!\w)(\w*(?:Exception|Error))(?!\w)"
EXCEPTION_WORDS = ("Exception", "Error")
# Keywords searched for by default.
DEFAULT_KEYWORDS = ("Exception", "Error", "timeout", "fail", "OOM")


def rule_matches(message: Column, regex: str) -> Column:
    return message.rlike("(?i)" + regex)


def exception_name(message: Column) -> Column:
    """First exception or error name in the message, null if there is none."""
    has_word = reduce(lambda a, b: a | b, [F.contains(message, F.lit(word)) for word in EXCEPTION_WORDS])
    return F.when(has_word, F.nullif(F.regexp_extract(message, EXCEPTION_NAME, 1), F.lit("")))


def error_patterns_of(message: Column, rules: Sequence[Rule] = ERROR_RULES) -> Column:
    """Array of pattern names: each matching rule once, then the exception name.

    A name is not merged with the rule of the same name, so it appears, and counts, twice.
    """
    hits = [F.when(rule_matches(message, regex), F.lit(name)) for name, regex in rules]
    return F.array_compact(F.array(*hits, exception_name(message)))


def keywords_of(lower: Column, keywords: Sequence[str] = DEFAULT_KEYWORDS) -> Column:
    """Array of the listed keywords found in the lower-case raw line, once per list item."""
    hits = [F.when(contains_ignore_case(lower, kw), F.lit(kw)) for kw in keywords]
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
