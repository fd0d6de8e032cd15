"""Line pattern matching with one regex evaluation per line."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from logtally.functions.text import java_trim

# Timestamp, level, thread, logger, message.
DEFAULT_PATTERN = (
    r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?)\s+"
    r"(TRACE|DEBUG|INFO|WARN|WARNING|ERROR|FATAL|SEVERE)\s+"
    r"\[?([^\]]+?)\]?\s+([\w\.]+)\s+-\s+(.*)$"
)

FIELDS = 5
_MARK = "\u0001"


def group_count(pattern: str) -> int:
    """Number of capturing groups, as Spark's regex engine counts them; raises on a bad pattern."""
    jvm = SparkSession.active().sparkContext._jvm
    return jvm.java.util.regex.Pattern.compile(pattern).matcher("").groupCount()


def field_count(pattern: str) -> int:
    """How many of the five fields the pattern supplies (timestamp and level at least)."""
    groups = group_count(pattern)
    if groups < 2:
        raise ValueError("a line pattern needs a group for the timestamp and one for the level")
    return min(groups, FIELDS)


def match_fields(raw: Column, pattern: str = DEFAULT_PATTERN) -> Column:
    """Captured fields of the trimmed line as an array, or a one-element array if it does not match.

    The whole line must match, and a line of white space never does. All fields come out of a
    single replace-and-split on a control character, with blanks left around them. A line that
    holds control characters itself is matched group by group.
    """
    fields = range(1, field_count(pattern) + 1)
    whole = rf"\A(?!\p{{javaWhitespace}}*\z)(?:{pattern})\z"
    joined = F.regexp_replace(F.trim(raw), F.lit(whole), F.lit(_MARK.join(f"${i}" for i in fields)))
    line = java_trim(raw)
    one_by_one = F.when(
        line.rlike(whole), F.array(*[java_trim(F.regexp_extract(line, whole, i)) for i in fields])
    ).otherwise(F.array(line))
    return F.when(raw.rlike(r"[\x00-\x1f]"), one_by_one).otherwise(F.split(joined, _MARK, -1))
