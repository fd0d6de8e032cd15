"""The closed set of log levels and the rules that map text onto it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from logtally.functions.text import java_trim

# The level names, in the order the fallback search tries them.
LEVELS = ("TRACE", "DEBUG", "INFO", "WARN", "ERROR", "FATAL", "UNKNOWN")
# The order in which reports list the levels.
REPORT_ORDER = ("FATAL", "ERROR", "WARN", "INFO", "DEBUG", "TRACE", "UNKNOWN")
# Other spellings of a level.
ALIASES = {"WARNING": "WARN", "SEVERE": "ERROR"}
# The levels that count as errors.
ERROR_LEVELS = ("ERROR", "FATAL")

UNKNOWN = "UNKNOWN"
KNOWN_LEVELS = tuple(name for name in LEVELS if name != UNKNOWN)


def token_level(token: Column) -> Column:
    """Map a token without blanks around it onto the closed set; anything else is UNKNOWN."""
    name = F.upper(token)
    level = F.when(name.isin(*KNOWN_LEVELS), name)
    for alias, meaning in ALIASES.items():
        level = level.when(name == alias, F.lit(meaning))
    return level.otherwise(F.lit(UNKNOWN))


def normalize_level(col: Column) -> Column:
    """Map a level text onto the closed set; anything else, null too, is UNKNOWN."""
    return token_level(java_trim(col))


def named_level(upper: Column) -> Column:
    """The first known name found in an upper-case line, tried in ``LEVELS`` order."""
    return reduce(
        lambda otherwise, name: F.when(F.contains(upper, F.lit(name)), F.lit(name)).otherwise(otherwise),
        reversed(KNOWN_LEVELS),
        F.lit(UNKNOWN),
    )


def fallback_level(raw: Column) -> Column:
    """Level of a line that does not match the pattern: ``ERROR ... stacktrace`` is TRACE."""
    return named_level(F.upper(raw))


def is_error_level(level: Column) -> Column:
    return level.isin(*ERROR_LEVELS)
