"""Small string helpers shared by the parser and the keyword operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character up to and including the blank: what java.lang.String.trim strips.
TRIM_CHARS = "".join(map(chr, range(0x21)))


def java_trim(col: Column) -> Column:
    """Strip control characters and blanks (tabs too) from both ends."""
    return F.btrim(col, F.lit(TRIM_CHARS))


def contains_ignore_case(lower: Column, needle: str) -> Column:
    """Substring test of a text in lower case; ``needle`` is plain text of any case."""
    return F.contains(lower, F.lower(F.lit(needle)))
