"""Raw lines to typed log entries, with column expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.functions.levels import UNKNOWN, named_level, token_level
from logtally.functions.matching import DEFAULT_PATTERN, field_count, match_fields
from logtally.functions.timestamps import DEFAULT_FORMATS, hour_bucket, iso_local, read_timestamp
from logtally.operators.once import evaluate_once

ABSENT = "unknown"


def parse_logs(
    lines: DataFrame,
    pattern: str = DEFAULT_PATTERN,
    timestamp_formats: Sequence[str] = DEFAULT_FORMATS,
) -> DataFrame:
    """Add the columns of a parsed entry to a DataFrame with a ``raw`` line column.

    A line that matches the pattern as a whole yields its fields. Any other line keeps only the
    level named somewhere in it, and its own text as the message. Groups the pattern does not
    have read ``unknown`` (thread, logger) or the raw line (message). ``malformed`` marks entries
    with neither level nor timestamp; ``hour`` is the ``yyyy-MM-dd HH`` bucket.
    """
    count = field_count(pattern)
    raw, fields = F.col("raw"), F.col("_fields")
    lines = lines.withColumn("raw", F.coalesce(raw, F.lit("")))
    matched = evaluate_once(lines, "_fields", match_fields(raw, pattern))
    # The fields become columns of their own, null where the pattern does not match, so that what
    # follows refers to them instead of repeating how they are made.
    names = ("_ts", "_level", "thread", "logger", "message")[:count]
    is_match = F.size(fields) == count
    texts = matched.withColumns(
        {name: F.when(is_match, F.trim(F.get(fields, F.lit(i)))) for i, name in enumerate(names)}
        | {"_upper": F.when(~is_match, F.upper(raw))}
    )
    absent = {"thread": F.lit(ABSENT), "logger": F.lit(ABSENT), "message": raw}
    defaults = {
        name: F.coalesce(F.col(name), value) if name in names else value for name, value in absent.items()
    }
    level = F.when(F.col("_level").isNull(), named_level(F.col("_upper"))).otherwise(token_level(F.col("_level")))
    entries = texts.withColumns(
        {"ts": read_timestamp(F.col("_ts"), timestamp_formats), "level": level, **defaults}
    ).drop("_fields", "_ts", "_level", "_upper")
    return entries.withColumns(
        {
            "malformed": (F.col("level") == UNKNOWN) & F.col("ts").isNull(),
            "hour": hour_bucket(F.col("ts")),
        }
    )


def entry_display(entries: DataFrame) -> DataFrame:
    """Add ``display``: ``[level] timestamp logger - message``."""
    ts = F.coalesce(iso_local(F.col("ts")), F.lit("null"))
    text = F.concat(F.lit("["), "level", F.lit("] "), ts, F.lit(" "), "logger", F.lit(" - "), "message")
    return entries.withColumn("display", text)
