"""Event time on streams: hourly counts that are final, and lines that are delivered more than once.

Times of entries have no zone, watermarks need one: event time is the time of the entry read as UTC,
so it has no gaps and nothing depends on the session's zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logtally.functions.timestamps import hour_label

#: How far behind the latest line of all a line may be and still be counted.
DELAY = "1 hour"
EVENT_TIME = "_event_time"


def event_time(ts: Column) -> Column:
    """The time of an entry as a point in time, read as UTC."""
    since = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
    return F.timestamp_micros(since)


def with_event_time(entries: DataFrame, delay: str = DELAY) -> DataFrame:
    """Entries with a watermark that follows the latest time seen by ``delay``."""
    return entries.withColumn(EVENT_TIME, event_time(F.col("ts"))).withWatermark(EVENT_TIME, delay)


def windowed_hours(entries: DataFrame, delay: str = DELAY) -> DataFrame:
    """``hour, count`` of a stream, each hour once, when the watermark has passed its end (append mode).

    Lines may come in any order within ``delay``; those that come after their hour was closed are left out,
    see :func:`late_rows`. The state holds the hours that are still open, whatever the stream's length.
    Entries without a time do not count. Entries that have a watermark already keep it.
    """
    timed = entries if EVENT_TIME in entries.columns else with_event_time(entries, delay)
    counts = timed.groupBy(F.window(EVENT_TIME, "1 hour").alias("window")).count()
    number = F.floor(F.unix_timestamp("window.start") / 3600).cast("bigint")
    return counts.select(hour_label(number).alias("hour"), "count")


def distinct_lines(entries: DataFrame, keys: tuple[str, ...] = ("file_path", "byte_offset"), delay: str = DELAY) -> DataFrame:
    """Each line of a stream once, though it may be delivered several times, say by two streams of one file.

    A line is known by its file and place, and remembered until the watermark has passed it by ``delay``; so
    the state does not grow with the stream, and copies may be as far apart as that. Entries without a time pass
    no watermark and would be remembered for ever, so they are left as they are: use ``dedupe_entries`` in
    a batch for those. Lines behind the watermark are dropped and counted by :func:`late_rows`.
    """
    timed = entries if EVENT_TIME in entries.columns else with_event_time(entries, delay)
    return timed.filter(F.col(EVENT_TIME).isNotNull()).dropDuplicatesWithinWatermark([*keys])


def late_rows(query: StreamingQuery) -> int:
    """How many rows a query has dropped for coming after its watermark, as far as its progress is kept.

    Behind :func:`distinct_lines` these are lines; directly before windows, Spark counts the groups that a task
    has made of its late lines.
    """
    return sum(state["numRowsDroppedByWatermark"] for progress in query.recentProgress for state in progress["stateOperators"])


def state_rows(query: StreamingQuery) -> int:
    """The rows that a query's operators hold now."""
    progress = query.lastProgress
    return sum(state["numRowsTotal"] for state in progress["stateOperators"]) if progress else 0
