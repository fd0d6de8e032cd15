"""Metrics and alerts over a stream of lines, with the parser and the rules of the batch.

A streaming query counts everything the batch does, malformed lines, hours and error patterns
included.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from logtally.functions.patterns import DEFAULT_KEYWORDS, ERROR_RULES, Rule
from logtally.operators.select import error_entries
from logtally.plans.metrics import metric_rows
from logtally.streaming.tables import MERGE_EVERY, METRIC_SCHEMA, BatchTable, newest_of

POLL_MS = 500
ALERT_SCHEMA = "source_file string, level string, raw string"
#: Of running metrics that expire.
EPOCH_SCHEMA = "metric string, key string, epoch bigint, count bigint"
TIME_RANGE_SCHEMA = "earliest timestamp_ntz, latest timestamp_ntz"


def running_metrics(
    entries: DataFrame,
    rules: Sequence[Rule] = ERROR_RULES,
    keywords: Sequence[str] = DEFAULT_KEYWORDS,
    expire: str | None = None,
) -> DataFrame:
    """``metric, key, count`` so far, as an aggregate to be written in update mode.

    The state holds a row per key. Exception names, hours and files add keys over time, and without
    ``expire`` they stay. With it (a duration such as ``10 minutes``) counts are kept by ``epoch``, a stretch of the
    processing time of that length: the state drops an epoch's keys once two more have begun, while its last
    counts stay in the update table, and the epochs add up to the exact totals (:func:`add_up`). Lines are put
    into the epoch in which they arrive, so none can be late.
    """
    rows = metric_rows(entries, rules, keywords)
    if expire is None:
        return rows.groupBy("metric", "key").count()
    arrived = rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", expire)
    counts = arrived.groupBy(F.window("_arrived", expire).alias("window"), "metric", "key").count()
    return counts.select("metric", "key", F.unix_micros("window.start").alias("epoch"), "count")


def running_time_range(entries: DataFrame) -> DataFrame:
    """Earliest and latest time so far."""
    return entries.groupBy().agg(F.min("ts").alias("earliest"), F.max("ts").alias("latest"))


def alerts(entries: DataFrame) -> DataFrame:
    """The raw line of every ERROR or FATAL entry."""
    return error_entries(entries).select("source_file", "level", "raw")


def _writer(stream: DataFrame, mode: str, checkpoint: str, poll_ms: int | None) -> DataStreamWriter:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if poll_ms is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{poll_ms} milliseconds")


def start_updates(
    running: DataFrame,
    checkpoint: str,
    on_update: Callable[[DataFrame, int], None],
    poll_ms: int | None = POLL_MS,
) -> StreamingQuery:
    """Hand the changed rows of each micro-batch, and its number, to ``on_update``.

    ``poll_ms=None`` takes what is there and ends. Stop the query with its ``stop()``; started
    again with the same checkpoint it goes on where it was.
    """
    return _writer(running, "update", checkpoint, poll_ms).foreachBatch(on_update).start()


def update_table(
    folder: str, keys: Sequence[str] | None = None, merge_every: int = MERGE_EVERY
) -> Callable[[DataFrame, int], None]:
    """An ``on_update`` that keeps the newest row of every key, see :class:`BatchTable`.

    The keys are those of running metrics if the updates have them, else none.
    """

    def write(updates: DataFrame, number: int) -> None:
        own = _keys_of(updates, keys)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in updates.schema)
        BatchTable(folder, schema, newest_of(own), merge_every).write(updates, number)

    return write


def _keys_of(updates: DataFrame, keys: Sequence[str] | None) -> list[str]:
    return [c for c in ("metric", "key", "epoch") if c in updates.columns] if keys is None else list(keys)


def latest(spark: SparkSession, folder: str, schema: str = METRIC_SCHEMA, keys: Sequence[str] | None = None) -> DataFrame:
    """The newest row of every key in an update table; empty before the first micro-batch."""
    own = _keys_of(spark.createDataFrame([], schema), keys)
    return BatchTable(folder, schema, newest_of(own)).read(spark)


def start_alerts(
    entries: DataFrame,
    checkpoint: str,
    folder: str | None = None,
    poll_ms: int | None = POLL_MS,
) -> StreamingQuery:
    """Write alerts to a table that :func:`read_alerts` reads, or to the console."""
    writer = _writer(alerts(entries), "append", checkpoint, poll_ms)
    if folder is None:
        return writer.format("console").option("truncate", False).start()
    return writer.foreachBatch(alert_table(folder).write).start()


def print_alerts(rows: DataFrame, number: int, most: int = 100) -> None:
    """Print the alerts of a micro-batch, one line each; of very many the first, and how many there are."""
    shown = rows.select("source_file", "raw").limit(most + 1).collect()
    for row in shown[:most]:
        print(f"ALERT {row.source_file}: {row.raw}", flush=True)
    if len(shown) > most:
        print(f"ALERT {rows.count()} in all in micro-batch {number}", flush=True)


def alert_table(folder: str, merge_every: int = MERGE_EVERY) -> BatchTable:
    """Alerts by micro-batch; merging makes few files of many."""
    return BatchTable(folder, ALERT_SCHEMA, None, merge_every)


def read_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """All alerts so far."""
    return alert_table(folder).read(spark)
