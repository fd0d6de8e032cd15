"""Follow a stream of log lines: running counts, time range, alerts and report, in one query."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logtally.operators.parse import parse_logs
from logtally.plans.analysis import Analysis, Options
from logtally.plans.metrics import SUMMARY_SCHEMA, add_up, metrics_of, overview_of, summarize
from logtally.plans.report import print_report, report_lines, write_report
from logtally.session import ensure_checkpoint_dir
from logtally.sources.tail import tail_logs
from logtally.streaming.live import POLL_MS, alert_table, alerts, print_alerts
from logtally.streaming.tables import MERGE_EVERY, BatchTable, is_marked, mark

#: Bytes that a micro-batch of a monitor reads at most, in whole lines.
MAX_BATCH_BYTES = 1 << 30

OnAlerts = Callable[[DataFrame, int], None]


def _added(rows: DataFrame) -> DataFrame:
    sums = (F.sum("count").alias("count"), F.min("earliest").alias("earliest"), F.max("latest").alias("latest"))
    return rows.groupBy("metric", "key").agg(*sums)


@dataclass(frozen=True)
class Monitor:
    """The running query and where it writes."""

    spark: SparkSession
    query: StreamingQuery
    folder: str
    options: Options = field(default_factory=Options)

    def _summary(self) -> DataFrame:
        """The batch's counts, if one is carried on, and those of the stream."""
        rows = _count_table(self.folder).read(self.spark)
        if is_marked(self.spark, _handed_over(self.folder)):
            rows = rows.unionByName(_before(self.folder).read(self.spark))
        return _added(rows)

    def metrics(self) -> DataFrame:
        """Every metric so far, the batch's included; all levels and totals from the start."""
        return add_up(metrics_of(self._summary()))

    def overview(self) -> DataFrame:
        """One row: total, processed and malformed lines, earliest and latest time."""
        return overview_of(self._summary())

    def report(self, top: int | None = None) -> DataFrame:
        """The lines of a report of everything so far, as the batch gives them (``plans.report``)."""
        # The report reads its inputs several times; meanwhile the stream may go on.
        summary = self._summary().checkpoint()
        return report_lines(add_up(metrics_of(summary)).checkpoint(), overview_of(summary), top or self.options.top)

    def alerts(self) -> DataFrame:
        """The raw line of every ERROR or FATAL entry of the stream."""
        return alert_table(f"{self.folder}/alerts").read(self.spark)

    def process_available(self) -> None:
        """Wait until all lines that are there now are counted."""
        self.query.processAllAvailable()

    def stop(self, output: str | None = None, show: bool = False) -> DataFrame:
        """Stop, and return the report of what was seen; it is written to ``output`` (else that of the options) and printed on request."""
        self.query.stop()
        last = self.report()
        write_report(last, output or self.options.output)
        if show:
            print_report(last)
        return last


def _count_table(folder: str, merge_every: int = MERGE_EVERY) -> BatchTable:
    return BatchTable(f"{folder}/counts", SUMMARY_SCHEMA, _added, merge_every)


def _before(folder: str) -> BatchTable:
    return BatchTable(f"{folder}/before", SUMMARY_SCHEMA, _added)


def _handed_over(folder: str) -> str:
    """The marker that the batch's counts are there as a whole; it is written last of all."""
    return f"{folder}/before/_whole"


def hand_over(spark: SparkSession, folder: str, batch: Analysis) -> None:
    """Store a batch's counts to be carried on, unless that was done. One that broke off is done again."""
    if not is_marked(spark, _handed_over(folder)):
        _before(folder).write(batch.summary, 0)
        mark(spark, _handed_over(folder))


def follow(
    lines: DataFrame,
    folder: str,
    options: Options = Options(),
    batch: Analysis | None = None,
    poll_ms: int | None = POLL_MS,
    merge_every: int = MERGE_EVERY,
    on_alerts: OnAlerts | None = None,
) -> Monitor:
    """Count a stream of lines and write out alerts, from one reading and parsing of each line.

    Each micro-batch adds its own counts to a table, so no state grows with the stream. A micro-batch is
    cached while it is counted, so give the source a limit (``monitor`` does). Everything goes
    below ``folder``, which executors must reach; called again with the same folder it goes on where it
    was stopped. The results of a batch are stored there at the first start and carried on; later starts
    leave them as they are. ``on_alerts`` gets the alerts of each micro-batch that has some, and its number; one
    that is repeated after a failure shows them again. ``poll_ms=None`` takes what is there and ends.
    """
    spark = lines.sparkSession
    ensure_checkpoint_dir(spark)
    if batch is not None:
        hand_over(spark, folder, batch)
    counts, alerted = _count_table(folder, merge_every), alert_table(f"{folder}/alerts", merge_every)

    def add(entries: DataFrame, number: int) -> None:
        entries.persist()
        try:
            counts.write(summarize(entries, options.rules, options.keywords), number)
            alerted.write(alerts(entries), number)
            if on_alerts is not None:
                fresh = alerted.of_batch(spark, number)
                if not fresh.isEmpty():
                    on_alerts(fresh, number)
        finally:
            entries.unpersist()

    entries = parse_logs(lines, options.pattern, options.timestamp_formats)
    writer = entries.writeStream.option("checkpointLocation", f"{folder}/state").foreachBatch(add)
    every = {"availableNow": True} if poll_ms is None else {"processingTime": f"{poll_ms} milliseconds"}
    return Monitor(spark, writer.trigger(**every).start(), folder, options)


def monitor(
    spark: SparkSession,
    path: str,
    folder: str,
    options: Options = Options(),
    start: str | dict[str, int] | None = None,
    batch: Analysis | None = None,
    poll_ms: int | None = POLL_MS,
    merge_every: int = MERGE_EVERY,
    max_batch_bytes: int = MAX_BATCH_BYTES,
    on_alerts: OnAlerts | None = print_alerts,
) -> Monitor:
    """Follow the lines appended to a file, or to the files of a pattern, see :func:`follow`.

    ``start`` says where in the files to begin the first time: ``end``, ``beginning`` or byte positions
    per path. By default it is where ``batch`` ended, if it says so (:func:`analyze_until_now`), so no line is
    missed or counted twice; else the end of the files. A backlog is read ``max_batch_bytes`` at a time. Alerts
    are printed as they come unless ``on_alerts`` is something else. ``poll_ms=None`` takes what is there
    and returns when that is done.
    """
    if start is None:
        start = batch.positions if batch is not None and batch.positions is not None else "end"
    lines = tail_logs(spark, path, start, maxBytesPerBatch=str(max_batch_bytes))
    live = follow(lines, folder, options, batch, poll_ms or 0, merge_every, on_alerts)
    if poll_ms is None:
        live.process_available()
        live.query.stop()
    return live
