"""Analysis of application logs on Spark: parse, count, rank, report, in batch and as a stream."""

from logtally.operators.counts import (
    baseline_patterns,
    error_patterns,
    file_counts,
    hourly_activity,
    hourly_profile,
    keyword_hits,
    level_counts,
    level_distribution,
    overview,
    ranked,
    top_error_patterns,
)
from logtally.operators.heavy import heavy_error_patterns
from logtally.operators.parse import entry_display, parse_logs
from logtally.operators.ranges import chronological_once
from logtally.operators.select import (
    chronological,
    dedupe_entries,
    error_entries,
    error_pattern_rows,
    keyword_lines,
    keyword_search,
)
from logtally.plans.analysis import Analysis, Options, analyze, analyze_lines, analyze_until_now
from logtally.plans.metrics import add_up, all_metrics, metrics_of, overview_of, summarize
from logtally.plans.monitor import Monitor, follow, hand_over, monitor
from logtally.plans.report import print_report, report_lines, write_report
from logtally.sources.events import log_lines_from_events
from logtally.sources.files import scan_logs, scan_numbered_logs, stream_logs, vanished, write_logs
from logtally.sources.synthetic import generate_logs, write_records
from logtally.sources.tail import finished_positions, read_until, tail_logs
from logtally.streaming.live import (
    EPOCH_SCHEMA,
    TIME_RANGE_SCHEMA,
    alerts,
    latest,
    print_alerts,
    read_alerts,
    running_metrics,
    running_time_range,
    start_alerts,
    start_updates,
    update_table,
)
from logtally.streaming.tables import BatchTable
from logtally.streaming.windows import distinct_lines, late_rows, state_rows, windowed_hours, with_event_time

__all__ = [name for name in dir() if not name.startswith("_")]
