from __future__ import annotations

import datetime as dt

import pytest
from conftest import KEYWORDS
from pyspark.sql import functions as F

import logtally as lt
from logtally.functions.levels import LEVELS
from logtally.plans.metrics import metric_rows

EVENTS = "/root/testdata/sf0.001/events.parquet"


@pytest.fixture(scope="module")
def lines(spark):
    return lt.log_lines_from_events(spark.read.parquet(EVENTS))


def as_dict(metrics):
    return {(r.metric, r.key): r["count"] for r in metrics.collect()}


def test_end_to_end_file(spark, tmp_path):
    def line(i, level, message):
        return f"2024-06-01 10:00:{i % 60:02}.000 {level} [main] com.App - {message}"

    text = [line(i, "INFO", f"msg {i}") for i in range(100)]
    text += [line(i, "ERROR", "NullPointerException occurred") for i in range(20)]
    text += [line(i, "WARN", f"warning {i}") for i in range(5)]
    path = tmp_path / "app.log"
    path.write_text("\n".join(text) + "\n")
    metrics = as_dict(lt.analyze(spark, [str(path)]).metrics)
    assert metrics["total", ""] == metrics["processed", ""] == 125
    assert [metrics["level", name] for name in ("INFO", "ERROR", "WARN", "FATAL")] == [100, 20, 5, 0]
    # The category and the exception name are one key, counted twice.
    assert metrics["pattern", "NullPointerException"] == 40
    assert metrics["hour", "2024-06-01 10"] == metrics["file", "app.log"] == 125


def test_single_counts_agree_with_the_one_pass_metrics(lines):
    entries = lt.parse_logs(lines)
    metrics = as_dict(lt.all_metrics(entries, keywords=KEYWORDS))
    single = {
        "level": lt.level_counts(entries).select("level", "count"),
        "pattern": lt.error_patterns(entries),
        "keyword": lt.keyword_hits(lines, KEYWORDS),
        "hour": lt.hourly_activity(entries),
        "file": lt.file_counts(lines),
    }
    for metric, counts in single.items():
        assert {r[0]: r[1] for r in counts.collect()} == {k: n for (m, k), n in metrics.items() if m == metric}
    total = lt.overview(entries).first()
    assert total == lt.overview_of(lt.summarize(entries)).first()
    assert (total.total, total.processed, total.malformed) == tuple(
        metrics[name, ""] for name in ("total", "processed", "malformed")
    )


def test_row_by_row_metrics_agree(lines):
    entries = lt.parse_logs(lines)
    rows = metric_rows(entries, keywords=KEYWORDS).groupBy("metric", "key").count()
    assert as_dict(lt.add_up(rows)) == as_dict(lt.all_metrics(entries, keywords=KEYWORDS))


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_partitions_make_no_difference(lines, partitions):
    entries = lt.parse_logs(lines)
    spread = lt.parse_logs(lines.repartition(partitions))
    assert as_dict(lt.all_metrics(spread)) == as_dict(lt.all_metrics(entries))


def test_sums(spark):
    metrics = as_dict(lt.all_metrics(lt.parse_logs(lt.generate_logs(spark, 2000, 3, seed=5))))

    def total(metric):
        return sum(n for (m, _), n in metrics.items() if m == metric)

    assert total("level") == total("file") == metrics["processed", ""] == metrics["total", ""]
    assert total("hour") == metrics["total", ""] - metrics["malformed", ""] == 6000
    assert metrics["level", "UNKNOWN"] == metrics["malformed", ""] > 0


def test_nothing_to_count(lines_of):
    entries = lt.parse_logs(lines_of())
    expected = {("total", ""): 0, ("processed", ""): 0, ("malformed", ""): 0} | {("level", n): 0 for n in LEVELS}
    assert as_dict(lt.all_metrics(entries)) == expected
    assert lt.overview_of(lt.summarize(entries)).first() == (0, 0, 0, None, None)
    assert lt.level_counts(entries).filter("count = 0").count() == 7


@pytest.mark.parametrize(
    ("message", "patterns"),
    [
        ("a com.x.JsonParseException: b", ["JsonParseException"]),
        ("Server Error for", ["Error"]),
        ("ErrorHandler x", []),
        ("someerror", []),
        ("éError", ["Error"]),
        ("call TIMED-OUT, then Timed out", ["Timeout/TimedOut"]),
        ("connectionRefused; connection  reset", ["Connection Failure"]),
        ("DEADLOCK in outofmemoryerror", ["OutOfMemoryError", "SQL/Deadlock"]),
        ("OutOfMemoryError and NullPointerException", ["NullPointerException", "OutOfMemoryError", "OutOfMemoryError"]),
    ],
)
def test_error_patterns(lines_of, message, patterns):
    lines = lines_of(f"2024-06-01 08:15:32 FATAL [t] l - {message}", f"2024-06-01 08:15:32 WARN [t] l - {message}")
    rows = lt.error_pattern_rows(lt.parse_logs(lines))
    assert sorted(r.pattern for r in rows.collect()) == sorted(patterns)


def test_keywords_keep_their_spelling_and_repeats(lines_of):
    lines = lines_of("An Error: a.b fail", "a+b")
    keywords = ["error", "Error", "a.b", "zzz", "error"]
    expected = {"Error": 1, "a.b": 1, "error": 2}
    assert {r.keyword: r["count"] for r in lt.keyword_hits(lines, keywords).collect()} == expected
    metrics = as_dict(lt.all_metrics(lt.parse_logs(lines), keywords=keywords))
    assert {k: n for (m, k), n in metrics.items() if m == "keyword"} == expected
    assert lt.keyword_lines(lines, keywords).count() == 1
    assert lt.keyword_lines(lines, []).count() == lt.keyword_hits(lines, []).count() == 0


def test_rankings(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 9), ("d", 1)], "pattern string, count bigint")
    top = [(r.rank, r.pattern) for r in lt.top_error_patterns(counts, 3).collect()]
    assert top == [(1, "c"), (2, "a"), (3, "b")]
    assert [r.pattern for r in lt.ranked(counts, "pattern").collect()] == ["c", "a", "b", "d"]


def test_chronological_order(lines_of):
    stamps = ["2024-06-01 08:15:32", "no time", "2024-06-01 08:15:31.999", "2024-06-01 08:15:32"]
    lines = lines_of(*(f"{s} INFO [t] l - m" for s in stamps))
    assert [r.line_number for r in lt.chronological(lt.parse_logs(lines)).collect()] == [3, 1, 4, 2]


def test_dedupe_keeps_one_entry_per_file_and_line(lines_of):
    lines = lines_of("b", "x").union(lines_of("a", "x")).union(lines_of("c", source_file="other.log"))
    entries = lt.dedupe_entries(lt.parse_logs(lines.repartition(4)))
    rows = entries.orderBy("source_file", "line_number").select("source_file", "line_number", "raw").collect()
    assert rows == [("app.log", 1, "a"), ("app.log", 2, "x"), ("other.log", 1, "c")]


def test_shares(spark):
    hours = spark.createDataFrame([("2024-01-01 01", 1), ("2024-01-01 00", 8)], "hour string, count bigint")
    rows = lt.hourly_profile(hours).collect()
    assert [(r.hour, r.pct) for r in rows] == [("2024-01-01 00", 100.0), ("2024-01-01 01", 12.5)]
    assert [r.bar.count("█") for r in rows] == [40, 5] and {len(r.bar) for r in rows} == {40}


def test_hour_of_a_zone_with_a_gap(lines_of):
    lines = lines_of("2024-03-10 02:30:00 INFO [t] l - m")
    assert lt.hourly_activity(lt.parse_logs(lines)).first() == ("2024-03-10 02", 1)


def test_lines_are_counted_in_one_exchange(lines):
    """Additive keys: a task has a group for each file, hour and name, and not for their combinations."""
    plan = lt.all_metrics(lt.parse_logs(lines))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange hashpartitioning(" in plan
    assert plan.count("partial_sum") == 1 and "Expand" in plan
    assert "BatchEvalPython" not in plan
    assert "partial_sum" in plan[plan.index("Exchange hashpartitioning") :]  # nothing but partial groups passes it


def test_groups_do_not_multiply(spark):
    """100 files, 100 hours and 100 names in all combinations are some 300 rows before the exchange."""
    lines = spark.range(10_000).selectExpr(
        "concat(id % 100, '.log') AS source_file", "id AS line_number",
        "date_format(timestamp'2024-06-01' + make_interval(0, 0, 0, 0, CAST(id DIV 100 AS INT)), 'yyyy-MM-dd HH:mm:ss') || ' ERROR [t] l - E' || id * 7 % 100 || 'Error' AS raw",
    ).coalesce(1)
    metrics = lt.all_metrics(lt.parse_logs(lines))
    rows = {(r.metric, r.key): r["count"] for r in metrics.collect()}
    assert sum(m == "hour" for m, _ in rows) == sum(m == "file" for m, _ in rows) == sum(m == "pattern" for m, _ in rows) == 100
    plan = metrics._jdf.queryExecution().executedPlan().finalPhysicalPlan().toString()
    assert "Exchange" in plan and len(rows) < 330


def test_generated_logs_do_not_depend_on_partitions(spark):
    one = lt.generate_logs(spark, 300, 2, seed=1)
    ids = spark.range(600).repartition(7)
    records = ids.select((F.floor(F.col("id") / 300) + 1).alias("file"), (F.col("id") % 300).alias("record"))
    two = lt.write_records(records, 1)
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    assert not lt.generate_logs(spark, 300, 2, seed=2).exceptAll(one).isEmpty()


def test_generated_clock_across_blocks(spark, monkeypatch):
    """Summing in blocks gives the same clock as one running sum."""
    whole = lt.generate_logs(spark, 500, 2).collect()
    monkeypatch.setattr("logtally.sources.synthetic.BLOCK", 64)
    assert sorted(lt.generate_logs(spark, 500, 2).collect()) == sorted(whole)
    first = min(r.raw for r in whole if r.source_file == "app_2.log" and r.part == 0)
    assert dt.datetime.fromisoformat(first[:19]) == dt.datetime(2024, 6, 1, 16)
