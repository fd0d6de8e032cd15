from __future__ import annotations

import logtally as lt
from logtally.plans.report import ORDER


def text_of(lines):
    return [r.line for r in lines.orderBy(*ORDER).collect()]


def report_of(lines, **options):
    return text_of(lt.analyze_lines(lines, lt.Options(**options)).report)


def test_whole_report(lines_of):
    one = lines_of(
        "2024-06-01 08:00:00.100 ERROR [t] l - NullPointerException",
        "2024-06-01 08:00:01.100 INFO [t] l - fine",
        "2024-06-01 09:00:01.100 INFO [t] l - fine",
    )
    two = lines_of("stack", source_file="b.log")
    rule, double = "─" * 70, "═" * 70
    assert report_of(one.union(two)) == [
        "", double, "   LOG ANALYSIS REPORT", double, "",
        "▶ OVERVIEW", rule,
        "  Total Lines Read   : 4",
        "  Parsed Entries     : 4",
        "  Malformed Lines    : 1",
        "  Earliest Timestamp : 2024-06-01 08:00:00",
        "  Latest Timestamp   : 2024-06-01 09:00:01",
        "",
        "▶ LOG LEVEL DISTRIBUTION", rule,
        "  ERROR    :       1  ( 25.0%)  " + "█" * 8 + "░" * 22,
        "  INFO     :       2  ( 50.0%)  " + "█" * 15 + "░" * 15,
        "  UNKNOWN  :       1  ( 25.0%)  " + "█" * 8 + "░" * 22,
        "",
        "▶ TOP ERROR PATTERNS", rule,
        "   1. NullPointerException                      2 occurrences",
        "",
        "▶ KEYWORD SEARCH RESULTS", rule,
        "  Error                     : 1 hits",
        "  Exception                 : 1 hits",
        "",
        "▶ HOURLY ACTIVITY", rule,
        "  2024-06-01 08       2  " + "█" * 40,
        "  2024-06-01 09       1  " + "█" * 20 + "░" * 20,
        "",
        "▶ PER-FILE STATISTICS", rule,
        "  app.log                                   3 lines",
        "  b.log                                     1 lines",
        "",
        double,
    ]


def test_sections_with_nothing_to_show(lines_of):
    lines = report_of(lines_of("one", "two"))
    assert "  (no errors detected)" in lines
    headings = [line for line in lines if line.startswith("▶")]
    assert headings == ["▶ OVERVIEW", "▶ LOG LEVEL DISTRIBUTION", "▶ TOP ERROR PATTERNS"]
    assert not any("Timestamp" in line for line in lines)


def test_report_of_nothing(lines_of):
    lines = report_of(lines_of())
    assert "  Total Lines Read   : 0" in lines and "  (no errors detected)" in lines


def test_top_is_a_parameter(lines_of):
    names = [f"{chr(65 + i)}Error" for i in range(12)]
    lines = lines_of(*(f"2024-06-01 08:00:00 ERROR [t] l - {n}" for n in names))
    assert sum("occurrences" in line for line in report_of(lines)) == 10
    ranked = [line for line in report_of(lines, top=3) if "occurrences" in line]
    assert [line.split()[:2] for line in ranked] == [["1.", "AError"], ["2.", "BError"], ["3.", "CError"]]


def test_wide_numbers(spark):
    metrics = spark.createDataFrame(
        [("processed", "", 1234567), ("level", "INFO", 1234567), ("file", "a", 1234567)], "metric string, key string, count bigint"
    )
    overview = spark.createDataFrame(
        [(1234567, 1234567, 0, None, None)],
        "total bigint, processed bigint, malformed bigint, earliest timestamp_ntz, latest timestamp_ntz",
    )
    lines = text_of(lt.report_lines(metrics, overview))
    assert "  Total Lines Read   : 1,234,567" in lines
    assert f"  INFO     : 1,234,567  (100.0%)  {'█' * 30}" in lines


def test_file_and_console(spark, lines_of, tmp_path, capsys, caplog):
    path = tmp_path / "report"
    analysis = lt.analyze_lines(lines_of("x ERROR y"), lt.Options(output=str(path)))
    expected = text_of(analysis.report)
    written = "".join(p.read_text() for p in sorted(path.glob("part-*")))
    assert written.splitlines() == expected
    lt.write_report(analysis.report, str(path))  # over the earlier one
    lt.write_report(analysis.report, " ")
    lt.print_report(analysis.report)
    assert capsys.readouterr().out.splitlines() == expected
    taken = tmp_path / "taken"
    taken.write_text("a file, not a folder")
    lt.write_report(analysis.report, str(taken / "below"))
    assert "could not write the report" in caplog.text
